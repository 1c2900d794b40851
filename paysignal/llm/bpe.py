"""Byte-level BPE encoding and decoding with length-bucketed numpy matrices.

A text is cut by the tokenizer's pattern, each match is encoded separately, and
the ids of a match do not depend on its surroundings; a task therefore encodes
each distinct piece once and gathers the ids of whole texts from there.

The matches that are no single token lie as rows of byte ids in padded
matrices, one per length bucket. In each round every row merges its leftmost
pair of minimum rank: a matrix of pair ranks is kept beside the ids, the merged
pair is compacted away, and only the two pairs it touches are looked up again,
in an open-addressing hash table of all (left, right) -> merged. Finished rows
leave the matrix. Matches beyond the last bucket (``LONGEST`` bytes) merge by a
heap in O(n log n), in the same order.

Defined cases: null text is empty and has no tokens; texts of any length are
encoded whole; repeated rows are encoded like any other; an empty table gives
an empty result; columns to carry are named by the caller, others are not read.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
import re
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from paysignal.llm.batches import list_array, ragged, released, slices, strings

BUCKETS = (2, 3, 4, 5, 6, 8, 10, 12, 16, 24, 32, 64, 128)
LONGEST = BUCKETS[-1]
#: Cells of one matrix; more rows of a bucket follow in further matrices.
CELLS = 1 << 17
#: Distinct pieces that a task remembers before it starts afresh.
REMEMBERED = 64_000
#: Bytes of text encoded at once: its matches are held as a list.
SLICE = 1 << 19
_NONE = np.int32(2**31 - 1)
_ODD = np.uint64(0x9E3779B97F4A7C15)
_EMPTY = np.uint64(2**64 - 1)
#: A space after other white space: there a text cannot be cut before matching.
_UNSAFE = re.compile(r"\s ")


class Vocabulary:
    """Ranks of a ``.tiktoken`` file, its pair table and the tokens' bytes."""

    def __init__(self, path: str):
        with open(path, "rb") as f:
            self.ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.byte_ids = np.array([self.ranks[bytes([b])] for b in range(256)], dtype=np.int32)
        tokens = [b""] * (max(self.ranks.values()) + 1)
        for token, i in self.ranks.items():
            tokens[i] = token
        self.token_sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.token_starts = np.cumsum(self.token_sizes) - self.token_sizes
        self.token_bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)
        # One pair of ints after the other, not a list of them: what a worker frees between other objects it keeps.
        pairs = (
            x
            for t, rank in self.ranks.items()
            for i in range(1, len(t))
            if t[:i] in self.ranks and t[i:] in self.ranks
            for x in (self.ranks[t[:i]], self.ranks[t[i:]], rank)
        )
        left, right, merged = np.fromiter(pairs, dtype=np.int64).reshape(-1, 3).T
        bits = max(4, int(4 * len(left)).bit_length())
        self.shift = np.uint64(64 - bits)
        self.last = np.int64((1 << bits) - 1)
        self.keys = np.full(1 << bits, _EMPTY, dtype=np.uint64)
        self.values = np.full(1 << bits, _NONE, dtype=np.int32)
        key = self._key(left, right)
        slot, todo = self._slot(key), np.arange(len(key))
        while len(todo):  # those that find a free slot take it, one per slot; the others move on
            free = todo[self.keys[slot[todo]] == _EMPTY]
            self.keys[slot[free]] = key[free]
            self.values[slot[free]] = merged[free]
            todo = todo[self.keys[slot[todo]] != key[todo]]
            slot[todo] = (slot[todo] + 1) & self.last

    @staticmethod
    def _key(left: np.ndarray, right: np.ndarray) -> np.ndarray:
        return (left.astype(np.uint64) << np.uint64(32)) | right.astype(np.uint64)

    def _slot(self, key: np.ndarray) -> np.ndarray:
        return ((key * _ODD) >> self.shift).astype(np.int64)

    def merged(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Id (and rank) of each pair's merge; ``_NONE`` for pairs that do not merge or are padding."""
        real = np.flatnonzero((left >= 0) & (right >= 0))
        out = np.full(len(left), _NONE, dtype=np.int32)
        key = self._key(left[real], right[real])
        slot = self._slot(key)
        todo = np.arange(len(real))
        while len(todo):
            found = self.keys[slot[todo]]
            hit = found == key[todo]
            out[real[todo[hit]]] = self.values[slot[todo[hit]]]
            todo = todo[~hit & (found != _EMPTY)]
            slot[todo] = (slot[todo] + 1) & self.last
        return out

    def encode(self, pieces: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all pieces in order, ids per piece); a piece is one match of the pattern."""
        whole = [self.ranks.get(p, -1) for p in pieces]
        counts = np.ones(len(pieces), dtype=np.int64)
        results: list[tuple[np.ndarray, np.ndarray]] = []  # (pieces, padded ids)
        known = np.array(whole, dtype=np.int32).reshape(-1, 1)
        done = np.flatnonzero(known[:, 0] >= 0)
        results.append((done, known[done]))
        rest = np.flatnonzero(known[:, 0] < 0)
        sizes = np.fromiter((len(pieces[i]) for i in rest), dtype=np.int64, count=len(rest))
        lower = 0
        for width in BUCKETS:
            rows = rest[(sizes > lower) & (sizes <= width)]
            lower = width
            step = max(1, CELLS // width)
            for at in range(0, len(rows), step):
                results.extend(self._rounds(rows[at : at + step], pieces, width))
        for i in rest[sizes > LONGEST]:
            results.append((np.array([i]), np.array([self._heap(pieces[i])], dtype=np.int32)))
        for rows, ids in results:
            counts[rows] = (ids >= 0).sum(axis=1)
        ends = np.cumsum(counts)
        flat = np.empty(int(ends[-1]) if len(ends) else 0, dtype=np.uint32)
        for rows, ids in results:
            flat[ragged(ends[rows] - counts[rows], counts[rows])] = ids[ids >= 0]
        return flat, counts

    def _rounds(self, rows: np.ndarray, pieces: list[bytes], width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        raw = np.frombuffer(b"".join(pieces[i].ljust(width, b"\0") for i in rows), dtype=np.uint8).reshape(-1, width)
        size = np.fromiter((len(pieces[i]) for i in rows), dtype=np.int64, count=len(rows))
        ids = np.where(np.arange(width) < size[:, None], self.byte_ids[raw], np.int32(-1))
        rank = self.merged(ids[:, :-1].ravel(), ids[:, 1:].ravel()).reshape(len(rows), width - 1)
        while len(rows):
            at = rank.argmin(axis=1)  # the leftmost of the least
            best = rank[np.arange(len(rows)), at]
            over = best == _NONE
            if over.any():
                yield rows[over], ids[over]
                go = ~over
                rows, ids, rank, at, best = rows[go], ids[go], rank[go], at[go], best[go]
                if not len(rows):
                    return
            r = np.arange(len(rows))
            ids[r, at] = best
            width = ids.shape[1] - 1
            # Compaction: drop the pair's right id, and the rank that stood for the pair.
            ids = ids[np.arange(width + 1) != (at + 1)[:, None]].reshape(-1, width)
            if width == 1:
                yield rows, ids
                return
            rank = rank[np.arange(width) != at[:, None]].reshape(-1, width - 1)
            has = at > 0
            rank[r[has], at[has] - 1] = self.merged(ids[r[has], at[has] - 1], best[has])
            has = at < width - 1
            rank[r[has], at[has]] = self.merged(best[has], ids[r[has], at[has] + 1])

    def _pair(self, left: int, right: int) -> int:
        key = (left << 32) | right
        slot = ((key * int(_ODD)) & (2**64 - 1)) >> int(self.shift)
        while True:
            found = int(self.keys[slot])
            if found == key:
                return int(self.values[slot])
            if found == int(_EMPTY):
                return -1
            slot = (slot + 1) & int(self.last)

    def _heap(self, piece: bytes) -> list[int]:
        """A long match: the same merges, with the pairs in a heap by (rank, place)."""
        ids = self.byte_ids[np.frombuffer(piece, dtype=np.uint8)].tolist()
        n = len(ids)
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        known: dict[tuple[int, int], int] = {}

        def merged(a: int, b: int) -> int:
            if (a, b) not in known:
                known[a, b] = self._pair(a, b)
            return known[a, b]

        heap = [(m, i, ids[i], ids[i + 1]) for i in range(n - 1) if (m := merged(ids[i], ids[i + 1])) >= 0]
        heapq.heapify(heap)
        while heap:
            m, i, a, b = heapq.heappop(heap)
            j = after[i]
            if ids[i] != a or j >= n or ids[j] != b:
                continue  # one of the two has merged since
            ids[i], ids[j] = m, -1
            after[i] = after[j]
            if after[j] < n:
                before[after[j]] = i
            for x, y in ((before[i], i), (i, after[i])):
                if x >= 0 and y < n and (p := merged(ids[x], ids[y])) >= 0:
                    heapq.heappush(heap, (p, x, ids[x], ids[y]))
        return [x for x in ids if x >= 0]

    def decode(self, ids: np.ndarray) -> bytes:
        return self.token_bytes[ragged(self.token_starts[ids], self.token_sizes[ids])].tobytes()


@lru_cache(maxsize=2)
def vocabulary(path: str) -> Vocabulary:
    return Vocabulary(path)


class Encoder:
    """Encodes whole texts; remembers the ids of the pieces it has met."""

    def __init__(self, vocab: Vocabulary, pattern: str):
        self.vocab = vocab
        self.pattern = regex.compile(pattern)
        self._forget()

    def _forget(self) -> None:
        self.first: dict[str, int] = {}  # a piece as it stands
        self.spaced: dict[str, int] = {}  # a piece without the space before it
        self.ids = np.empty(0, dtype=np.uint32)
        self.starts = np.empty(0, dtype=np.int64)
        self.counts = np.empty(0, dtype=np.int64)

    def _learn(self, new: list[str]) -> None:
        matches = [self.pattern.findall(p) for p in new]
        flat, counts = self.vocab.encode([m.encode() for found in matches for m in found])
        per = np.fromiter(map(len, matches), dtype=np.int64, count=len(new))
        ends = np.concatenate(([0], np.cumsum(counts)))[np.concatenate(([0], np.cumsum(per)))]
        self.starts = np.concatenate((self.starts, len(self.ids) + ends[:-1]))
        self.counts = np.concatenate((self.counts, np.diff(ends)))
        self.ids = np.concatenate((self.ids, flat))

    def encode(self, texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts in order, ids per text)."""
        if len(self.starts) > REMEMBERED:
            self._forget()
        # A space that follows no white space starts a match wherever it stands, so texts are cut there.
        cut = [None if _UNSAFE.search(t) else t.split(" ") for t in texts]
        rows = [self.pattern.findall(t) if c is None else c for t, c in zip(texts, cut, strict=True)]
        plain = {p for c, row in zip(cut, rows, strict=True) for p in (row if c is None else row[:1])} - self.first.keys()
        spaced = set().union(*(row[1:] for c, row in zip(cut, rows, strict=True) if c is not None)) - self.spaced.keys()
        new = [*plain, *(" " + p for p in spaced)]
        base = len(self.starts)
        self.first.update(zip(plain, range(base, base + len(plain)), strict=True))
        self.spaced.update(zip(spaced, range(base + len(plain), base + len(new)), strict=True))
        if new:
            self._learn(new)
        first, after = self.first.__getitem__, self.spaced.__getitem__
        found: list[int] = []
        for c, row in zip(cut, rows, strict=True):
            if c is None:
                found.extend(map(first, row))
            else:
                found.append(first(row[0]))
                found.extend(map(after, row[1:]))
        at = np.array(found, dtype=np.int64)
        counts = self.counts[at]
        ids = self.ids[ragged(self.starts[at], counts)]
        row_ends = np.cumsum([len(r) for r in rows], dtype=np.int64)
        per_text = np.diff(np.concatenate(([0], np.cumsum(counts)))[row_ends], prepend=0)
        return ids, per_text


OUTPUTS = {
    "n_tokens": T.LongType(),
    "ids": T.ArrayType(T.IntegerType(), False),
    "decoded": T.BinaryType(),
    "ids_sha256": T.StringType(),
    "decoded_sha256": T.StringType(),
}


def encode(
    df: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    outputs: tuple[str, ...] = ("n_tokens", "ids"),
) -> DataFrame:
    """``carry`` columns of ``df`` and the chosen ``outputs``: n_tokens; ids;
    decoded (the bytes that the ids decode to); ids_sha256 (of the ids as
    little-endian unsigned 32-bit integers) and decoded_sha256, in lowercase hex.

    ``path`` is a ``.tiktoken`` file that every node has at the same place.
    """
    schema = T.StructType([df.schema[c] for c in carry] + [T.StructField(o, OUTPUTS[o]) for o in outputs])
    decodes = bool({"decoded", "decoded_sha256"} & set(outputs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        vocab = vocabulary(path)
        encoder = Encoder(vocab, pattern)
        for batch in batches:
            for part in slices(batch, "_text", SLICE):
                ids, counts = encoder.encode(strings(part, "_text"))
                ends = np.cumsum(counts)
                pieces = [ids[e - n : e] for e, n in zip(ends.tolist(), counts.tolist(), strict=True)]
                decoded = [vocab.decode(p) for p in pieces] if decodes else []
                made = {
                    "n_tokens": lambda: pa.array(counts),
                    "ids": lambda: list_array(ids.view(np.int32), counts, pa.int32()),
                    "decoded": lambda: pa.array(decoded, type=pa.binary()),
                    "ids_sha256": lambda: pa.array([hashlib.sha256(p.astype("<u4").tobytes()).hexdigest() for p in pieces]),
                    "decoded_sha256": lambda: pa.array([hashlib.sha256(d).hexdigest() for d in decoded]),
                }
                kept = [part.column(i) for i in range(len(carry))]
                yield pa.RecordBatch.from_arrays([*kept, *(made[o]() for o in outputs)], names=[*carry, *outputs])

    rows = df.select(*[df[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(carry)], df[f"`{text}`"].alias("_text"))
    return rows.mapInArrow(released(run), schema)
