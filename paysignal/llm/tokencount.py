"""Token counts of sections by offset-mapped attribution.

A document is encoded once, whole, and its tokens are then attributed to its
sections; sections are never encoded by themselves, which would count other
tokens at their edges. Byte-level tokens cover the text without gaps, so the
token lengths give every token's place in the text, and one interval join per
batch (a binary search of token starts among section starts) finds its section.

Rule for a token that crosses a boundary: ``first`` gives it to the section of
its first byte, ``most`` to the section with most of its bytes, ties to the
earlier. Every token is counted once; tokens outside all sections are counted
under a null section.

Defined cases: a null text is empty; an empty text has one section, its empty
only line, with no tokens; texts of any length are encoded whole; repeated rows
give repeated results; an empty table gives an empty result.
"""

from __future__ import annotations

import base64
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from paysignal.llm.batches import ragged, slices, strings

RULES = ("first", "most")


@lru_cache(maxsize=2)
def tokenizer(path: str, pattern: str) -> tuple[tiktoken.Encoding, np.ndarray]:
    """The encoding of a ``.tiktoken`` file and the bytes of each token."""
    with open(path, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    sizes = np.zeros(max(ranks.values()) + 1, dtype=np.int64)
    for token, i in ranks.items():
        sizes[i] = len(token)
    return tiktoken.Encoding("ranks", pat_str=pattern, mergeable_ranks=ranks, special_tokens={}), sizes


def line_spans(raw: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of the lines; a newline belongs to the line that it ends."""
    ends = np.flatnonzero(np.frombuffer(raw, dtype=np.uint8) == 10) + 1
    starts = np.concatenate(([0], ends))
    return starts, np.append(ends, len(raw))


def given_spans(raw: bytes, spans: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    """Byte spans of ``[{start, end}]`` in code points; they must be in order and not overlap."""
    lead = np.append(np.flatnonzero((np.frombuffer(raw, dtype=np.uint8) & 0xC0) != 0x80), len(raw))
    pairs = np.array([(s["start"], s["end"]) for s in spans], dtype=np.int64).reshape(-1, 2)
    flat = pairs.ravel()
    if len(flat) and (flat[0] < 0 or flat[-1] >= len(lead) or (np.diff(flat) < 0).any()):
        raise ValueError("spans must lie inside the text, in order, without overlap")
    return lead[pairs[:, 0]], lead[pairs[:, 1]]


def attribute(starts: np.ndarray, sizes: np.ndarray, lows: np.ndarray, highs: np.ndarray, rule: str) -> tuple[np.ndarray, np.ndarray]:
    """(section of each token or -1, whether it crosses a section's edge). ``lows`` ascend; spans do not overlap."""
    ends = starts + sizes
    if not len(lows):
        return np.full(len(starts), -1), np.zeros(len(starts), dtype=bool)
    # Empty spans hold no byte; among spans that start alike, the last is the one that can.
    own = np.searchsorted(lows, starts, side="right") - 1
    inside = (own >= 0) & (starts < highs[own])
    crosses = np.where(inside, ends > highs[own], np.searchsorted(lows, ends, side="left") - 1 > own)
    found = np.where(inside, own, -1)
    if rule == "most":
        for i in np.flatnonzero(crosses):
            last = int(np.searchsorted(lows, ends[i], side="left"))
            near = np.arange(max(0, own[i]), last)
            held = np.minimum(highs[near], ends[i]) - np.maximum(lows[near], starts[i])
            outside = sizes[i] - held.clip(0).sum()
            best = int(held.argmax()) if len(held) else 0
            found[i] = near[best] if len(held) and held[best] >= max(1, outside) else -1
    return found, crosses


def token_counts(
    df: DataFrame,
    path: str,
    pattern: str,
    text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    spans: str | None = None,
    rule: str = "first",
) -> DataFrame:
    """One row per document and section: ``carry`` columns, ``section`` (its
    number from 0; null for tokens outside all sections, if there are any),
    ``n_bytes``, ``n_tokens`` and ``n_crossing`` (of them, tokens that cross an edge).

    ``spans`` names an array of (start, end) in code points; without it the
    sections are the text's lines.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    counts = ("n_bytes", "n_tokens", "n_crossing")
    schema = T.StructType(
        [df.schema[c] for c in carry] + [T.StructField("section", T.IntegerType())] + [T.StructField(c, T.LongType(), False) for c in counts]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding, token_sizes = tokenizer(path, pattern)
        for batch in batches:
            for part in slices(batch, "_text"):
                texts = strings(part, "_text")
                raws = [t.encode() for t in texts]
                ids = [np.array(encoding.encode_ordinary(t), dtype=np.int64) for t in texts]
                given = part.column(part.num_columns - 1).to_pylist() if spans else None
                found = [given_spans(r, g or []) for r, g in zip(raws, given, strict=True)] if spans else [line_spans(r) for r in raws]

                # One axis for the batch: each document's bytes after those of the one before, a byte apart.
                base = np.cumsum([0, *(len(r) + 1 for r in raws)])[:-1]
                per = np.array([len(lo) for lo, _ in found], dtype=np.int64)
                lows = np.concatenate([lo + b for (lo, _), b in zip(found, base, strict=True)])
                highs = np.concatenate([hi + b for (_, hi), b in zip(found, base, strict=True)])
                tokens = np.array([len(i) for i in ids], dtype=np.int64)
                sizes = token_sizes[np.concatenate(ids)]
                ends = np.cumsum(sizes)
                doc = np.repeat(np.arange(len(ids)), tokens)
                done = np.concatenate(([0], ends))[np.cumsum(tokens) - tokens]
                starts = ends - sizes - done[doc] + base[doc]
                at, crosses = attribute(starts, sizes, lows, highs, rule)

                inside = at >= 0
                n = np.bincount(at[inside], minlength=len(lows))
                over = np.bincount(at[inside & crosses], minlength=len(lows))
                rest = np.bincount(doc[~inside], minlength=len(ids))
                rest_over = np.bincount(doc[~inside & crosses], minlength=len(ids))
                rest_bytes = np.array([len(r) for r in raws]) - np.bincount(np.repeat(np.arange(len(ids)), per), highs - lows, len(ids))
                more = np.flatnonzero(rest)
                rows = np.concatenate((np.repeat(np.arange(len(ids)), per), more))
                section = np.concatenate((ragged(np.zeros(len(per), dtype=np.int64), per), np.full(len(more), -1)))
                kept = [part.column(i).take(pa.array(rows)) for i in range(len(carry))]
                made = [
                    pa.array(section, type=pa.int32(), mask=section < 0),
                    pa.array(np.concatenate((highs - lows, rest_bytes[more])).astype(np.int64)),
                    pa.array(np.concatenate((n, rest[more])).astype(np.int64)),
                    pa.array(np.concatenate((over, rest_over[more])).astype(np.int64)),
                ]
                yield pa.RecordBatch.from_arrays([*kept, *made], names=schema.names)

    rows = df.select(
        *[df[f"`{c}`"].alias(f"c{i}") for i, c in enumerate(carry)],
        df[f"`{text}`"].alias("_text"),
        *([df[f"`{spans}`"].alias("_spans")] if spans else []),
    )
    return rows.mapInArrow(run, schema)
