"""Repeated byte strings by suffix sorting with a difference cover.

Every byte covered by a ``length``-byte string that starts at two places or more is
found, over all texts together. Suffixes are sorted by a difference-cover algorithm
(``suffix_order``): triples at the places 1 and 2 modulo 3 are sorted and named, the
names are sorted by recursion, the remaining suffixes are merged in, and neighbours
in the order are compared over their first ``length`` bytes.

What has to be sorted is cut down first, without losing a match, and cut into groups
that are independent of each other, so that Spark can deal them out:

* Places of a text are keyed by its anchors, the places whose gram has the least hash
  for ``length // 10`` bytes around. Equal strings of ``length`` bytes have their first
  anchor at the same distance. A run of places with one first anchor is an item.
* The *middle* of an item is what all its strings have in common. Equal strings have
  equal middles, so items whose middle occurs once are done: nothing in them repeats.
* The *window* of an item spans its strings. A window that occurs n times is sorted
  once, and counts n times: with n > 1 all its places repeat.
* Items with equal middles are a group. A group of more windows than a block may hold
  is cut: each item is halved, which lengthens the middles, until its groups fit. An
  item of one place has a middle that is its window, so that this ends.

Places without an anchor in reach (texts of a short period) are items of one place.

Handling: null is an empty text, and texts shorter than ``length`` hold no match;
equal texts are read once and count as often as they occur; texts of any size are
scanned whole, in overlapping stretches; an empty table gives an empty table.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.llm.batches import slices
from paysignal.llm.scratch import Scratch
from paysignal.llm.words import mix64

#: Bytes of a gram, and of a stretch of a long text.
GRAM = 8
STRETCH = 4 << 20
#: Symbols sorted at once; names of triples then fit in 21 bits.
BLOCK = 1_900_000
#: Tables are broadcast up to so many rows of fixed size.
BROADCAST_ROWS = 3_000_000
#: Items of one Arrow batch.
BATCH_ROWS = 50_000

_BITS = 21
ITEM = "key binary, a int, l1 int, l2 int, lo int, hi int, mid long, w1 long, w2 long, weight long"


# ---- suffix sorting ----------------------------------------------------------------------------


def suffix_ranks(s: np.ndarray, need: int, cover: int = 1) -> np.ndarray:
    """Ranks from 1 of the suffixes of ``s`` (symbols from 0 below 2^21), in the order of their first
    ``need`` bytes at least, if a symbol stands for ``cover`` bytes; equal ones have some order."""
    n = len(s)
    t = np.concatenate((s, np.zeros(3, dtype=np.int64)))
    one, two = np.arange(1, n, 3), np.arange(2, n, 3)
    sample = np.concatenate((one, two))
    _, names = np.unique((t[sample] << 2 * _BITS) | (t[sample + 1] << _BITS) | t[sample + 2], return_inverse=True)
    names = names.reshape(-1).astype(np.int64) + 1
    if len(names) and names.max() < len(names) and cover * 3 < need:
        # A zero, below all names, ends the suffixes of the first half.
        below = suffix_ranks(np.concatenate((names[: len(one)], [0], names[len(one) :])), need, cover * 3)
        names = np.concatenate((below[: len(one)], below[len(one) + 1 :]))
    rank = np.zeros(n + 3, dtype=np.int64)
    rank[sample] = names

    zero = np.arange(0, n, 3)
    near = lambda i: (t[i] << _BITS) | rank[i + 1]
    far = lambda i: (t[i] << 2 * _BITS) | (t[i + 1] << _BITS) | rank[i + 2]
    near0, far0, near1, far2 = near(zero), far(zero), near(one), far(two)
    place = np.empty(n, dtype=np.int64)
    place[zero] = _index(near0) + np.searchsorted(np.sort(near1), near0) + np.searchsorted(np.sort(far2), far0)
    place[sample] = _index(names)
    place[one] += np.searchsorted(np.sort(near0), near1)
    place[two] += np.searchsorted(np.sort(far0), far2)
    return place + 1


def _index(keys: np.ndarray) -> np.ndarray:
    """The place of each key in their sorted order."""
    place = np.empty(len(keys), dtype=np.int64)
    place[np.argsort(keys, kind="stable")] = np.arange(len(keys))
    return place


def repeated(windows: list[bytes], spans: list[int], length: int) -> list[np.ndarray]:
    """Of each window the first ``spans[i]`` places: which start a string of ``length`` bytes that another of these places starts."""
    text = b"\x00".join(windows) + bytes(GRAM)
    sizes = np.fromiter(map(len, windows), dtype=np.int64, count=len(windows))
    starts = np.cumsum(sizes + 1) - sizes - 1
    codes = np.frombuffer(text, dtype=np.uint8)[: -GRAM].astype(np.int64) + 1
    codes[starts[1:] - 1] = 0
    rank = suffix_ranks(codes, length)
    counts = np.asarray(spans, dtype=np.int64)
    own = np.repeat(starts - (np.cumsum(counts) - counts), counts) + np.arange(int(counts.sum()))
    order = own[np.argsort(rank[own], kind="stable")]
    # Neighbours are compared eight bytes at a time, as long as they are equal.
    words = np.ndarray((len(text) - GRAM + 1,), dtype="<u8", buffer=text, strides=(1,))
    same = np.arange(len(order) - 1)
    for at in [*range(0, length - 7, 8), max(0, length - 8)]:
        x, y = words[order[same] + at], words[order[same + 1] + at]
        if length < 8:
            mask = np.uint64((1 << 8 * length) - 1)
            x, y = x & mask, y & mask
        same = same[x == y]
    hit = np.zeros(len(codes) + 1, dtype=bool)
    hit[order[same]] = True
    hit[order[same + 1]] = True
    return [hit[s : s + c] for s, c in zip(starts.tolist(), spans)]


# ---- items -------------------------------------------------------------------------------------


def _least(x: np.ndarray, width: int) -> np.ndarray:
    """The minimum of each ``width`` values in a row."""
    step = 1
    while step * 2 <= width:
        x, step = np.minimum(x[:-step], x[step:]), step * 2
    return np.minimum(x[: len(x) - (width - step)], x[width - step :]) if step < width else x


def _anchors(raw: bytes, around: int) -> np.ndarray:
    """Places whose gram's hash is below all others up to ``around`` bytes before and after."""
    padded = raw + bytes(GRAM)
    grams = np.ndarray((len(raw) - GRAM + 1,), dtype="<u8", buffer=padded, strides=(1,))
    h = (mix64(grams) >> np.uint64(32)).astype(np.uint32)
    inner = len(h) - 2 * around
    if inner < 1:
        return np.zeros(0, dtype=np.int64)
    least = _least(h, around)
    mid = h[around : around + inner]
    return np.flatnonzero((mid < least[:inner]) & (mid < least[around + 1 : around + 1 + inner])) + around


def _signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def _item(key, raw, base, a, l1, l2, lo, hi, length, weight=1):
    window = xxhash.xxh3_128_intdigest(raw[lo : hi + length])
    middle = xxhash.xxh3_64_intdigest(raw[a - l1 : a - l2 + length], l1 * 65_536 + l2)
    return (
        key, a + base, l1, l2, lo + base, hi + base, _signed(middle), _signed(window >> 64), _signed(window & (1 << 64) - 1), weight
    )


def _stretch_items(key: bytes, raw: bytes, base: int, length: int) -> Iterator[tuple]:
    """Items of a stretch that starts at ``base`` of its text; rows with null ``mid`` are places known to repeat."""
    around, last = max(1, length // 10), len(raw) - length
    reach, cut = length - around - GRAM, min(4 * around, length - around - GRAM)
    a = _anchors(raw, around)
    before = np.concatenate(([-length * 4], a[:-1])) if len(a) else a
    lo = np.maximum(np.maximum(before - around + 1, a - reach), 0)
    hi = np.minimum(a - around, last)
    ok = hi >= lo
    a, lo, hi = a[ok], lo[ok], hi[ok]
    for x, first, end in zip(a.tolist(), lo.tolist(), hi.tolist()):
        if end >= x - cut:
            yield _item(key, raw, base, x, around, cut, max(first, x - cut), end, length)
        if first < x - cut:
            yield _item(key, raw, base, x, cut + 1, reach, first, min(end, x - cut - 1), length)
    free = np.ones(last + 1, dtype=bool)
    steps = np.zeros(last + 2, dtype=np.int64)
    np.add.at(steps, lo, 1)
    np.add.at(steps, hi + 1, -1)
    free &= np.cumsum(steps[:-1]) == 0
    yield from _alone(key, raw, base, np.flatnonzero(free), length, around)


def _alone(key, raw, base, places, length, around) -> Iterator[tuple]:
    if not len(places):
        return
    digests = np.array([xxhash.xxh3_64_intdigest(raw[p : p + length]) for p in places.tolist()], dtype=np.uint64)
    _, first, at, counts = np.unique(digests, return_index=True, return_inverse=True, return_counts=True)
    for i, n in zip(first.tolist(), counts.tolist()):
        p = int(places[i])
        yield _item(key, raw, base, p + around, around, around, p, p, length, n)
    again = places[counts[at.reshape(-1)] > 1]
    if len(again):
        edge = np.flatnonzero(np.diff(again) > 1)
        for lo, hi in zip(again[np.concatenate(([0], edge + 1))].tolist(), again[np.concatenate((edge, [len(again) - 1]))].tolist()):
            yield (key, None, None, None, lo + base, hi + base, None, None, None, None)


_ITEM = pa.schema(
    [("key", pa.binary()), *[(x, pa.int32()) for x in ("a", "l1", "l2", "lo", "hi")], *[(x, pa.int64()) for x in ("mid", "w1", "w2", "weight")]]
)


def _table(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, type=f.type) for c, f in zip(columns, schema)], schema=schema)


def _in_batches(rows: Iterator[tuple], schema: pa.Schema, limit: int = BATCH_ROWS) -> Iterator[pa.RecordBatch]:
    held = []
    for row in rows:
        held.append(row)
        if len(held) >= limit:
            yield _table(held, schema)
            held = []
    if held:
        yield _table(held, schema)


def _scan(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for some in slices(batch, "data"):
                    for key, raw in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                        for base in range(0, len(raw) - length + 1, STRETCH):
                            yield from _stretch_items(key, raw[base : base + STRETCH + length - 1], base, length)

        yield from _in_batches(rows(), _ITEM)

    return work


# ---- pieces of texts ---------------------------------------------------------------------------


def _bounded(df: DataFrame, limit: int) -> DataFrame:
    """To be broadcast if it has at most ``limit`` rows (of a few numbers each), else as it is."""
    return F.broadcast(df) if df.limit(limit + 1).count() <= limit else df


def _texts_of(docs: DataFrame, wanted: DataFrame, limit: int) -> DataFrame:
    """key, data, asked: every text that ``wanted`` rows (of distinct items) name by key, with their list."""
    rows = F.struct("a", "l1", "l2", "lo", "hi", "mid", "w1", "w2", "cnt")
    lists = wanted.groupBy("key").agg(F.collect_list(rows).alias("asked"))
    lists = F.broadcast(lists) if wanted.limit(limit + 1).count() <= limit else lists
    return docs.join(lists, "key")


def _halves(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for some in slices(batch, "data"):
                    for key, raw, asked in zip(*(some.column(i).to_pylist() for i in range(3))):
                        for x in asked:
                            a, l1, l2, lo, hi, cut = x["a"], x["l1"], x["l2"], x["lo"], x["hi"], (x["l1"] + x["l2"]) // 2
                            if hi >= a - cut:
                                yield _item(key, raw, 0, a, l1, cut, max(lo, a - cut), hi, length, x["cnt"])
                            if lo < a - cut:
                                yield _item(key, raw, 0, a, cut + 1, l2, lo, min(hi, a - cut - 1), length, x["cnt"])

        yield from _in_batches(rows(), _ITEM)

    return work


_WINDOW = pa.schema([("mid", pa.int64()), ("w1", pa.int64()), ("w2", pa.int64()), ("cnt", pa.int64()), ("key", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32()), ("window", pa.binary())])


def _cut_windows(length: int):
    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            for batch in batches:
                for some in slices(batch, "data"):
                    for key, raw, asked in zip(*(some.column(i).to_pylist() for i in range(3))):
                        for x in asked:
                            yield (x["mid"], x["w1"], x["w2"], x["cnt"], key, x["lo"], x["hi"], raw[x["lo"] : x["hi"] + length])

        yield from _in_batches(rows(), _WINDOW, 4_000)

    return work


def _sorted_blocks(length: int, block: int):
    """Windows sorted by middle, whole groups together, to ``key, lo, hi``: runs of repeated places in windows that occur once."""
    schema = pa.schema([("key", pa.binary()), ("lo", pa.int32()), ("hi", pa.int32())])

    def spans(held: list[tuple]) -> Iterator[tuple]:
        hits = repeated([x[7] for x in held], [x[6] - x[5] + 1 for x in held], length)
        for row, hit in zip(held, hits):
            if row[3] > 1 or not hit.any():
                continue
            steps = np.flatnonzero(np.diff(np.concatenate(([False], hit, [False])).astype(np.int8)))
            for lo, hi in zip(steps[0::2].tolist(), steps[1::2].tolist()):
                yield (row[4], row[5] + lo, row[5] + hi - 1)

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def rows():
            group, held, size, group_size = [], [], 0, 0
            for batch in batches:
                for row in zip(*(c.to_pylist() for c in batch.columns)):
                    if group and row[0] != group[-1][0]:
                        if held and size + group_size > block:
                            yield from spans(held)
                            held, size = [], 0
                        held, size, group, group_size = held + group, size + group_size, [], 0
                    if group and row[:3] == group[-1][:3]:
                        continue  # the same window, read from a copy of its text
                    group.append(row)
                    group_size += len(row[7]) + 1
            if held and size + group_size > block:
                yield from spans(held)
                held = []
            if held or group:
                yield from spans(held + group)

        yield from _in_batches(rows(), schema)

    return work


def _merged(length: int):
    """``key, spans`` (places) to ``key, starts, ends`` of the bytes that they cover, as maximal runs."""
    schema = pa.schema([("key", pa.binary()), ("starts", pa.list_(pa.int64())), ("ends", pa.list_(pa.int64()))])

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out = []
            for key, spans in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                at = np.array(sorted((x["lo"], x["hi"]) for x in spans), dtype=np.int64)
                ends = np.maximum.accumulate(at[:, 1]) + length
                first = np.concatenate(([True], at[1:, 0] > ends[:-1]))
                out.append((key, at[first, 0].tolist(), ends[np.concatenate((np.flatnonzero(first)[1:] - 1, [len(at) - 1]))].tolist()))
            yield _table(out, schema)

    return work


# ---- the operator ------------------------------------------------------------------------------


def repeated_spans(docs: DataFrame, scratch: Scratch, length: int = 400, block: int = BLOCK, limit: int = BROADCAST_ROWS) -> DataFrame:
    """(key, starts, ends): by the MD5 of a text, its maximal runs of repeated bytes. ``docs``: key, data (bytes)."""
    docs = docs.filter(F.octet_length("data") >= length)
    most = block // (2 * length)  # windows of a group that fit in a block
    items, found = scratch.table(docs.mapInArrow(_scan(length), ITEM), "items"), []
    found.append(items.filter("mid IS NULL").select("key", "lo", "hi"))
    while True:
        middles = items.filter("mid IS NOT NULL").groupBy("mid").agg(F.sum("weight").alias("n")).filter("n > 1").select("mid")
        middles = scratch.table(middles, "middles")
        candidates = items.join(_bounded(middles, limit), "mid")
        windows = candidates.groupBy("w1", "w2").agg(
            F.sum("weight").alias("cnt"), F.min(F.struct("key", "a", "l1", "l2", "lo", "hi", "mid")).alias("first")
        )
        windows = scratch.table(windows.select("w1", "w2", "cnt", "first.*"), "windows")
        several = windows.filter("cnt > 1").select("w1", "w2")
        found.append(items.join(_bounded(several, limit), ["w1", "w2"]).select("key", "lo", "hi"))

        groups = windows.groupBy("mid").agg(F.count("*").alias("n"), F.min("cnt").alias("least")).filter("n > 1 AND least = 1")
        groups = scratch.table(groups, "groups")
        fits, large = groups.filter(F.col("n") <= most).select("mid"), groups.filter(F.col("n") > most).select("mid")
        asked = windows.join(_bounded(fits, limit), "mid")
        cut = _texts_of(docs, asked, limit).mapInArrow(
            _cut_windows(length), "mid long, w1 long, w2 long, cnt long, key binary, lo int, hi int, window binary"
        )
        parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
        dealt = cut.repartition(parts, "mid").sortWithinPartitions("mid", "w1", "w2")
        found.append(scratch.table(dealt.mapInArrow(_sorted_blocks(length, block), "key binary, lo int, hi int"), "sorted"))

        if large.isEmpty():
            break
        halved = _texts_of(docs, windows.join(_bounded(large, limit), "mid"), limit).mapInArrow(_halves(length), ITEM)
        items = scratch.table(halved.dropDuplicates(["key", "a", "l1", "l2"]), "halves")
    spans = found[0]
    for more in found[1:]:
        spans = spans.unionByName(more)
    lists = spans.distinct().groupBy("key").agg(F.collect_list(F.struct("lo", "hi")).alias("spans"))
    return scratch.table(lists.mapInArrow(_merged(length), "key binary, starts array<long>, ends array<long>"), "spans")


def remove_repeats(docs: DataFrame, scratch: Scratch, text: str = "text", length: int = 400, block: int = BLOCK, limit: int = BROADCAST_ROWS) -> DataFrame:
    """(rec, starts, ends, kept): each row as a struct, the runs of bytes that go, and the remaining bytes."""
    data = F.coalesce(F.col(text).cast("binary"), F.lit(b""))
    keyed = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("rec"), F.unhex(F.md5(data)).alias("key"), data.alias("data"))
    spans = repeated_spans(keyed.select("key", "data"), scratch, length, block, limit)
    joined = keyed.join(_bounded(spans, limit // 10), "key", "left")
    kept = joined.select("rec", "data", "starts", "ends").mapInArrow(_kept, f"rec {joined.schema['rec'].dataType.simpleString()}, starts array<long>, ends array<long>, kept binary")
    return kept


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    lists = pa.list_(pa.int64())
    for batch in batches:
        for some in slices(batch, "data"):
            out = []
            starts, ends = ([x or [] for x in some.column(i).to_pylist()] for i in (2, 3))
            for raw, lo, hi in zip(some.column(1).to_pylist(), starts, ends):
                out.append(b"".join(raw[x:y] for x, y in zip([0, *hi], [*lo, len(raw)])) if lo else raw)
            arrays = [some.column(0), pa.array(starts, type=lists), pa.array(ends, type=lists), pa.array(out, type=pa.binary())]
            yield pa.RecordBatch.from_arrays(arrays, names=["rec", "starts", "ends", "kept"])
