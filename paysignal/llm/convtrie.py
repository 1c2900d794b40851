"""Trie of the prefixes that conversations share, with subtree totals by time-forward processing.

A node is a distinct sequence of first turns. Its name is the position-keyed sum
of its turns' hashes (128 bits), so names are prefix sums: they are made in
sorted ranges, and a conversation of any length spans as many ranges as it needs.

Totals flow from the leaves to the root through tasks that never hold a tree.
Conversations are dealt to shards; each shard holds the nodes that its
conversations pass. A shard's nodes arrive sorted by reverse level order; each
node takes the totals addressed to it from a priority queue that spills sorted
runs to the executor's disk, adds its own, and addresses the sum to its parent.
The roots of the shards (nodes met in several shards) then add up across them:
a node counts its own value in one shard only. Levels are cut into bands, so that
one very long conversation is many shards; the tops of the bands are a smaller
trie, summed by the same means.

Handling: rows without an id take no part; null role or text is empty; turns go by
number, nulls first, ties by role, then text (repeated rows are turns of their
own); an empty table has no node; further columns are ignored.
"""

from __future__ import annotations

import hashlib
import os
import tempfile
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysignal.llm.scratch import Scratch
from paysignal.llm.words import mix64

#: Nodes of a shard, levels of a band, and messages held in memory before a queue spills.
SHARD_ROWS = 250_000
BAND = 4_096
QUEUE_ROWS = 500_000
#: Bytes of ids handed on as one piece where a node's list crosses ranges.
PIECE_BYTES = 1 << 20

_ODD = np.uint64(0x9E3779B97F4A7C15)
_OTHER = np.uint64(0xD1B54A32D192ED03)
_PAIR = np.dtype([("hi", ">u8"), ("lo", ">u8")])


def _parallel(df: DataFrame) -> int:
    return int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))


def _ranged(df: DataFrame, *order) -> DataFrame:
    """In sorted ranges, with the range's number as ``pid``."""
    ranges = df.repartitionByRange(_parallel(df), *order).sortWithinPartitions(*order)
    return ranges.withColumn("pid", F.spark_partition_id())


# ---- turns: places, rebuilt sequences, names ---------------------------------------------------


def turns(conversations: DataFrame, scratch: Scratch) -> DataFrame:
    """(conv_id, pos from 0, digest of role and text, size in bytes of the text)."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    known = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", role.alias("role"), text.alias("text"))
    order = ("conv_id", F.asc_nulls_first("turn"), "role", "text")
    digest = F.unhex(F.md5(F.concat_ws(":", F.length("role"), "role", "text").cast("binary")))
    thin = _ranged(known, *order).select("pid", "conv_id", digest.alias("digest"), F.octet_length("text").cast("long").alias("size"))
    return _carried(thin, scratch, "turns").select("conv_id", F.expr("n - 1").alias("pos"), "digest", "size")


def grafted(placed: DataFrame, family: int = 5, heads: int = 9) -> DataFrame:
    """Every conversation rebuilt: the first h turns of its family's first conversation
    (id less its remainder by ``family``), then its own turns after its first h;
    h is the crc32 of its decimal id, modulo ``heads``.

    (conv_id, depth from 1, digest, size, length of the rebuilt conversation); a
    rebuilt conversation without turns is one row of depth 0.
    """
    counts = placed.groupBy("conv_id").agg(F.count("*").alias("n"))
    convs = counts.select(
        "conv_id",
        "n",
        (F.col("conv_id") - F.col("conv_id") % family).alias("base"),
        (F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads).alias("h"),
    )
    of_base = counts.select(F.col("conv_id").alias("base"), F.col("n").alias("base_n"))
    taken = F.least("h", F.coalesce("base_n", F.lit(0)))
    convs = convs.join(of_base, "base", "left").select(
        "conv_id", "base", "h", taken.alias("taken"), (taken + F.greatest(F.col("n") - F.col("h"), F.lit(0))).alias("len")
    )
    own = placed.join(convs, "conv_id").filter("pos >= h")
    own = own.select("conv_id", F.expr("taken + pos - h + 1").alias("depth"), "digest", "size", "len")
    first = placed.filter(F.col("pos") < heads - 1).withColumnRenamed("conv_id", "base")
    head = first.join(convs, "base").filter("pos < taken")
    head = head.select("conv_id", F.expr("pos + 1").alias("depth"), "digest", "size", "len")
    none = convs.filter("len = 0").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(None).cast("binary").alias("digest"), F.lit(0).cast("long").alias("size"), "len"
    )
    return own.unionByName(head).unionByName(none)


def _carried(rows: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """Sorted ranges ``pid, conv_id, digest, ...`` with, for each conversation, running
    counts ``n`` and running sums ``h1, h2`` of the place-keyed digests (all mod 2^64).

    Running values are made range by range; where a conversation goes on in the
    next range, what it has so far is carried over: one row a range, not a group.
    """
    out = f"{_ddl(rows)}, n long, h1 long, h2 long"
    local = scratch.table(rows.mapInArrow(_running, out), name)
    ends = local.groupBy("pid").agg(
        F.min("conv_id").alias("first"), F.max(F.struct("conv_id", "n", "h1", "h2")).alias("last")
    )
    carry, held = [], None  # held: id, n, h1, h2 up to the range before
    for pid, first, last in sorted((r.pid, r["first"], r["last"]) for r in ends.collect()):
        if held and held[0] == first:
            carry.append((pid, first, *(_signed(x) for x in held[1:])))
        base = held[1:] if held and held[0] == last.conv_id == first else (0, 0, 0)
        held = (last.conv_id, *((x + y) % (1 << 64) for x, y in zip(base, last[1:])))
    if not carry:
        return local
    spark = rows.sparkSession
    over = spark.createDataFrame(carry, "pid int, conv_id long, c0 long, c1 long, c2 long")
    joined = local.join(F.broadcast(over), ["pid", "conv_id"], "left")  # a row a range at most
    return joined.mapInArrow(_added, _ddl(local)).select(local.columns)


def _ddl(df: DataFrame) -> str:
    return ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in df.schema)


def _signed(x: int) -> int:
    return (x & (2**64 - 1)) - (2**64 if x & 2**63 else 0)


def _column(batch: pa.RecordBatch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _ints(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return _column(batch, name).fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)


def _running(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    conv, state = None, np.zeros(3, dtype=np.uint64)
    for batch in batches:
        if not batch.num_rows:
            continue
        ids = _ints(batch, "conv_id")
        start = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
        raw = b"".join(x or bytes(16) for x in _column(batch, "digest").to_pylist())
        pair = np.frombuffer(raw, dtype="<u8").reshape(-1, 2)
        depth = _ints(batch, "depth").astype(np.uint64) if "depth" in batch.schema.names else np.zeros(len(ids), np.uint64)
        live = np.frombuffer(_column(batch, "digest").is_valid().to_numpy(zero_copy_only=False).astype(np.uint8), dtype=np.uint8)
        terms = np.stack([np.ones(len(ids), np.uint64), mix64(pair[:, 0] + depth * _ODD) * live, mix64(pair[:, 1] + depth * _OTHER) * live])
        total = np.cumsum(terms, axis=1)
        before = np.concatenate((np.zeros((3, 1), np.uint64), total), axis=1)[:, start]
        if conv == ids[0]:
            before[:, 0] -= state
        total -= np.repeat(before, np.diff(np.append(start, len(ids))), axis=1)
        conv, state = ids[-1], total[:, -1].copy()
        yield _with(batch, n=total[0], h1=total[1], h2=total[2])


def _with(batch: pa.RecordBatch, **columns: np.ndarray) -> pa.RecordBatch:
    arrays = list(batch.columns) + [pa.array(c.view(np.int64)) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(batch.schema.names) + list(columns))


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        sums = {a: _ints(batch, a).view(np.uint64) + _ints(batch, b).view(np.uint64) for a, b in (("n", "c0"), ("h1", "c1"), ("h2", "c2"))}
        order = [c for c in batch.schema.names if c not in ("c0", "c1", "c2")]
        yield _with(batch.select([c for c in order if c not in sums]), **sums).select(order)


def named(rebuilt: DataFrame, scratch: Scratch) -> DataFrame:
    """Rows of a sequence with the names of their node and of its parent; a root row for each conversation."""
    rows = _ranged(rebuilt, "conv_id", "depth")
    summed = _carried(rows.select("pid", "conv_id", "depth", "digest", "size", "len"), scratch, "sums")
    out = "conv_id long, depth long, size long, len long, node binary, parent binary"
    found = scratch.table(summed.mapInArrow(_names, out), "names")
    root = found.filter("depth <= 1").select(
        "conv_id", F.lit(0).cast("long").alias("depth"), F.lit(0).cast("long").alias("size"), "len",
        F.lit(bytes(16)).alias("node"), F.lit(None).cast("binary").alias("parent"),
    )
    return found.filter("depth > 0").unionByName(root)


def _names(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        raw = b"".join(x or bytes(16) for x in _column(batch, "digest").to_pylist())
        pair = np.frombuffer(raw, dtype="<u8").reshape(-1, 2)
        depth = _ints(batch, "depth").astype(np.uint64)
        h1, h2 = _ints(batch, "h1").view(np.uint64), _ints(batch, "h2").view(np.uint64)
        p1, p2 = h1 - mix64(pair[:, 0] + depth * _ODD), h2 - mix64(pair[:, 1] + depth * _OTHER)
        kept = batch.select(["conv_id", "depth", "size", "len"])
        yield pa.RecordBatch.from_arrays(
            [*kept.columns, _keys(h1, h2), _keys(p1, p2)], names=["conv_id", "depth", "size", "len", "node", "parent"]
        )


def _keys(hi: np.ndarray, lo: np.ndarray) -> pa.Array:
    both = np.empty(len(hi), dtype=_PAIR)
    both["hi"], both["lo"] = hi, lo
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(both), [None, pa.py_buffer(both.tobytes())]).cast(pa.binary())


# ---- time-forward processing -------------------------------------------------------------------


class SpillingQueue:
    """Messages (16-byte key, two sums), taken in key order.

    Beyond ``limit`` rows held, they are sorted and written as a run to the
    executor's own spill folder; a run goes with its file when it is read up.
    """

    def __init__(self, limit: int):
        self.limit, self.runs, self.held, self.rows, self.spilled = limit, [], [], 0, 0

    def push(self, keys: np.ndarray, sums: np.ndarray) -> None:
        self.held.append((keys, sums))
        self.rows += len(keys)
        if self.rows > self.limit:
            self._spill()

    def _sorted(self) -> tuple[np.ndarray, np.ndarray]:
        keys, at = np.unique(np.concatenate([k for k, _ in self.held]), return_inverse=True)
        sums = np.zeros((len(keys), 2), dtype=np.int64)
        np.add.at(sums, at, np.concatenate([s for _, s in self.held]))
        self.held, self.rows = [], 0
        return keys, sums

    def _spill(self) -> None:
        folder = os.environ.get("SPARK_LOCAL_DIRS", "").split(",")[0] or None
        file = tempfile.TemporaryFile(dir=folder)
        keys, sums = self._sorted()
        step = max(1, self.limit // 8)
        for at in range(0, len(keys), step):
            np.save(file, keys[at : at + step])
            np.save(file, sums[at : at + step])
        file.seek(0)
        self.runs.append(_Run(file, -(-len(keys) // step)))
        self.spilled += 1

    def drain(self) -> list[_Run]:
        """All messages as sorted runs; the queue is empty again."""
        runs, self.runs = self.runs, []
        if self.held:
            runs.append(_Run(None, 0, *self._sorted()))
        return runs


class _Run:
    def __init__(self, file, left: int, keys=None, sums=None):
        self.file, self.left, self.keys, self.sums = file, left, keys, sums

    def take(self, upto: bytes) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Messages whose key is at most ``upto``."""
        while True:
            if self.keys is None or not len(self.keys):
                if not self.left:
                    return
                self.keys, self.sums, self.left = np.load(self.file), np.load(self.file), self.left - 1
            to = int(np.searchsorted(self.keys, upto, side="right"))
            if to:
                yield self.keys[:to], self.sums[:to]
                self.keys, self.sums = self.keys[to:], self.sums[to:]
            if len(self.keys):
                return


def _binary16(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(x or bytes(16) for x in column.to_pylist()), dtype="S16")


def time_forward(limit: int = QUEUE_ROWS):
    """Rows ``part, level, node, parent, leaves, saved`` of whole parts, sorted by part, reverse level
    and node, become ``node, level, leaves, saved``: the sums over what the part has of each subtree."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, due, queue = None, [], SpillingQueue(limit)
        for batch in batches:
            if not batch.num_rows:
                continue
            part, level = _ints(batch, "part"), _ints(batch, "level")
            node, parent = _binary16(_column(batch, "node")), _binary16(_column(batch, "parent"))
            sums = np.stack([_ints(batch, "leaves"), _ints(batch, "saved")], axis=1)
            edges = (np.flatnonzero((part[1:] != part[:-1]) | (level[1:] != level[:-1])) + 1).tolist()
            for lo, hi in zip([0, *edges], [*edges, len(part)]):
                now = (int(part[lo]), int(level[lo]))
                if now != at:
                    # Levels fall by one within a part; what is left over went to another part's node.
                    waits = at is not None and (at[0], at[1] - 1) == now
                    due, at, queue = queue.drain() if waits else [], now, SpillingQueue(limit)
                for run in due:
                    for got, extra in run.take(node[hi - 1]):
                        np.add.at(sums, lo + np.searchsorted(node[lo:hi], got), extra)
                queue.push(parent[lo:hi], sums[lo:hi])
            yield pa.RecordBatch.from_arrays(
                [_column(batch, "node"), _column(batch, "level"), pa.array(sums[:, 0]), pa.array(sums[:, 1])],
                names=["node", "level", "leaves", "saved"],
            )

    return work


def _in_parts(nodes: DataFrame, limit: int) -> DataFrame:
    """``time_forward`` in every part of ``nodes``; the roots that shards have in common add up."""
    dealt = nodes.repartition("part").sortWithinPartitions("part", F.desc("level"), "node")
    done = dealt.select("part", "level", "node", "parent", "leaves", "saved").mapInArrow(
        time_forward(limit), "node binary, level long, leaves long, saved long"
    )
    return done.groupBy("node", "level").agg(F.sum("leaves").alias("leaves"), F.sum("saved").alias("saved"))


def subtree_sums(nodes: DataFrame, tops: DataFrame, scratch: Scratch, band: int = BAND, limit: int = QUEUE_ROWS) -> DataFrame:
    """(node, level, leaves, saved) over whole subtrees.

    ``nodes``: shard, level, node, parent, leaves, saved, each node in every shard that
    meets it and valued in one. ``tops``: shard, level, node, above, for the nodes at
    levels that ``band`` divides; ``above`` is the ancestor at the top of the band before.
    """
    dealt = nodes.withColumn("part", F.xxhash64("shard", F.expr(f"level div {band}")))
    deepest = nodes.agg(F.max("level")).first()[0] or 0
    if deepest < band:
        return _in_parts(dealt, limit)
    # The tops of the bands, each with the sum of its band, are a smaller trie.
    inside = _in_parts(dealt, limit).filter(f"level > 0 AND level % {band} = 0")
    valued = inside.join(tops.groupBy("node", "level").agg(F.min("shard").alias("shard")), ["node", "level"])
    small = tops.filter("level > 0").join(valued, ["node", "level", "shard"], "left")
    small = small.select(
        F.xxhash64("shard").alias("part"),
        F.expr(f"level div {band}").alias("level"),
        "node",
        F.col("above").alias("parent"),
        F.coalesce("leaves", F.lit(0)).alias("leaves"),
        F.coalesce("saved", F.lit(0)).alias("saved"),
    )
    whole = scratch.table(_in_parts(small, limit).withColumn("level", F.col("level") * band), "tops")
    # Their whole sums are further values of the nodes that the bands hang on.
    hung = whole.join(nodes.select("node", "level", "parent", "shard"), ["node", "level"])
    once = hung.groupBy("node", "level").agg(F.min(F.struct("shard", "parent", "leaves", "saved")).alias("x"))
    more = once.groupBy("x.shard", (F.col("level") - 1).alias("level"), F.col("x.parent").alias("node")).agg(
        F.sum("x.leaves").alias("more_leaves"), F.sum("x.saved").alias("more_saved")
    )
    fed = dealt.join(more, ["shard", "level", "node"], "left").withColumns(
        {x: F.col(x) + F.coalesce(f"more_{x}", F.lit(0)) for x in ("leaves", "saved")}
    )
    return _in_parts(fed, limit)


# ---- lists of ids ------------------------------------------------------------------------------


def id_digests(ends: DataFrame, scratch: Scratch) -> DataFrame:
    """(depth, node, ends_sha256) of ``depth, node, conv_id``: SHA-256 of each node's ids, ascending, joined by commas.

    Lists inside one sorted range are hashed there; those that go on in the next range, or are long,
    leave it as joined pieces, which one task hashes in order (as the digest asks) without holding them.
    """
    pieces = _ranged(ends, "depth", "node", "conv_id").select("pid", "depth", "node", "conv_id")
    kinds = "depth long, node binary, ends_sha256 string, pid int, seq long, ids binary"
    found = scratch.table(pieces.mapInArrow(_pieces, kinds), "ends")
    rest = found.filter("ends_sha256 IS NULL").repartition("depth", "node").sortWithinPartitions("depth", "node", "pid", "seq")
    joined = rest.mapInArrow(_hashed, "depth long, node binary, ends_sha256 string")
    return found.filter("ends_sha256 IS NOT NULL").select("depth", "node", "ends_sha256").unionByName(joined)


def _pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    names = ["depth", "node", "ends_sha256", "pid", "seq", "ids"]
    kinds = [pa.int64(), pa.binary(), pa.string(), pa.int32(), pa.int64(), pa.binary()]
    at, held, size, loose, pid, seq, out = None, [], 0, True, 0, 0, []

    def flush(last: bool) -> None:
        nonlocal held, size, seq
        text = b",".join(held)
        if loose or last:
            out.append((*at, None, pid, seq, text))
            seq += 1
        else:
            out.append((*at, hashlib.sha256(text).hexdigest(), pid, seq, None))
        held, size = [], 0

    def rows() -> pa.RecordBatch:
        columns = list(zip(*out)) or [()] * 6
        out.clear()
        return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=names)

    first = True
    for batch in batches:
        for p, d, n, c in zip(*(_column(batch, x).to_pylist() for x in ("pid", "depth", "node", "conv_id"))):
            if (d, n) != at:
                if at is not None:
                    flush(False)
                at, pid, loose, first = (d, n), p, first, False
            held.append(b"%d" % c)
            size += len(held[-1]) + 1
            if size > PIECE_BYTES:
                loose = True
                flush(False)
        yield rows()
    if at is not None:
        flush(True)
    yield rows()


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    at, digest = None, None
    for batch in batches:
        out = []
        for d, n, ids in zip(*(_column(batch, x).to_pylist() for x in ("depth", "node", "ids"))):
            if not ids:
                continue
            if (d, n) != at:
                if at is not None:
                    out.append((*at, digest.hexdigest()))
                at, digest = (d, n), hashlib.sha256(ids)
            else:
                digest.update(b"," + ids)
        yield _three(out)
    if at is not None:
        yield _three([(*at, digest.hexdigest())])


def _three(rows: list) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [()] * 3
    kinds = (pa.int64(), pa.binary(), pa.string())
    return pa.RecordBatch.from_arrays([pa.array(c, type=k) for c, k in zip(columns, kinds)], names=["depth", "node", "ends_sha256"])


# ---- the operator ------------------------------------------------------------------------------


def prefix_trie(
    rebuilt: DataFrame, scratch: Scratch, together: Column | None = None, band: int = BAND, shard_rows: int = SHARD_ROWS, limit: int = QUEUE_ROWS
) -> DataFrame:
    """The trie of ``grafted`` rows, one row a node.

    ``together``: conversations that agree in it go to the same shard (by default each
    by its id); it changes how many shards meet a node, not the result.
    """
    rows = named(rebuilt, scratch)
    shards = max(1, rows.count() // shard_rows)
    shard = F.pmod(F.xxhash64(F.col("conv_id") if together is None else together), F.lit(shards))
    seen = rows.groupBy(shard.alias("shard"), "depth", "node", "parent").agg(
        F.count("*").alias("n"), F.min("conv_id").alias("conv_id"), F.max("len").alias("deepest"), F.max("size").alias("size")
    )
    seen = scratch.table(seen, "seen")
    nodes = seen.groupBy("depth", "node", "parent").agg(
        F.sum("n").alias("n_convs"), F.min("conv_id").alias("conv_id"), F.max("deepest").alias("deepest"), F.max("size").alias("size")
    )
    nodes = scratch.table(nodes, "nodes")

    # A node is valued in the shard of its smallest member.
    value = nodes.select(
        "depth", "node", "conv_id",
        F.when(F.col("deepest") == F.col("depth"), 1).otherwise(0).cast("long").alias("leaves"),
        ((F.col("n_convs") - 1) * F.col("size")).alias("saved"),
    )
    valued = seen.join(value, ["depth", "node", "conv_id"], "left").select(
        "shard", F.col("depth").alias("level"), "node", "parent",
        F.coalesce("leaves", F.lit(0)).alias("leaves"), F.coalesce("saved", F.lit(0)).alias("saved"),
    )
    at_top = rows.filter(f"depth % {band} = 0").select(shard.alias("shard"), "conv_id", F.col("depth").alias("level"), "node")
    above = at_top.select("conv_id", (F.col("level") + band).alias("level"), F.col("node").alias("above"))
    tops = at_top.join(above, ["conv_id", "level"], "left").select("shard", "level", "node", "above").distinct()
    sums = subtree_sums(valued, tops, scratch, band, limit)

    parents = nodes.select((F.col("depth") + 1).alias("depth"), F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    known = nodes.join(parents, ["depth", "parent"], "left").select("depth", "node", "conv_id", "n_convs", "parent_conv_id")
    children = nodes.filter("depth > 0").select((F.col("depth") - 1).alias("depth"), F.col("parent").alias("node"), F.lit(1).alias("child"))
    ends = id_digests(rows.filter("depth = len").select("depth", "node", "conv_id"), scratch)
    facts = (
        known.unionByName(children, allowMissingColumns=True)
        .unionByName(sums.withColumnRenamed("level", "depth"), allowMissingColumns=True)
        .unionByName(ends, allowMissingColumns=True)
    )
    return (
        facts.groupBy("depth", "node")
        .agg(
            F.max("conv_id").alias("conv_id"),
            F.max("parent_conv_id").alias("parent_conv_id"),
            F.max("n_convs").alias("n_convs"),
            F.coalesce(F.sum("child"), F.lit(0)).alias("n_children"),
            F.max("leaves").alias("n_leaves"),
            F.max("saved").alias("saved_tokens"),
            F.coalesce(F.max("ends_sha256"), F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"),
        )
        .drop("node")
    )
