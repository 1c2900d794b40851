"""Exact top-k inner products by aggregation without random access (NRA).

The candidates are dealt into blocks by a hash. A block holds one sorted list
per dimension; for a query a list is read from the end where its contributions
are largest. Reading all lists in step, a candidate's score so far plus, for
each list it has not shown up in, the list's last contribution (lower) or the
last one read (upper) bounds its score. Candidates whose upper bound falls
below the k-th lower bound cannot qualify; when few are left, or the lists end,
their scores are resolved. Each block gives k candidates per query, and the
best of all blocks are the answer. One block goes first: the k-th score it
finds for a query is a bar from the start in the others.

Queries, too, are dealt into blocks, and every pair of blocks is one group, so
a task holds ``BLOCK`` candidates and ``QUERIES`` queries at any size.

Defined cases: vectors that are null, hold null or non-finite components, or
have a null id take no part; shorter vectors end in zeros; components must
keep floor(scale * x) and all scores below 2^53 (checked, an error otherwise);
of queries that repeat an id one is asked, while candidates that repeat an id
are rows of their own, except that none with the query's id is its candidate;
an empty table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysignal.llm.scratch import Scratch
from paysignal.llm.vectors import best, dimensions, pack, unpack, usable

BLOCK = 4096
QUERIES = 4096
#: How much of the lists has been read at each look at the bounds.
LOOKS = (0.45, 0.6, 0.75, 1.0)
#: So many candidates are resolved at once instead of reading on.
FEW = 256


class Lists:
    """One block: its vectors, and per dimension the candidates in the order of their values."""

    def __init__(self, ids: np.ndarray, vectors: np.ndarray):
        self.ids, self.vectors = ids, vectors
        columns = np.ascontiguousarray(vectors.T, dtype=np.float64)
        self.order = np.argsort(columns, axis=1, kind="stable")  # dimension x place, ascending
        self.values = np.take_along_axis(columns, self.order, axis=1)

    def top(self, query: np.ndarray, query_id: int, k: int, bar: float = -np.inf) -> tuple[np.ndarray, np.ndarray]:
        """(places of the k best that reach ``bar``, their scores), best first, ties to the smaller id."""
        n = len(self.ids)
        up, down = np.flatnonzero(query < 0), np.flatnonzero(query > 0)  # read from the low end, from the high end
        weight = np.concatenate((query[up], query[down])).astype(np.float64)
        least = weight * np.concatenate((self.values[up, -1], self.values[down, 0]))
        rows = (np.arange(len(weight)) * n)[:, None]
        total, seen = np.zeros(n), np.zeros((len(weight), n), dtype=np.float32)
        alive = self.ids != query_id
        at = 0
        for share in LOOKS:
            left = np.count_nonzero(alive)
            if left <= max(k, FEW) or not len(weight):
                break
            to = max(at + 1, int(share * n))
            who = np.concatenate((self.order[up, at:to], self.order[down, n - to : n - at]))
            gain = np.concatenate((self.values[up, at:to], self.values[down, n - to : n - at])) * weight[:, None]
            reached = np.concatenate((gain[: len(up), -1], gain[len(up) :, 0]))
            total += np.bincount(who.ravel(), weights=gain.ravel(), minlength=n)
            who += rows
            seen.ravel()[who.ravel()] = 1
            at = to
            held = np.stack((least, reached)).astype(np.float32) @ seen
            slack = 1e-5 * (np.abs(least).sum() + np.abs(reached).sum())  # of single precision
            lower = (total + (least.sum() - held[0]))[alive]
            bar = max(bar, np.partition(lower, left - k)[left - k] - slack)
            alive &= total + (reached.sum() - held[1]) >= bar - slack
        found = np.flatnonzero(alive)
        score = self.vectors[found] @ query
        first = np.lexsort((self.ids[found], -score))[:k]
        return found[first], score[first]


def search(
    df: DataFrame, is_query: Column, k: int = 5, key: str = "vec_id", vector: str = "embedding", scale: float = 256.0
) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k largest inner products of
    floor(scale * component) among all rows but those with the query's id."""
    rows = df.select(F.col(key).cast("long").alias("id"), F.col(vector).alias("vector"), is_query.alias("asks"))
    rows = rows.filter(F.col("id").isNotNull())
    dims = dimensions(rows, "vector")

    def floors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ok, matrix = usable(batch, "vector", dims)
            scaled = np.floor(scale * matrix)
            if len(scaled) and np.abs(scaled).max(initial=0) ** 2 * max(dims, 1) >= 2.0**53:
                raise ValueError("components are too large for exact scores")
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(ok)), batch.column(2).take(pa.array(ok)), pack(scaled.astype("<i8"))],
                names=["id", "asks", "vector"],
            )

    scratch = Scratch(df.sparkSession, "topk")
    clean = scratch.table(rows.mapInArrow(floors, "id long, asks boolean, vector binary"), "vectors")
    size = clean.agg(F.count("*").alias("n"), F.count_if("asks").alias("q")).first()
    blocks, parts = max(1, -(-size["n"] // BLOCK)), max(1, -(-size["q"] // QUERIES))

    def own(seed: int, of: int) -> Column:
        return F.pmod(F.xxhash64(F.lit(seed), "id", "vector"), F.lit(of)).cast("int")

    def each(of: int) -> Column:
        return F.explode(F.sequence(F.lit(0), F.lit(of - 1)))

    asked = clean.filter("asks").dropDuplicates(["id"]).select(own(7, parts).alias("part"), "id", "vector")
    held = clean.select(own(8, blocks).alias("block"), F.col("id").alias("vec_id"), F.col("vector").alias("held"))

    def meet(queries: pa.Table, candidates: pa.Table) -> pa.Table:
        found: list[tuple[int, np.ndarray, np.ndarray]] = []
        if len(queries) and len(candidates):
            block = Lists(candidates["vec_id"].to_numpy(), unpack(candidates["held"], dims, "<i8"))
            bars = queries["bar"].to_pylist()
            for query_id, query, bar in zip(queries["id"].to_pylist(), unpack(queries["vector"], dims, "<i8"), bars, strict=True):
                at, score = block.top(query, query_id, k, -np.inf if bar is None else bar)
                found.append((query_id, block.ids[at], score))
        return pa.table(
            {
                "query_id": pa.array([i for i, ids, _ in found for _ in ids], type=pa.int64()),
                "vec_id": pa.array(np.concatenate([ids for _, ids, _ in found] or [[]]), type=pa.int64()),
                "score": pa.array(np.concatenate([s for _, _, s in found] or [[]]), type=pa.int64()),
            }
        )

    def against(queries: DataFrame, first: int, last: int) -> DataFrame:
        """The best of blocks ``first`` to ``last``; ``queries`` has a ``bar`` that the answers reach."""
        left = queries.select("part", F.explode(F.sequence(F.lit(first), F.lit(last))).alias("block"), "id", "vector", "bar")
        right = held.filter(F.col("block").between(first, last)).select("block", each(parts).alias("part"), "vec_id", "held")
        keys = ["block", "part"]
        met = left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInArrow(meet, "query_id long, vec_id long, score long")
        return best(met, k)

    # The first block's k-th scores are a bar for all others, so those stop reading earlier.
    found = scratch.table(against(asked.withColumn("bar", F.lit(None).cast("double")), 0, 0), "first")
    if blocks > 1:
        bars = found.filter(F.col("rank") == k).select(F.col("query_id").alias("id"), F.col("score").cast("double").alias("bar"))
        rest = against(asked.join(bars, "id", "left").select("part", "id", "vector", "bar"), 1, blocks - 1)
        found = best(found.drop("rank").unionByName(rest.drop("rank")), k)
    return found
