"""Connected components of links, by alternating large and small stars."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.llm.scratch import Scratch


def _large_star(links: DataFrame) -> DataFrame:
    """Every larger neighbour of a node gets the node's least neighbour (or the node itself)."""
    both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(links: DataFrame) -> DataFrame:
    """A node and its smaller neighbours all get its least neighbour. Links point from larger to smaller."""
    least = links.groupBy("u").agg(F.min("v").alias("m"))
    moved = links.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


#: Nodes whose links are held at once where a partition's links become stars.
HELD = 200_000


def _local_stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A partition's links ``u, v`` as stars around the smallest nodes of what it links, ``HELD`` nodes at a time."""
    parent: dict = {}

    def root(x):
        while parent.get(x, x) != x:
            parent[x] = x = parent.get(parent[x], parent[x])
        return x

    def stars(schema: pa.Schema) -> pa.RecordBatch:
        rows = [(x, root(x)) for x in list(parent)]
        rows = [(x, r) for x, r in rows if x != r]
        parent.clear()
        return pa.RecordBatch.from_arrays([pa.array([r[k] for r in rows], type=schema.types[k]) for k in (0, 1)], schema=schema)

    schema = None
    for batch in batches:
        schema = batch.schema
        for u, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            u, v = root(u), root(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
        if len(parent) > HELD:
            yield stars(schema)
    if schema is not None:
        yield stars(schema)


def components(links: DataFrame, scratch: Scratch, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root): the smallest node reachable, for every node that has a link.

    The links of each partition become stars first. Then each round is a few joins
    and map-side combined aggregations on written links; the rounds end when all
    links are stars, that is, when no link leads to a node that has a smaller
    one. No group is gathered, and nothing but that reaches the driver.
    """
    u, v = F.greatest(a, b), F.least(a, b)
    pairs = links.filter(F.col(a) != F.col(b)).select(u.alias("u"), v.alias("v"))
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in pairs.schema)
    now = scratch.table(pairs.mapInArrow(_local_stars, kinds).distinct(), "links")
    # a star: every node has one link, and it leads to a node without any
    while not _stars(now):
        now = scratch.table(_small_star(_large_star(now)), "stars")
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _stars(links: DataFrame) -> bool:
    ends = links.select(F.col("u").alias("x"), F.lit(1).alias("up")).unionByName(links.select(F.col("v").alias("x"), F.lit(0).alias("up")).distinct())
    seen = ends.groupBy("x").agg(F.sum("up").alias("ups"), F.count("*").alias("all"))
    return seen.filter("ups > 1 OR ups = 1 AND all > 1").isEmpty()
