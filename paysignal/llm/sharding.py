"""Sharding by a two-pass external shuffle, in DataFrame functions only.

Pass 1 scatters whole records into memory-sized buckets by seeded hashes: the
shard from the key alone, the bucket inside the shard from the key and the
text. Pass 2 puts each bucket into one array, brings it into a fixed order and
lets Spark's seeded ``shuffle`` (a Fisher-Yates permutation) mix it. A bucket's
first slot is the number of records in the shard's earlier buckets, so slots
are gapless without any sort of a whole shard.

Shard law ``key``: rendezvous hashing. Each shard draws a hash of (seed, shard,
key) and the largest wins, so only key and shard count decide, and a further
shard takes records only into itself.

Defined cases: a null text counts one byte (its terminator); null keys are one
key, and so share a shard, but their buckets differ by text; repeated rows keep
a slot each; an empty table gives an empty result; any extra column travels in
``rec`` and cannot clash (its type must be orderable, so no maps).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

#: Bytes of text that a bucket is sized for; one task holds one bucket at a time.
BUCKET_BYTES = 16 << 20
#: Most shuffle partitions of the scatter; beyond it a task takes several buckets, one after another.
MAX_PARTITIONS = 50_000


def rendezvous(key: Column, shards: int, seed: int) -> Column:
    """Shard 0..shards-1 whose hash of (seed, shard, key) is largest."""
    draws = F.transform(
        F.sequence(F.lit(0), F.lit(shards - 1)),
        lambda i: F.struct(F.xxhash64(F.lit(seed), i, key).alias("draw"), i.alias("shard")),
    )
    return F.array_max(draws)["shard"]


def shuffle_shards(
    df: DataFrame,
    key: str = "doc_id",
    text: str = "text",
    shards: int = 16,
    seed: int = 20240229,
    bucket_bytes: int = BUCKET_BYTES,
) -> DataFrame:
    """``rec`` (the whole input row), ``shard``, ``slot`` (gapless from 0 in its
    shard) and ``grown_shard`` (the shard if there were one more)."""
    if shards < 1:
        raise ValueError("shards must be positive")
    size = F.coalesce(F.octet_length(text), F.lit(0)) + F.lit(1)
    total = df.agg(F.sum(size.cast("long"))).first()[0] or 0
    per_shard = max(1, -(-int(total) // (shards * bucket_bytes)))

    rec = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    spread = F.xxhash64(F.lit(seed + 1), F.col(key), F.col(text))
    rows = df.select(
        rendezvous(F.col(key), shards, seed).alias("shard"),
        F.pmod(spread, F.lit(per_shard)).cast("int").alias("bucket"),
        F.struct(spread.alias("h"), rec.alias("rec")).alias("item"),
    )

    # First slot of each bucket: one narrow count per bucket, summed over the shard's earlier buckets.
    before = W.partitionBy("shard").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    first = (
        rows.groupBy("shard", "bucket")
        .agg(F.count("*").alias("n"))
        .select("shard", "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first"))
    )
    mixed = (
        rows.repartition(min(shards * per_shard, MAX_PARTITIONS), "shard", "bucket")
        .groupBy("shard", "bucket")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
        .sortWithinPartitions("shard", "bucket")  # a retried task draws the same permutations
        .select("shard", "bucket", F.shuffle("items", F.lit(seed + 2)).alias("items"))
    )
    out = mixed.join(first, ["shard", "bucket"]).select(
        "shard", "first", F.posexplode("items").alias("pos", "item")
    )
    return out.select(
        F.col("item.rec").alias("rec"),
        "shard",
        (F.col("first") + F.col("pos")).alias("slot"),
        rendezvous(F.col(f"item.rec.`{key}`"), shards + 1, seed).alias("grown_shard"),
    )


def write_shards(df: DataFrame, path: str, **options) -> None:
    """Write the shuffled records, a folder per shard, each row with its slot."""
    out = shuffle_shards(df, **options)
    out.select("rec", "slot", "shard").write.partitionBy("shard").parquet(path)
