"""Bronze without duplicates and without growing stream state.

``dropDuplicates`` in a stream is exact only while it keeps every id in its state for
good; a watermark bounds the state and lets late copies through. Here the stream
has no state. Each micro-batch is reduced to one row per key, and the keys that
are new are found by an anti-join with a ledger of all keys so far: 128-bit
digests, partitioned by hash bucket, of which the batch's buckets are read. Rows and
keys are added in folders of their own and committed together under the batch's
number, so a batch delivered again changes nothing, and a copy is dropped whenever
it comes. Of copies in one batch the earliest, then smallest, stays. Buckets that
have gathered many folders are rewritten as one.
"""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.sources.commits import Commits
from paysignal.sources.storage import TableStore, remove
from paysignal.streaming import bronze

KEYS, ROWS = "bronze_keys", "bronze_rows"
BUCKETS = 256
FOLDERS = 16


def step(store: TableStore, batch: DataFrame, number: int, buckets: int = BUCKETS) -> dict:
    """Add the rows of ``batch`` (with ``_dedup_key``) whose key is new."""
    spark, commits = store.spark, Commits(store, "bronze")
    before = commits.current()
    if before.batch is not None and number <= before.batch:
        return {"batch": number, "applied": False, "added": 0}
    stage = f"{store.root}/_stage/{uuid.uuid4().hex}"
    try:
        columns = [c for c in batch.columns if c != "_dedup_key"]
        first = F.struct(F.col("timestamp").alias("_at"), *[F.col(c) for c in columns])
        once = batch.groupBy(F.unhex(F.md5(F.col("_dedup_key").cast("binary"))).alias("key")).agg(F.min(first).alias("_row"))
        once = once.withColumn("bucket", F.pmod(F.xxhash64("key"), F.lit(int(buckets))).cast("int"))
        once.select("key", "bucket", *[F.col(f"_row.{c}").alias(c) for c in columns]).write.parquet(stage)
        new = spark.read.parquet(stage)
        touched = {r.bucket for r in new.select("bucket").distinct().collect()}  # at most ``buckets``
        rewritten: set[int] = set()
        if before.version(KEYS) is not None:
            known = store.read(KEYS, before.version(KEYS)).filter(F.col("bucket").isin(*touched))
            new = new.join(known.select("key", "bucket"), ["bucket", "key"], "left_anti")
            folders = Counter(int(x.rsplit("=", 1)[-1]) for x in store.partitions(KEYS, before.version(KEYS)))
            rewritten = {b for b in touched if folders[b] >= FOLDERS}
        keys = new.select("key", "bucket")
        if rewritten:
            keys = keys.unionByName(known.filter(F.col("bucket").isin(*rewritten)).select("key", "bucket"))
        names = {str(b) for b in rewritten}
        rows = new.select(*columns, F.lit(int(number)).alias("_batch"))
        versions = {
            KEYS: store.replace_partitions(KEYS, keys, "bucket", names.__contains__, before.version(KEYS)),
            ROWS: store.replace_partitions(ROWS, rows, "_batch", lambda _: False, before.version(ROWS)),
        }
        commits.commit(before, versions, number)
        added = store.read(ROWS, versions[ROWS]).filter(F.col("_batch") == number).count()
    finally:
        remove(spark, stage)
    return {"batch": number, "applied": True, "added": added}


def rows(store: TableStore) -> DataFrame:
    return store.read(ROWS, Commits(store, "bronze").current().version(ROWS)).drop("_batch")


def run(
    spark: SparkSession,
    store: TableStore,
    source_root: str,
    checkpoint: str,
    pattern: str = "*.csv",
    buckets: int = BUCKETS,
    max_files_per_trigger: int | None = None,
) -> dict:
    """All files that are new since the last run; the batches, and the rows of state the stream held (none)."""
    stream = bronze.read_source_stream(spark, source_root, pattern, max_files_per_trigger)
    done: list[dict] = []
    query = (
        bronze.prepare_bronze(stream, dedup=False)
        .writeStream.foreachBatch(lambda batch, number: done.append(step(store, batch, number, buckets)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    state = sum(o["numRowsTotal"] for p in query.recentProgress for o in p["stateOperators"])
    return {"batches": done, "added": sum(x["added"] for x in done), "state_rows": state}
