"""The customer dimension in two parts, changed where a snapshot changes it.

* current versions, partitioned by a hash bucket of the user;
* closed versions, partitioned by the day they were closed on: only ever added to.

A step compares the snapshot with (user, hash) of the current versions, reads and
rewrites the buckets that hold a changed or new user, adds the versions it closed as
one folder of history, and commits both at once. Bytes written grow with the
buckets touched, never with the history. A snapshot without changes writes nothing.
The dimension equals that of ``scd2.apply`` after the same steps.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.operators import scd2
from paysignal.schema import DIM_COLUMNS
from paysignal.sources.commits import Commits
from paysignal.sources.storage import TableStore, remove

CURRENT, HISTORY = "dim_current", "dim_history"
BUCKETS = 256


def _bucketed(df: DataFrame, buckets: int) -> DataFrame:
    return df.withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(int(buckets))).cast("int"))


def step(store: TableStore, source: DataFrame, as_of=None, buckets: int = BUCKETS) -> dict:
    spark, commits = store.spark, Commits(store, "dimension")
    before = commits.current()
    snapshot = _bucketed(scd2.initialize(source, as_of), buckets)
    if not before.number:
        after = commits.commit(before, {CURRENT: store.write(CURRENT, snapshot, ["bucket"])})
        return {"action": "initialized", "commit": after.number}
    current = store.read(CURRENT, before.version(CURRENT))
    stage = f"{store.root}/_stage/{uuid.uuid4().hex}"
    try:
        held = current.select("user_id", F.col("record_hash").alias("_held"))
        changes = snapshot.join(held, "user_id", "left").filter(F.col("_held").isNull() | (F.col("_held") != F.col("record_hash")))
        changes.withColumn("_closes", F.col("_held").isNotNull()).drop("_held").write.parquet(stage)
        changes = spark.read.parquet(stage)
        touched = {r.bucket for r in changes.select("bucket").distinct().collect()}  # at most ``buckets``
        if not touched:
            return {"action": "no-op", "commit": before.number}
        near = current.filter(F.col("bucket").isin(*touched))
        new = changes.select("user_id", F.col("effective_start_date").alias("_day"), "_closes")
        met = near.join(new, "user_id", "left")
        kept = met.filter(F.col("_day").isNull()).select(*DIM_COLUMNS, "bucket")
        closed = met.filter("_closes").select(
            *[
                F.col("_day").alias(c) if c == "effective_end_date" else F.lit(False).alias(c) if c == "is_current" else F.col(c)
                for c in DIM_COLUMNS
            ],
            F.col("_day").alias("closed_on"),
        )
        names = {str(b) for b in touched}
        versions = {
            CURRENT: store.replace_partitions(
                CURRENT, kept.unionByName(changes.select(*DIM_COLUMNS, "bucket")), "bucket", names.__contains__, before.version(CURRENT)
            )
        }
        if not changes.filter("_closes").isEmpty():
            base = before.version(HISTORY)
            write = store.write(HISTORY, closed, ["closed_on"]) if base is None else store.replace_partitions(
                HISTORY, closed, "closed_on", lambda _: False, base
            )
            versions[HISTORY] = write
        after = commits.commit(before, versions)
    finally:
        remove(spark, stage)
    return {"action": "applied", "commit": after.number, "buckets": len(touched)}


def current(store: TableStore) -> DataFrame:
    return store.read(CURRENT, Commits(store, "dimension").current().version(CURRENT)).select(*DIM_COLUMNS)


def dimension(store: TableStore) -> DataFrame:
    """All versions, as of the last commit."""
    now = Commits(store, "dimension").current()
    rows = store.read(CURRENT, now.version(CURRENT)).select(*DIM_COLUMNS)
    if now.version(HISTORY) is None:
        return rows
    return rows.unionByName(store.read(HISTORY, now.version(HISTORY)).select(*DIM_COLUMNS))
