"""Silver kept up to date batch by batch (D3, U4, S10, M5 beyond Bronze).

Every rule but one looks at a single row. ``utr_unique`` looks at all rows ever
seen, in both directions: a UTR that comes again fails the new row and takes back
the validity of the old one. Two tables, one commit:

* the ledger: every UTR with its number of copies and, while it has one, the date
  of that copy; partitioned by a hash bucket. A batch reads and rewrites the
  buckets its own UTRs fall into.
* the checked rows, partitioned by date. A batch adds its rows to their dates in
  folders of their own. A date is rewritten only if a row of it is taken back, or if
  it has gathered many folders. Silver is the valid rows, the quarantine the others.

A batch that is delivered again (same or lower number) changes nothing, and a step
that ends before its commit leaves the tables as they were, so ``stream_silver`` can
run on Spark's at-least-once ``foreachBatch``. The result of any sequence of batches
equals one run over all their rows. A UTR of any number of copies is one counted
row per task before it is shuffled; NULL is a UTR like the others.
"""

from __future__ import annotations

import uuid
from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.config import STRICT, QualityProfile
from paysignal.operators import quality
from paysignal.operators.keys import bounded
from paysignal.sources.commits import Commits
from paysignal.sources.storage import TableStore, remove

LEDGER, CHECKED = "utr_ledger", "silver_rows"
#: Hash buckets of the ledger (fixed when it is created), and folders of a date before it is rewritten as one.
BUCKETS = 256
FOLDERS = 16
NO_DATE = "__HIVE_DEFAULT_PARTITION__"


def _folder(day) -> str:
    return NO_DATE if day is None else str(day)


def _on_dates(df: DataFrame, days: set) -> DataFrame:
    known = sorted(str(d) for d in days if d is not None)
    inside = F.col("transaction_date").isin(*[F.lit(d).cast("date") for d in known]) if known else F.lit(False)
    return df.filter(inside | F.col("transaction_date").isNull() if None in days else inside)


def step(
    store: TableStore,
    batch: DataFrame,
    number: int | None = None,
    as_of=None,
    profile: QualityProfile = STRICT,
    buckets: int = BUCKETS,
) -> dict:
    """Apply one batch of Bronze rows; ``number`` is the batch's, rising from batch to batch."""
    spark, commits = store.spark, Commits(store, "silver")
    before = commits.current()
    if number is not None and before.batch is not None and number <= before.batch:
        return {"applied": False, "commit": before.number}
    stage = f"{store.root}/_stage/{uuid.uuid4().hex}"
    try:
        flagged = quality.add_quality_rules(batch, profile, as_of).withColumn("status", F.upper("status"))
        bucket = F.pmod(F.xxhash64("utr_number"), F.lit(int(buckets))).cast("int")
        flagged.withColumn("transaction_date", F.to_date("timestamp")).write.parquet(f"{stage}/rows")
        rows = spark.read.parquet(f"{stage}/rows")

        new = rows.groupBy("utr_number").agg(
            F.count(F.lit(1)).alias("_more"), F.max("transaction_date").alias("_date")
        ).withColumn("bucket", bucket)
        touched = {r.bucket for r in new.select("bucket").distinct().collect()}  # at most ``buckets``
        if before.version(LEDGER) is None:
            old = new.select("utr_number", F.col("_more").alias("n"), F.col("_date").alias("transaction_date"), "bucket").limit(0)
        else:
            old = store.read(LEDGER, before.version(LEDGER)).filter(F.col("bucket").isin(*touched))
        named = old.select(F.col("utr_number").alias("_utr"), "n", "transaction_date", F.col("bucket").alias("_bucket"))
        met = new["utr_number"].eqNullSafe(named["_utr"]) & (new["bucket"] == named["_bucket"])
        both = new.join(named, met, "full_outer").select(
            F.when(F.col("bucket").isNull(), F.col("_utr")).otherwise(F.col("utr_number")).alias("utr_number"),
            F.coalesce("n", F.lit(0)).alias("_old"),
            (F.coalesce("n", F.lit(0)) + F.coalesce("_more", F.lit(0))).alias("n"),
            F.when(F.col("n").isNull(), F.col("_date")).otherwise(F.col("transaction_date")).alias("transaction_date"),
            F.coalesce("bucket", "_bucket").alias("bucket"),
        )
        both.write.parquet(f"{stage}/ledger")
        ledger = spark.read.parquet(f"{stage}/ledger")

        # of the batch: every UTR that has copies now
        repeated, _ = bounded(ledger.filter("n > 1").select(F.col("utr_number").alias("_r")))
        joined = rows.join(repeated.withColumn("_hit", F.lit(True)), rows["utr_number"].eqNullSafe(repeated["_r"]), "left")
        fresh = quality.with_validity(joined.withColumn("utr_unique", F.col("_hit").isNull()).drop("_hit", "_r"), profile.rules)
        # of the rows before: those that were the only copy
        taken = ledger.filter("_old = 1 AND n > 1").select(F.col("utr_number").alias("_r"), F.col("transaction_date").alias("_d"))
        rewritten = {r["_d"] for r in taken.select("_d").distinct().collect()}  # one value a date
        added = {r[0] for r in rows.select("transaction_date").distinct().collect()}
        changed = sorted(str(d) for d in rewritten | added if d is not None)
        if before.version(CHECKED) is not None:
            folders = Counter(x.rsplit("=", 1)[-1] for x in store.partitions(CHECKED, before.version(CHECKED)))
            rewritten |= {d for d in added if folders[_folder(d)] >= FOLDERS}
        out = fresh
        if rewritten:
            stored = _on_dates(store.read(CHECKED, before.version(CHECKED)), rewritten).select(*fresh.columns)
            back, _ = bounded(taken)
            hit = stored["utr_number"].eqNullSafe(back["_r"]) & stored["transaction_date"].eqNullSafe(back["_d"])
            marked = stored.join(back.withColumn("_hit", F.lit(True)), hit, "left")
            unique = F.when(F.col("_hit"), F.lit(False)).otherwise(F.col("utr_unique"))
            out = out.unionByName(quality.with_validity(marked.withColumn("utr_unique", unique).drop("_hit", "_r", "_d"), profile.rules))

        names, gone = {_folder(d) for d in rewritten}, {str(b) for b in touched}
        versions = {
            LEDGER: store.replace_partitions(
                LEDGER, ledger.select("utr_number", "n", "transaction_date", "bucket"), "bucket", gone.__contains__, before.version(LEDGER)
            ),
            CHECKED: store.replace_partitions(CHECKED, out, "transaction_date", names.__contains__, before.version(CHECKED)),
        }
        after = commits.commit(before, versions, number, dates=",".join(changed))
    finally:
        remove(spark, stage)
    return {"applied": True, "commit": after.number, "buckets": len(touched), "dates_rewritten": len(rewritten)}


def checked(store: TableStore) -> DataFrame:
    """All rows with their rule columns, as of the last commit."""
    return store.read(CHECKED, Commits(store, "silver").current().version(CHECKED))


def silver(store: TableStore, profile: QualityProfile = STRICT) -> DataFrame:
    return checked(store).filter("_is_valid").drop(*profile.rules, *quality.DQ_COLUMNS)


def quarantine(store: TableStore) -> DataFrame:
    return checked(store).filter(~F.col("_is_valid"))


def stream_silver(
    spark: SparkSession,
    store: TableStore,
    bronze_path: str,
    checkpoint: str,
    as_of=None,
    profile: QualityProfile = STRICT,
    buckets: int = BUCKETS,
    max_files_per_trigger: int | None = None,
) -> list[dict]:
    """Every Bronze file that is new since the last run, batch by batch; stops when none is left."""
    reader = spark.readStream.schema(spark.read.parquet(bronze_path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    done: list[dict] = []
    query = (
        reader.parquet(bronze_path)
        .writeStream.foreachBatch(lambda rows, number: done.append(step(store, rows, number, as_of, profile, buckets)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done
