"""End-to-end jobs over versioned storage: Bronze, Silver, SCD2, scoring, Gold.

Each job reads committed tables, writes a new version, and hands over to
the next job through storage (no driver-side data). Intermediate results
that several consumers need are written once and read back (the checked
Silver rows are written partitioned by ``_is_valid``: the ``false``
partition is the quarantine, the ``true`` partition feeds Silver), so
nothing is recomputed per consumer and lineage stays short if executors are
lost.

CLI: ``python -m paysignal.plans.jobs <job> --root <shared folder> [...]``.
"""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.config import LENIENT, STRICT, QualityProfile, RuleConfig
from paysignal.operators import dedup, gold, quality, rules, scd2
from paysignal.operators import keys
from paysignal.operators.keys import estimated_bytes
from paysignal.session import size_shuffles
from paysignal.plans import bronze_store, dimension_store, incremental, live
from paysignal.sources import files
from paysignal.schema import CUSTOMER_RAW
from paysignal.sources.storage import TableStore
from paysignal.streaming import bronze as bronze_stream

# Table names of the layers.
BRONZE, CHECKED, SILVER, SCORED = "bronze_transactions", "silver_checked", "silver_transactions", "fraud_scored_transactions"
QUARANTINE = "quarantine_transactions"
FRAUD, MULES, MERCHANT_KPI, DIM = "fraud_transactions", "mule_accounts", "daily_merchant_fraud_kpi", "customer_device_scd2"


def bronze_job(spark: SparkSession, root: str, source_root: str, pattern: str = "*.csv", **kw) -> dict:
    """Incremental file ingestion into the Bronze table (streaming, run once)."""
    path = f"{root.rstrip('/')}/{BRONZE}"
    progress = bronze_stream.run_bronze(spark, source_root, path, f"{root.rstrip('/')}/_checkpoints/{BRONZE}", pattern, **kw)
    spark.sql(f"CREATE DATABASE IF NOT EXISTS bronze LOCATION '{root.rstrip('/')}/_catalog/bronze.db'")
    spark.sql(f"DROP TABLE IF EXISTS bronze.`{BRONZE}`")
    spark.sql(f"CREATE TABLE bronze.`{BRONZE}` USING parquet LOCATION '{path}'")
    return {"bronze_path": path, **progress}


def silver_job(
    spark: SparkSession,
    store: TableStore,
    bronze: DataFrame | None = None,
    as_of=None,
    profile: QualityProfile = STRICT,
    dedup_first: bool | None = None,
) -> dict:
    """E2 (steps 1-2): validate, quarantine, write Silver.

    ``bronze`` defaults to the Bronze parquet written by ``bronze_job``, which
    the stream has deduplicated: its rows are validated as they are. Other
    sources are deduplicated before (``dedup_first=True``) or after validation
    (``False``: every copy of a repeated row is quarantined).

    The checked rows are written once, by validity and date: the valid
    partition is Silver (``read_silver``), the other the quarantine. Only
    deduplication after validation needs a Silver table of its own. Every row
    keeps its source file, and ``_ingestion_timestamp`` is the time of this run."""
    if bronze is None:
        bronze = spark.read.parquet(f"{store.root}/{BRONZE}")
    size_shuffles(spark, estimated_bytes(bronze))
    rows = bronze.withColumn("_ingestion_timestamp", F.current_timestamp())
    if dedup_first:
        rows = dedup.keep_first(rows.withColumn("timestamp", quality._ts(rows)))
    checked = quality.add_quality_rules(rows, profile, as_of).withColumn("status", F.upper("status"))
    checked = checked.withColumn("transaction_date", F.to_date("timestamp"))
    version = store.write(CHECKED, checked, partition_by=["_is_valid", "transaction_date"])
    stored = read_checked(store)
    if dedup_first is False:
        valid = stored.filter(F.col("_is_valid")).drop(*profile.rules, *quality.DQ_COLUMNS)
        store.write(SILVER, dedup.keep_first(valid), partition_by=["transaction_date"], version=version)
    keys.release()
    register_silver(store)
    s = quality.summarize(stored).first()
    return {"total_rows": s.total_rows, "valid_rows": s.valid_rows, "invalid_rows": s.invalid_rows}


def read_checked(store: TableStore) -> DataFrame:
    # partition values come back as text; restore the boolean
    return store.read(CHECKED).withColumn("_is_valid", F.col("_is_valid").cast("boolean"))


def read_silver(store: TableStore) -> DataFrame:
    """Silver rows, without the rule columns: the valid partition of the checked
    rows, or the table that belongs to that version."""
    if store.exists(SILVER) and store.current_version(SILVER) == store.current_version(CHECKED):
        return store.read(SILVER)
    stored = read_checked(store)
    return stored.filter(F.col("_is_valid")).drop(*STRICT.rules, *LENIENT.rules, *quality.DQ_COLUMNS)


def register_silver(store: TableStore, database: str = "silver") -> list[str]:
    """The checked rows as a catalog table, Silver and the quarantine as views of it
    (Silver as a table where it has one of its own)."""
    spark = store.spark
    store.register(CHECKED, database)
    flags = ", ".join(sorted({*STRICT.rules, *LENIENT.rules, *quality.DQ_COLUMNS} & set(read_checked(store).columns)))
    if store.exists(SILVER) and store.current_version(SILVER) == store.current_version(CHECKED):
        store.register(SILVER, database, f"{SILVER}_table")
        spark.sql(f"CREATE OR REPLACE VIEW `{database}`.`{SILVER}` AS SELECT * FROM `{database}`.`{SILVER}_table`")
    else:
        spark.sql(
            f"CREATE OR REPLACE VIEW `{database}`.`{SILVER}` AS SELECT * EXCEPT ({flags}) FROM `{database}`.`{CHECKED}` "
            "WHERE CAST(_is_valid AS BOOLEAN)"
        )
    spark.sql(
        f"CREATE OR REPLACE VIEW `{database}`.`{QUARANTINE}` AS SELECT * FROM `{database}`.`{CHECKED}` "
        "WHERE NOT CAST(_is_valid AS BOOLEAN)"
    )
    return [f"{database}.{x}" for x in (CHECKED, SILVER, QUARANTINE)]


def quarantine(store: TableStore) -> DataFrame:
    """The quarantine table: the ``_is_valid=false`` partition of the checked rows."""
    return read_checked(store).filter(~F.col("_is_valid"))


def score_job(store: TableStore, cfg: RuleConfig | None = None) -> dict:
    """E2 (step 3): score Silver, write partitioned by transaction_date."""
    silver = read_silver(store)
    size_shuffles(silver.sparkSession, estimated_bytes(silver))
    scored = rules.score(silver, cfg or RuleConfig())
    version = store.write(SCORED, scored, partition_by=["transaction_date"])
    keys.release()
    store.register(SCORED, "gold")
    return {"scored_version": version}


def rescore_job(store: TableStore, start, end, cfg: RuleConfig | None = None) -> dict:
    """Incremental: recompute only [start, end] dates of the scored table."""
    version = incremental.rescore_into(store, read_silver(store), SCORED, start, end, cfg)
    keys.release()
    store.register(SCORED, "gold")
    return {"scored_version": version, "start": str(start), "end": str(end)}


def gold_job(spark: SparkSession, store: TableStore, computed_at=None, database: str = "gold") -> dict:
    """E2 (step 4): Gold tables from the stored scores, clustered for
    investigators' lookups, registered in the catalog."""
    scored = store.read(SCORED)
    fraud = gold.fraud_transactions(scored)
    store.write(FRAUD, fraud, partition_by=["transaction_date"], cluster_by=["transaction_date", "user_id"])
    store.write(MULES, gold.mule_accounts(scored), cluster_by=["user_id"])
    kpi_at = F.current_timestamp() if computed_at is None else computed_at
    store.write(
        MERCHANT_KPI, gold.merchant_kpi(store.read(FRAUD), kpi_at),
        partition_by=["transaction_date"], cluster_by=["transaction_date", "merchant_category"],
    )
    return {name: store.register(name, database) for name in (FRAUD, MULES, MERCHANT_KPI)}


def scd2_job(spark: SparkSession, store: TableStore, source: DataFrame, as_of=None, database: str = "dim") -> dict:
    """First load, or one SCD2 step written as a new version (one commit);
    nothing is written when the snapshot changes nothing."""
    if not store.exists(DIM):
        store.write(DIM, scd2.initialize(source, as_of))
        action = "initialized"
    else:
        # one join: apply with a change marker, keep it (memory and disk), write only if something changed
        nxt = scd2.apply(store.read(DIM), source, as_of, mark_changes=True).persist()
        if nxt.filter(F.col("_changed")).isEmpty():
            action = "no-op"
        else:
            store.write(DIM, nxt.drop("_changed"))
            action = "applied"
        nxt.unpersist()
    table = store.register(DIM, database)
    scd2.current(store.read(DIM)).createOrReplaceTempView("customer_dim_current")
    active = spark.sql("SELECT COUNT(*) AS active_customer_count FROM customer_dim_current").first()[0]
    return {"action": action, "version": store.current_version(DIM), "table": table, "active_customer_count": active}


def main(argv=None) -> None:
    from paysignal.session import get_spark

    p = argparse.ArgumentParser(prog="paysignal-jobs")
    p.add_argument(
        "job",
        choices=["bronze", "silver", "score", "rescore", "gold", "scd2", "all", "bronze-store", "live", "dimension"],
        help="all: bronze to gold; bronze-store, live and dimension keep stores up to date batch by batch",
    )
    p.add_argument("--root", required=True, help="shared folder holding the tables")
    p.add_argument("--source", help="raw CSV folder (bronze) or customer snapshot file (scd2)")
    p.add_argument("--pattern", default="*.csv", help="file name glob of new source files (bronze)")
    p.add_argument("--as-of", default=None, help="as-of time for timestamp_not_future (silver) or the SCD2 date")
    p.add_argument("--start", help="first transaction date to rescore (rescore)")
    p.add_argument("--end", help="last transaction date to rescore (rescore)")
    p.add_argument("--state-store", choices=["rocksdb", "memory"], default="rocksdb", help="dedup state store (bronze)")
    p.add_argument("--max-files-per-trigger", type=int, default=None, help="files per micro-batch (bronze)")
    p.add_argument("--within-watermark", action="store_true", help="bounded dedup state (bronze)")
    p.add_argument("--drop-late", action="store_true", help="drop rows older than the watermark, and report how many (bronze)")
    p.add_argument("--by-own-header", action="store_true", help="read every file by its own header (bronze)")
    p.add_argument("--rules", default=None, help='RuleConfig fields as JSON, e.g. {"velocity_limit": 200}')
    a = p.parse_args(argv)
    cfg = RuleConfig(**json.loads(a.rules)) if a.rules else RuleConfig()
    spark = get_spark("paysignal-" + a.job)
    store = TableStore(spark, a.root)
    out = {}
    if a.job in ("bronze", "all"):
        out["bronze"] = bronze_job(
            spark, a.root, a.source, a.pattern, state_store=a.state_store,
            max_files_per_trigger=a.max_files_per_trigger, within_watermark=a.within_watermark,
            drop_late=a.drop_late, by_own_header=a.by_own_header,
        )
    if a.job in ("silver", "all"):
        out["silver"] = silver_job(spark, store, as_of=a.as_of)
    if a.job in ("score", "all"):
        out["score"] = score_job(store, cfg)
    if a.job == "rescore":
        out["rescore"] = rescore_job(store, a.start, a.end, cfg)
    if a.job in ("gold", "all"):
        out["gold"] = gold_job(spark, store)
    if a.job == "scd2":
        out["scd2"] = scd2_job(spark, store, files.read_table(spark, a.source, schema=CUSTOMER_RAW), a.as_of)
    checkpoint = f"{a.root.rstrip('/')}/_checkpoints"
    if a.job == "bronze-store":
        out["bronze-store"] = bronze_store.run(
            spark, store, a.source, f"{checkpoint}/bronze-store", a.pattern, max_files_per_trigger=a.max_files_per_trigger
        )
    if a.job == "live":  # --source: the folder of Bronze files (default: the one of the bronze job)
        out["live"] = live.run(
            spark, store, a.source or f"{store.root}/{BRONZE}", f"{checkpoint}/live", cfg, a.as_of,
            max_files_per_trigger=a.max_files_per_trigger,
        )
    if a.job == "dimension":
        out["dimension"] = dimension_store.step(store, files.read_table(spark, a.source, schema=CUSTOMER_RAW), a.as_of)
    print(json.dumps(out, default=str))


if __name__ == "__main__":
    main()
