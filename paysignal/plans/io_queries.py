"""Registered queries for sources, sinks, streaming and incremental
scoring. Each writes what it derives from the driver's tables
to a fresh folder under the session's shared checkpoint folder, runs the
operator, and returns what it reads back."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.config import CONFIG_A, STRICT_RULES
from paysignal.functions.columns import inr_text
from paysignal.operators import alerts, gold, scd2
from paysignal.plans import bronze_store, bundle, dimension_store, gold_store, incremental, live, silver_store
from paysignal.schema import RAW, RAW_COLUMNS
from paysignal.session import shared_dir
from paysignal.sources import files, storage, tables
from paysignal.streaming import bronze

INCREMENTAL_RANGE = ("2024-01-10", "2024-01-12")
STREAM_SPLIT = "2024-01-16 00:00:00"


def scratch(spark: SparkSession, name: str) -> str:
    return shared_dir(spark, f"paysignal-{name}-{uuid.uuid4().hex[:12]}")


def _scored(spark, sf_dir):
    from paysignal.plans.queries import scored

    return scored(spark, sf_dir)


def _typed_bronze(df: DataFrame) -> DataFrame:
    """Bronze rows, and whether the audit columns are filled."""
    audited = F.col("_source_file").endswith(".csv") & F.col("_ingestion_timestamp").isNotNull()
    return df.select(*[F.col(c) for c in RAW_COLUMNS], audited.alias("audited"))


def bronze_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty raw rows as CSV files -> one availableNow run."""
    base = scratch(spark, "bronze")
    tables.dirty_raw_transactions(spark, sf_dir).write.option("header", True).csv(f"{base}/in")
    bronze.run_bronze(spark, f"{base}/in", f"{base}/bronze", f"{base}/_checkpoint")
    return _typed_bronze(spark.read.parquet(f"{base}/bronze"))


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two incremental runs; the second sees new files plus
    repeats of every first-run row, which are dropped."""
    base = scratch(spark, "dedup")
    raw = tables.dirty_raw_transactions(spark, sf_dir)
    ts = F.try_to_timestamp(F.col("timestamp"))
    early = raw.filter(F.coalesce(ts < F.lit(STREAM_SPLIT).cast("timestamp"), F.lit(False)))
    late = raw.filter(~F.coalesce(ts < F.lit(STREAM_SPLIT).cast("timestamp"), F.lit(False)))
    early.write.option("header", True).csv(f"{base}/in/run1")
    # the source root is a glob over run folders, re-listed on every run
    bronze.run_bronze(spark, f"{base}/in/*", f"{base}/bronze", f"{base}/_checkpoint", pattern="*.csv")
    late.unionByName(early).write.option("header", True).csv(f"{base}/in/run2")
    bronze.run_bronze(spark, f"{base}/in/*", f"{base}/bronze", f"{base}/_checkpoint", pattern="*.csv")
    return _typed_bronze(spark.read.parquet(f"{base}/bronze"))


def stream_late(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M4 M5: the newer half arrives first, then new rows that are older than
    any watermark; in one micro-batch a run and in one per file. No row is lost
    either way, and the run reports every row."""
    base = scratch(spark, "late")
    raw = tables.raw_transactions(spark, sf_dir)
    older = F.col("timestamp") < F.lit(STREAM_SPLIT)
    out = None
    for name, files_each in (("one", None), ("many", 1)):
        target = f"{base}/bronze_{name}", f"{base}/_checkpoint_{name}"
        reported = 0
        for run, part in (("run1", ~older), ("run2", older)):
            raw.filter(part).repartition(3).write.option("header", True).csv(f"{base}/{name}/{run}")
            done = bronze.run_bronze(spark, f"{base}/{name}/*", *target, max_files_per_trigger=files_each)
            reported += done["rows"]
        rows = _typed_bronze(spark.read.parquet(target[0])).select(
            F.lit(name).alias("batches"), "transaction_id", "timestamp", "audited",
            F.lit(reported).cast("long").alias("reported_rows"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose columns are in another order, with one more, read by
    their header names, in a batch and as a stream."""
    base = scratch(spark, "by-name")
    raw = tables.raw_transactions(spark, sf_dir)
    shuffled = [RAW_COLUMNS[1], RAW_COLUMNS[0], *reversed(RAW_COLUMNS[2:])]
    raw.select(*shuffled[:5], F.lit("more").alias("channel"), *shuffled[5:]).write.option("header", True).csv(f"{base}/in")
    batch = files.read_csv(spark, f"{base}/in", RAW).select(F.lit("batch").alias("reader"), *RAW_COLUMNS)
    bronze.run_bronze(spark, f"{base}/in", f"{base}/bronze", f"{base}/_checkpoint")
    typed = spark.read.parquet(f"{base}/bronze").withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"))
    return batch.unionByName(typed.select(F.lit("stream").alias("reader"), *RAW_COLUMNS))


def multi_format_read(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same raw rows through CSV, Parquet and JSON Lines readers."""
    base = scratch(spark, "formats")
    raw = tables.raw_transactions(spark, sf_dir)
    raw.write.option("header", True).csv(f"{base}/csv")
    raw.write.parquet(f"{base}/parquet")
    raw.write.json(f"{base}/jsonl")
    out = None
    for fmt in ("csv", "parquet", "jsonl"):
        df = files.read_table(spark, f"{base}/{fmt}", fmt=fmt, schema=RAW)
        df = df.select(F.lit(fmt).alias("format"), *RAW_COLUMNS)
        out = df if out is None else out.unionByName(df)
    return out


ENVELOPE_ROWS = 500


def json_envelope(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents of at most ENVELOPE_ROWS consecutive rows of an input
    partition, in five shapes by turns and in one folder, read back as records
    (many documents, read in parallel)."""
    base = scratch(spark, "envelope")
    # monotonically_increasing_id = partition id << 33 | row index: groups never straddle partitions
    doc = F.floor(F.monotonically_increasing_id() / F.lit(ENVELOPE_ROWS))
    raw = tables.raw_transactions(spark, sf_dir).withColumn("_p", doc)
    docs = raw.groupBy("_p").agg(F.collect_list(F.struct(*RAW_COLUMNS)).alias("rows"))
    rows = F.to_json("rows")
    columns = F.to_json(F.struct(*[F.col(f"rows.{c}").alias(c) for c in RAW_COLUMNS]))
    shape = F.col("_p") % 5
    text = (
        F.when(shape == 0, F.concat(F.lit('{"data": '), rows, F.lit("}")))
        .when(shape == 1, F.concat(F.lit('{"transactions": '), rows, F.lit("}")))
        .when(shape == 2, rows)
        .when(shape == 3, columns)
        .otherwise(F.concat(F.lit('{"data": '), columns, F.lit("}")))
    )
    # a file holds one document
    docs.select(text.alias("value")).write.option("maxRecordsPerFile", 1).text(f"{base}/docs")
    return files.read_table(spark, f"{base}/docs", fmt="json", schema=RAW)


SPLIT_BYTES = 20_000


def json_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rows of an input partition as one JSON array, read in byte ranges of
    ``SPLIT_BYTES``; every record holds a nested object and text with quotes and braces."""
    base = scratch(spark, "json-large")
    raw = tables.raw_transactions(spark, sf_dir)
    odd = F.concat(F.lit('say "}", \\ and {["'), "transaction_id")
    record = F.to_json(F.struct(*RAW_COLUMNS, odd.alias("note"), F.struct(odd.alias("in"), F.array(F.struct(odd.alias("x"))).alias("list")).alias("more")))
    rows = raw.select(record.alias("record"), F.spark_partition_id().alias("document"), F.monotonically_increasing_id().alias("at"))
    place = Window.partitionBy("document").orderBy("at")
    opened = F.when(F.lag("at").over(place).isNull(), F.lit('{"data": [\n')).otherwise(F.lit(","))
    closed = F.when(F.lead("at").over(place).isNull(), F.lit("]}")).otherwise(F.lit(""))
    lines = rows.select("document", F.concat(opened, "record", closed).alias("value"))
    lines.write.partitionBy("document").text(f"{base}/docs")
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(SPLIT_BYTES))
    try:
        wider = T.StructType([*RAW.fields, T.StructField("note", T.StringType())])
        files.read_json_array(spark, f"{base}/docs", wider).write.parquet(f"{base}/out")
    finally:
        spark.conf.set(name, before)
    return spark.read.parquet(f"{base}/out")


def csv_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The high-risk view's 10 columns as CSV with header, read back."""
    base = scratch(spark, "export")
    fraud = gold.fraud_transactions(_scored(spark, sf_dir))
    storage.csv_export(fraud, f"{base}/csv", alerts.HIGH_RISK_COLUMNS)
    schema = T.StructType(
        [
            T.StructField("transaction_id", T.StringType()),
            T.StructField("user_id", T.StringType()),
            T.StructField("timestamp", T.TimestampType()),
            T.StructField("amount", T.DoubleType()),
            T.StructField("location_city", T.StringType()),
            T.StructField("device_id", T.StringType()),
            T.StructField("merchant_category", T.StringType()),
            T.StructField("fraud_reason", T.StringType()),
            T.StructField("risk_score", T.IntegerType()),
            T.StructField("risk_level", T.StringType()),
        ]
    )
    return (
        spark.read.schema(schema).option("header", True).option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(f"{base}/csv")
    )


SCORED_OUT = (
    "transaction_id", "user_id", "timestamp", "amount", "merchant_category", "location_city", "device_id", "status",
    "transaction_date", "velocity_amount_1m", "device_users_10m", "velocity_check", "geo_anomaly",
    "device_mule_check", "failure_burst_check", "risk_score", "fraud_reason", "is_fraud", "risk_level",
)


def partitioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold fraud rows written partitioned by transaction_date, read back."""
    store = storage.TableStore(spark, scratch(spark, "store"))
    fraud = gold.fraud_transactions(_scored(spark, sf_dir)).select(*SCORED_OUT)
    store.write("fraud_transactions", fraud, partition_by=["transaction_date"])
    return store.read("fraud_transactions").select(*SCORED_OUT)


def clustered_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mule accounts range-clustered by user_id, read back."""
    store = storage.TableStore(spark, scratch(spark, "store"))
    store.write("mule_accounts", gold.mule_accounts(_scored(spark, sf_dir)), cluster_by=["user_id"])
    return store.read("mule_accounts")


MONEY = "CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE)"
# Both KPI collections on the catalog's Gold tables (E3): kpi -> (order, SELECT of name, n, amount, risk).
KPI_SQL = {
    "total": ("name", f"SELECT 'all' AS name, COUNT(*) AS n, {MONEY} AS amount, MAX(risk_score) AS risk FROM {{db}}.fraud_transactions"),
    "daily": ("name", f"SELECT CAST(transaction_date AS STRING) AS name, COUNT(*) AS n, {MONEY} AS amount, MAX(risk_score) AS risk "
              "FROM {db}.fraud_transactions GROUP BY transaction_date"),
    "merchants": ("n DESC, amount DESC, name", f"SELECT merchant_category AS name, COUNT(*) AS n, {MONEY} AS amount, MAX(risk_score) AS risk "
                  "FROM {db}.fraud_transactions GROUP BY merchant_category"),
    "cities": ("n DESC, amount DESC, name", f"SELECT location_city AS name, COUNT(*) AS n, {MONEY} AS amount, MAX(risk_score) AS risk "
               "FROM {db}.fraud_transactions GROUP BY location_city"),
    "hours": ("name", f"SELECT lpad(CAST(HOUR(timestamp) AS STRING), 2, '0') AS name, COUNT(*) AS n, {MONEY} AS amount, "
              "MAX(risk_score) AS risk FROM {db}.fraud_transactions GROUP BY HOUR(timestamp)"),
    "users": ("risk DESC, amount DESC, name", f"SELECT user_id AS name, COUNT(*) AS n, {MONEY} AS amount, MAX(risk_score) AS risk "
              "FROM {db}.fraud_transactions GROUP BY user_id"),
    "mules": ("n DESC, risk DESC, name", "SELECT user_id AS name, flagged_transaction_count AS n, CAST(NULL AS DOUBLE) AS amount, "
              "max_risk_score AS risk FROM {db}.mule_accounts"),
}
KPI_FIRST = {"users": 10, "mules": 20, "merchants": 10}  # how many rows the report shows


def kpi_statement(db: str) -> str:
    return " UNION ALL ".join(
        f"SELECT '{kpi}' AS kpi, position, name, n, amount, risk FROM (SELECT *, CAST(row_number() OVER (ORDER BY {order}) AS INT) "
        f"AS position FROM ({text.format(db=db)}))" + (f" WHERE position <= {KPI_FIRST[kpi]}" if kpi in KPI_FIRST else "")
        for kpi, (order, text) in KPI_SQL.items()
    )


def catalog_kpis(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold tables registered, both KPI collections run on them by SQL,
    each with the position in its order; the database goes afterwards."""
    base = scratch(spark, "kpis")
    store = storage.TableStore(spark, base)
    scored = _scored(spark, sf_dir).drop("fraud_reasons")
    store.write("scored", scored, partition_by=["transaction_date"])
    store.write("fraud_transactions", gold.fraud_transactions(store.read("scored")), partition_by=["transaction_date"])
    store.write("mule_accounts", gold.mule_accounts(store.read("scored")), cluster_by=["user_id"])
    db = f"kpi_{uuid.uuid4().hex[:8]}"
    try:
        for name in ("fraud_transactions", "mule_accounts"):
            store.register(name, db)
        spark.sql(kpi_statement(db)).write.parquet(f"{base}/result")
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    return spark.read.parquet(f"{base}/result")


# SQL KPI text run through the catalog (E3); amounts summed at cent precision.
CATALOG_KPI = """
SELECT merchant_category, COUNT(*) AS fraud_count,
       CAST(SUM(CAST(amount AS DECIMAL(18,2))) AS DOUBLE) AS fraud_amount
FROM {db}.fraud_transactions
GROUP BY merchant_category
ORDER BY fraud_count DESC, merchant_category
LIMIT 10
"""


def catalog_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """S13 + E3: Gold written, registered as a catalog table, queried by SQL."""
    store = storage.TableStore(spark, scratch(spark, "catalog"))
    store.write("fraud_transactions", gold.fraud_transactions(_scored(spark, sf_dir)).drop("fraud_reasons"),
                partition_by=["transaction_date"])
    db = f"gold_{uuid.uuid4().hex[:8]}"
    out = f"{store.root}/result"
    try:
        store.register("fraud_transactions", db)
        spark.sql(CATALOG_KPI.format(db=db)).write.parquet(out)
    finally:
        spark.sql(f"DROP DATABASE IF EXISTS `{db}` CASCADE")
    return spark.read.parquet(out)


STORED_LIMIT = 50


def precomputed_gold(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold of two sites. One has transactions only, and its Gold is computed. The
    other also has a stored output (which flags fewer rows), found after an empty
    one in a folder that is looked at before, and its Gold is that output's flagged rows."""
    base = scratch(spark, "site")
    raw = tables.dirty_raw_transactions(spark, sf_dir)
    out = None
    for branch in ("computed", "stored"):
        site = f"{base}/{branch}"
        raw.write.option("header", True).csv(f"{site}/sample_data/upi_transactions.csv")
        if branch == "stored":
            scored = bundle.bundle_from_root(spark, site, as_of=tables.DIRTY_AS_OF, cfg=CONFIG_A).scored
            scored = scored.select("transaction_id", "user_id", "amount", "risk_score", "risk_level")
            kept = scored.withColumn("is_fraud", F.col("risk_score") >= STORED_LIMIT)
            kept.limit(0).write.option("header", True).csv(f"{site}/sample_data/fraud_transactions.csv")
            kept.write.option("header", True).csv(f"{site}/delta/gold/fraud_transactions.csv")
        found = bundle.bundle_from_root(spark, site, as_of=tables.DIRTY_AS_OF, cfg=CONFIG_A)
        rows = found.gold.select(
            F.lit(branch).alias("branch"), F.lit(found.stored_gold_detected).alias("stored_gold"), "transaction_id", "user_id",
            F.col("amount").cast("double").alias("amount"), F.col("risk_score").cast("int").alias("risk_score"), "risk_level",
        )
        out = rows if out is None else out.unionByName(rows)
    return out


def csv_own_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files under three headers (in order; reversed, with one more column; without
    failure_reason, names in upper case) in two runs of one stream, each by its own."""
    base = scratch(spark, "own-headers")
    raw = tables.raw_transactions(spark, sf_dir)
    upper = [c for c in RAW_COLUMNS if c != "failure_reason"]
    kinds = (
        raw,
        raw.select(*reversed(RAW_COLUMNS[6:]), F.lit("a, b").alias("channel"), *reversed(RAW_COLUMNS[:6])),
        raw.select(*[F.col(c).alias(c.upper()) for c in upper]),
    )
    for runs in ((0, 1), (2,)):
        for k in runs:
            name = "transaction_id" if k < 2 else "TRANSACTION_ID"
            kinds[k].filter(F.substring(name, 5, 20).cast("long") % 3 == k).repartition(2).write.option("header", True).csv(f"{base}/in/kind{k}")
        bronze.run_bronze(
            spark, f"{base}/in/*", f"{base}/bronze", f"{base}/_checkpoint", max_files_per_trigger=3, by_own_header=True
        )
    return _typed_bronze(spark.read.parquet(f"{base}/bronze"))


def silver_by_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Silver and the quarantine written by status, and the rows of each status read back from its folder."""
    from paysignal.plans import silver as silver_plan

    store = storage.TableStore(spark, scratch(spark, "by-status"))
    frames = silver_plan.build(tables.dirty_raw_transactions(spark, sf_dir), as_of=tables.DIRTY_AS_OF, dedup_first=False)
    bad = frames.quarantine.select("transaction_id", "utr_number", F.upper("status").alias("status"), "quarantine_reason")
    store.write("silver", frames.silver.select("transaction_id", "utr_number", "status"), ["status"])
    store.write("quarantine", bad, ["status"])
    layers = {"silver": store.read("silver").withColumn("quarantine_reason", F.lit("")), "quarantine": store.read("quarantine")}
    out = None
    for layer, rows in layers.items():
        for status in ("SUCCESS", "FAILED", None):
            other = F.coalesce(~F.col("status").isin("SUCCESS", "FAILED"), F.lit(True))
            part = rows.filter(other if status is None else F.col("status") == status)
            part = part.select(F.lit(layer).alias("layer"), "status", "transaction_id", "utr_number", "quarantine_reason")
            out = part if out is None else out.unionByName(part)
    return out


def inr_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Money text with Indian digit grouping for flagged amounts."""
    fraud = gold.fraud_transactions(_scored(spark, sf_dir))
    return fraud.select("transaction_id", "amount", inr_text(F.col("amount") * 1000).alias("amount_text"))


def incremental_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rescore three days with look-back / look-ahead context; must equal the
    full recompute for those days."""
    silver = tables.transactions(spark, sf_dir)
    out = incremental.rescore_range(silver, *INCREMENTAL_RANGE, CONFIG_A)
    return out.select(*SCORED_OUT)


CLEARED_DAY, CLEARED_RANGE = "2024-01-15", ("2024-01-14", "2024-01-17")


def rescore_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Incremental rescoring after a day's rows left Silver: the stored scores
    equal a full recompute of the rest, and the day has no partition any more."""
    store = storage.TableStore(spark, scratch(spark, "rescore"))
    silver = tables.transactions(spark, sf_dir)
    store.write("scored", _scored(spark, sf_dir).select(*SCORED_OUT), partition_by=["transaction_date"])
    left = silver.filter(F.to_date("timestamp") != F.lit(CLEARED_DAY).cast("date"))
    incremental.rescore_into(store, left, "scored", *CLEARED_RANGE, CONFIG_A)
    return store.read("scored").select(*SCORED_OUT)


def _thirds(df: DataFrame, *by: str):
    """The rows in three batches, by a hash."""
    lot = F.pmod(F.xxhash64(*by), F.lit(3))
    return [df.filter(lot == k) for k in range(3)]


def silver_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """D3 U4: dirty rows in three batches, one of them delivered twice; copies of a UTR
    come in different batches and take back the validity of stored rows."""
    store = storage.TableStore(spark, scratch(spark, "silver"))
    batches = _thirds(tables.dirty_raw_transactions(spark, sf_dir), "transaction_id", "timestamp")
    for number in (0, 1, 1, 2):
        silver_store.step(store, batches[number], number, tables.DIRTY_AS_OF, buckets=16)
    return silver_store.checked(store).select("transaction_id", "utr_number", *STRICT_RULES, "_is_valid")


def silver_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs of the Silver stream over Bronze files, each in several batches."""
    base = scratch(spark, "silver-stream")
    store = storage.TableStore(spark, base)
    first, second, third = _thirds(tables.dirty_raw_transactions(spark, sf_dir), "utr_number")
    for arrived in (first.unionByName(second), third):
        arrived.repartition(4).write.mode("append").parquet(f"{base}/bronze")
        silver_store.stream_silver(
            spark, store, f"{base}/bronze", f"{base}/_checkpoint", tables.DIRTY_AS_OF, buckets=16, max_files_per_trigger=2
        )
    return silver_store.silver(store).select(*RAW_COLUMNS)


def scd2_bucketed_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First load, one step and a step without changes on the bucketed store."""
    from paysignal.plans.queries import SCD2_AS_OF

    store = storage.TableStore(spark, scratch(spark, "dim-store"))
    snapshots = tables.customer_snapshot0(spark, sf_dir), *[tables.customer_snapshot1(spark, sf_dir)] * 2
    for snapshot, day in zip(snapshots, SCD2_AS_OF):
        dimension_store.step(store, snapshot, day, buckets=16)
    return dimension_store.dimension(store)


def gold_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Gold marts from partials, after a day left Silver, the dates
    around it were rescored and only their partials made anew."""
    store = storage.TableStore(spark, scratch(spark, "gold-store"))
    silver = tables.transactions(spark, sf_dir)
    store.write("scored", _scored(spark, sf_dir).select(*SCORED_OUT), partition_by=["transaction_date"])
    gold_store.refresh(store, store.read("scored"))
    left = silver.filter(F.to_date("timestamp") != F.lit(CLEARED_DAY).cast("date"))
    incremental.rescore_into(store, left, "scored", *CLEARED_RANGE, CONFIG_A)
    gold_store.refresh(store, store.read("scored"), *CLEARED_RANGE)
    return gold_report(gold_store.marts(store))


def bronze_bounded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs without stream state; the second brings a copy of every row of the first."""
    base = scratch(spark, "bounded")
    store = storage.TableStore(spark, base)
    first, second, third = _thirds(tables.dirty_raw_transactions(spark, sf_dir), *RAW_COLUMNS)
    for k, arrived in enumerate((first.unionByName(second), third.unionByName(first).unionByName(second))):
        arrived.repartition(4).write.option("header", True).csv(f"{base}/in/run{k}")
        bronze_store.run(spark, store, f"{base}/in/*", f"{base}/_checkpoint", buckets=16, max_files_per_trigger=2)
    return _typed_bronze(bronze_store.rows(store))


def live_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dirty rows as a stream in several batches of any dates; each changes the
    scores of the dates around it, and those of rows it invalidates go."""
    base = scratch(spark, "live")
    store = storage.TableStore(spark, base)
    for part in _thirds(tables.dirty_raw_transactions(spark, sf_dir), "transaction_id", "utr_number"):
        part.write.mode("append").parquet(f"{base}/bronze")  # every task a file: one file a batch would be one task's work
    written = sum(x.endswith(".parquet") for x in storage.list_dir(spark, f"{base}/bronze"))
    live.run(
        spark, store, f"{base}/bronze", f"{base}/_checkpoint", CONFIG_A, tables.DIRTY_AS_OF,
        max_files_per_trigger=-(-2 * written // 3), buckets=16,
    )
    return live.scores(store).select(*SCORED_OUT)


def zorder_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Flagged rows along a Z-order curve of user and merchant category, read back."""
    store = storage.TableStore(spark, scratch(spark, "zorder"))
    fraud = gold.fraud_transactions(_scored(spark, sf_dir)).select(*SCORED_OUT)
    store.write("fraud_transactions", fraud, zorder_by=["user_id", "merchant_category"], files=16)
    return store.read("fraud_transactions")


def gold_report(marts: dict[str, DataFrame]) -> DataFrame:
    """All marts as rows of one table: mart, key, day, n, amount, score, users, devices, cities."""
    nothing = {"key": "string", "day": "date", "n": "long", "amount": "double", "score": "double", "users": "long", "devices": "long", "cities": "long"}
    taken = {
        "mule_accounts": dict(key="user_id", n="flagged_transaction_count", score="max_risk_score", devices="distinct_devices", cities="distinct_cities"),
        "merchant_kpi": dict(key="merchant_category", day="transaction_date", n="fraud_transaction_count", amount="fraud_amount",
                             score="avg_risk_score", users="distinct_users"),
        "total": dict(n="total_fraud_transactions", amount="total_fraud_amount", score="avg_fraud_risk"),
        "daily": dict(day="transaction_date", n="fraud_count", amount="fraud_amount"),
        "city": dict(key="location_city", n="fraud_count", amount="fraud_amount"),
        "hour": dict(key="txn_hour", n="fraud_count", amount="fraud_amount"),
        "merchant": dict(key="merchant_category", n="fraud_count", amount="fraud_amount", score="avg_risk_score"),
        "city_users": dict(key="location_city", n="fraud_count", amount="fraud_amount", users="unique_users"),
        "users": dict(key="user_id", n="fraud_txn_count", amount="fraud_amount", score="max_risk_score"),
    }
    out = None
    for mart, columns in taken.items():
        values = [(F.col(columns[c]) if c in columns else F.lit(None)).cast(kind).alias(c) for c, kind in nothing.items()]
        rows = marts[mart].select(F.lit(mart).alias("mart"), *values)
        out = rows if out is None else out.unionByName(rows)
    return out


def scd2_versioned_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Version 1 = initial load, version 2 = one SCD2 step, then a
    no-op step that must not write; returns the current version."""
    from paysignal.plans.queries import SCD2_AS_OF

    store = storage.TableStore(spark, scratch(spark, "dim"))
    store.write("customer_dim", scd2.initialize(tables.customer_snapshot0(spark, sf_dir), SCD2_AS_OF[0]))
    snap1 = tables.customer_snapshot1(spark, sf_dir)
    for day in SCD2_AS_OF[1:]:
        dim = store.read("customer_dim")
        if scd2.has_changes(snap1, dim, day):
            store.write("customer_dim", scd2.apply(dim, snap1, day))
    return store.read("customer_dim")


def scan_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Resolve the source (primary missing -> fallback),
    batch CSV scan with the declared raw schema, typed columns, transaction_date."""
    from paysignal.operators.standardize import standardize

    base = scratch(spark, "landing")
    tables.raw_transactions(spark, sf_dir).write.option("header", True).csv(f"{base}/sample")
    path, _label = files.resolve_source(spark, [(f"{base}/primary", "primary"), (f"{base}/sample", "sample")])
    typed = standardize(files.read_csv(spark, path, RAW))
    helper = [c for c in typed.columns if c in ("payer_location", "payee_location", "device_change_flag", "data_origin")]
    return typed.drop(*helper).withColumn("transaction_date", F.to_date("timestamp"))


def io_queries() -> dict:
    return {
        "scan_transactions": scan_transactions,
        "bronze_stream": bronze_stream,
        "stream_dedup": stream_dedup,
        "stream_late": stream_late,
        "csv_by_name": csv_by_name,
        "csv_own_headers": csv_own_headers,
        "silver_by_status": silver_by_status,
        "multi_format_read": multi_format_read,
        "json_envelope": json_envelope,
        "json_large": json_large,
        "csv_export": csv_export,
        "partitioned_write": partitioned_write,
        "clustered_write": clustered_write,
        "catalog_tables": catalog_tables,
        "catalog_kpis": catalog_kpis,
        "rescore_cleared": rescore_cleared,
        "precomputed_gold": precomputed_gold,
        "inr_format": inr_format,
        "incremental_score": incremental_score,
        "scd2_versioned_write": scd2_versioned_write,
        "scd2_bucketed_write": scd2_bucketed_write,
        "silver_incremental": silver_incremental,
        "silver_stream": silver_stream,
        "gold_incremental": gold_incremental,
        "bronze_bounded": bronze_bounded,
        "live_scores": live_scores,
        "zorder_write": zorder_write,
    }
