"""Registered queries: ``name -> fn(spark, sf_dir) -> DataFrame``.

Each query reads the driver's tables through the adapters in
``sources.tables`` and runs the library operators over the whole input. The
matching SQL lives in ``plans.oracle``; column names agree one to one.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from paysignal.config import CONFIG_A, LENIENT, LENIENT_RULES, STRICT, STRICT_RULES
from paysignal.functions.columns import present, round_ratio
from paysignal.operators import alerts, asof, dedup, dense, gold, kpi, quality, rules, scd2
from paysignal.operators.standardize import missing_report, standardize
from paysignal.plans import bundle, incremental
from paysignal.plans import silver as silver_plan
from paysignal.sources import tables

Query = Callable[[SparkSession, str], DataFrame]

SCORED_COLUMNS = (
    "transaction_id",
    "user_id",
    "timestamp",
    "amount",
    "merchant_category",
    "location_city",
    "device_id",
    "status",
    "transaction_date",
    "velocity_amount_1m",
    "device_users_10m",
    "velocity_check",
    "geo_anomaly",
    "device_mule_check",
    "failure_burst_check",
    "risk_score",
    "fraud_reason",
    "is_fraud",
    "risk_level",
)


# CONFIG_A on the plan that inputs of 1 GiB and more take, with cells that count as hot here.
LARGE = CONFIG_A.with_(split_min_input_bytes=0, hot_cell_rows=20, bucket_seconds=8 * 86400)

# Blocks and shares of a hot key of 20 rows, cells of a day; the plan of large inputs throughout.
DENSE = CONFIG_A.with_(split_min_input_bytes=0, hot_cell_rows=20, bucket_seconds=86400)


def scored(spark: SparkSession, sf_dir: str, label_style: str = "names") -> DataFrame:
    return rules.score(tables.transactions(spark, sf_dir), CONFIG_A, label_style=label_style)


def fraud(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.fraud_transactions(scored(spark, sf_dir))


def mules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.mule_accounts(scored(spark, sf_dir))


def _q(fn) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        return present(fn(spark, sf_dir))

    run.__name__ = getattr(fn, "__name__", "query")
    run.__doc__ = fn.__doc__
    return run


def ordered(df: DataFrame, *order) -> DataFrame:
    """``position`` from 1 in the report's order (a few rows: one per group),
    so that a comparison of the rows also proves the order."""
    return df.withColumn("position", F.row_number().over(Window.orderBy(*order)))


def scoring_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["score_transactions"] = lambda s, d: scored(s, d).select(*SCORED_COLUMNS)
    # the plan of large inputs: hot (key, slice) cells found and cut
    q["score_transactions_large"] = lambda s, d: rules.score(tables.transactions(s, d), LARGE).select(*SCORED_COLUMNS)
    # keys of any density: seconds and blocks of 20 rows instead of slices
    q["score_transactions_dense"] = lambda s, d: dense.score(tables.transactions(s, d), DENSE).select(*SCORED_COLUMNS)
    q["rule_velocity"] = lambda s, d: scored(s, d).filter("velocity_check").select(
        "transaction_id", "user_id", "timestamp", "amount", "velocity_amount_1m"
    )
    q["rule_geo"] = lambda s, d: scored(s, d).filter("geo_anomaly").select(
        "transaction_id", "user_id", "timestamp", "location_city"
    )
    q["rule_mule"] = lambda s, d: scored(s, d).filter("device_mule_check").select(
        "transaction_id", "device_id", "user_id", "timestamp", "device_users_10m"
    )
    q["rule_burst"] = lambda s, d: scored(s, d).filter("failure_burst_check").select(
        "transaction_id", "user_id", "timestamp", "status"
    )
    q["risk_level_counts"] = lambda s, d: scored(s, d).groupBy("risk_level").agg(F.count(F.lit(1)).alias("transactions"))
    q["rule_coverage"] = lambda s, d: rules.rule_coverage(scored(s, d))
    q["gold_fraud_transactions"] = lambda s, d: fraud(s, d).select(*SCORED_COLUMNS)
    q["gold_mule_accounts"] = mules
    q["gold_merchant_kpi"] = lambda s, d: gold.merchant_kpi(fraud(s, d))
    q["kpi_total"] = lambda s, d: kpi.total(fraud(s, d))
    q["kpi_daily"] = lambda s, d: kpi.daily(fraud(s, d))
    q["trend_date"] = lambda s, d: ordered(kpi.daily(fraud(s, d)), "transaction_date")
    q["kpi_top_merchants"] = lambda s, d: kpi.top_merchants(fraud(s, d))
    q["kpi_mule_leaderboard"] = lambda s, d: kpi.mule_leaderboard(mules(s, d), 20)
    q["kpi_mule_all"] = lambda s, d: kpi.mule_leaderboard(mules(s, d), None)
    q["kpi_city"] = lambda s, d: ordered(kpi.by_city(fraud(s, d)), F.desc("fraud_count"), "location_city")
    q["amount_by_city"] = lambda s, d: ordered(
        kpi.amount_by_city(fraud(s, d)), F.desc("fraud_amount"), "location_city"
    )
    q["kpi_high_risk_users"] = lambda s, d: kpi.high_risk_users_top(fraud(s, d), 10)
    q["kpi_hour"] = lambda s, d: kpi.by_hour(fraud(s, d))
    q["kpi_merchant"] = lambda s, d: kpi.merchant_risk(fraud(s, d))
    q["kpi_city_users"] = lambda s, d: kpi.city_users(fraud(s, d))
    q["exec_kpis"] = lambda s, d: kpi.executive(scored(s, d))
    q["merchant_counts"] = lambda s, d: kpi.merchant_counts(fraud(s, d))
    q["risk_histogram"] = lambda s, d: kpi.risk_histogram(scored(s, d))
    q["rule_hits"] = lambda s, d: kpi.rule_hits(fraud(s, d))
    q["high_risk_users"] = lambda s, d: kpi.high_risk_users(fraud(s, d))
    q["scored_labels"] = lambda s, d: scored(s, d, label_style="labels").select("transaction_id", "fraud_reason")
    return q


# ------------------------------------------------------------------ quality

AS_OF = tables.DIRTY_AS_OF


def dirty(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.dirty_raw_transactions(spark, sf_dir)


def checked(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.add_quality_rules(dirty(spark, sf_dir), STRICT, AS_OF)


def aliased_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows under alias / mixed-case names, lower-case status, no failure_reason."""
    r = tables.raw_transactions(spark, sf_dir)
    return r.select(
        F.col("transaction_id").alias(" TXN_ID "),
        F.col("utr_number").alias("UTR_Number"),
        F.col("user_id").alias("upi_id"),
        F.col("timestamp").alias("Event_Time"),
        F.col("amount").alias("txn_amount"),
        "sender_vpa",
        "receiver_vpa",
        F.col("merchant_category").alias("merchant"),
        F.col("location_city").alias("City"),
        F.col("device_id").alias("device"),
        "ip_address",
        F.lower("status").alias("status"),
    )


STANDARD_COLUMNS = (
    "transaction_id", "utr_number", "user_id", "timestamp", "amount", "sender_vpa", "receiver_vpa",
    "merchant_category", "location_city", "device_id", "ip_address", "status", "failure_reason",
    "payer_location", "payee_location", "device_change_flag", "data_origin",
)


def dedup_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """dedup_keep_first on the plan of large inputs, on a written Bronze table:
    repeated ids found first, the others pass straight through."""
    from paysignal.plans.io_queries import scratch

    path = scratch(spark, "bronze-table")
    dirty(spark, sf_dir).write.parquet(path)
    raw = spark.read.parquet(path)
    rows = dedup.keep_first(raw.withColumn("timestamp", quality._ts(raw)), small_input_bytes=0)
    valid, _ = quality.split_valid_invalid(quality.add_quality_rules(rows, STRICT, AS_OF, small_input_bytes=0))
    return valid.withColumn("status", F.upper("status")).select(*silver_plan.SILVER_COLUMNS)


def missing_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Required columns that inputs lack, and rows without a value of each:
    an export of six columns under other names, and all columns of dirty rows."""
    raw = dirty(spark, sf_dir)
    export = raw.select(F.col("transaction_id").alias("TXN_ID"), F.col("user_id").alias("upi_id"), F.col("timestamp").alias(" Event_Time"),
                        F.col("amount").alias("txn_amount"), "status", "ip_address")
    parts = [missing_report(df).select(F.lit(name).alias("input"), "*") for name, df in (("export", export), ("all", raw))]
    return parts[0].unionByName(parts[1])


def quality_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["standardize_aliases"] = lambda s, d: standardize(aliased_raw(s, d)).select(*STANDARD_COLUMNS)
    q["missing_columns"] = missing_columns
    q["dq_flags"] = lambda s, d: checked(s, d).select("transaction_id", "utr_number", *STRICT_RULES, "_is_valid")
    q["dq_flags_large"] = lambda s, d: quality.add_quality_rules(dirty(s, d), STRICT, AS_OF, small_input_bytes=0).select(
        "transaction_id", "utr_number", *STRICT_RULES, "_is_valid"
    )
    q["dq_valid"] = lambda s, d: silver_plan.build(dirty(s, d), STRICT, AS_OF, dedup_first=False).silver.select(
        *silver_plan.SILVER_COLUMNS
    )
    q["dq_quarantine"] = lambda s, d: silver_plan.build(dirty(s, d), STRICT, AS_OF, dedup_first=False).quarantine.select(
        "transaction_id", "utr_number", "quarantine_reason"
    )
    q["dq_summary"] = lambda s, d: quality.summarize(checked(s, d))
    q["dq_rule_summary"] = lambda s, d: quality.rule_summary(checked(s, d), STRICT)
    q["dq_reason_counts"] = lambda s, d: quality.reason_counts(quality.split_valid_invalid(checked(s, d))[1])
    q["quarantine_preview"] = lambda s, d: quality.quarantine_preview(quality.split_valid_invalid(checked(s, d))[1])
    q["dq_lenient"] = lambda s, d: quality.add_quality_rules(standardize(dirty(s, d)), LENIENT, AS_OF).select(
        "transaction_id", *LENIENT_RULES, "_is_valid", "quarantine_reason"
    )
    q["dq_lenient_summary"] = lambda s, d: quality.rule_summary(
        quality.add_quality_rules(standardize(dirty(s, d)), LENIENT, AS_OF), LENIENT
    )
    q["dedup_keep_first"] = lambda s, d: silver_plan.build(dirty(s, d), STRICT, AS_OF, dedup_first=True).silver.select(
        *silver_plan.SILVER_COLUMNS
    )
    q["dedup_keep_first_large"] = dedup_large
    q["duplicate_rows"] = lambda s, d: dedup.duplicate_rows(dirty(s, d))
    q["utr_duplicates"] = lambda s, d: checked(s, d).filter(~F.col("utr_unique")).select("transaction_id", "utr_number")
    q["layer_counts"] = layer_counts
    q["dashboard_layer_counts"] = lambda s, d: bundle.layer_counts(
        bundle.build_bundle(dirty(s, d), "Dirty events adapter", as_of=AS_OF, cfg=CONFIG_A)
    )
    return q


def layer_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per layer (bronze, silver, quarantine, gold), valid rate %,
    duplicate rows and mean rule pass rate, as (metric, value, state) rows.

    Three jobs' worth of plan: the checked rows give all their counts in one
    conditional aggregate, the ids theirs, and the scores of Silver the rest."""
    bronze = dirty(spark, sf_dir)
    frames = silver_plan.build(bronze, STRICT, AS_OF, dedup_first=False)
    scored_rows = rules.score(frames.silver, CONFIG_A).agg(
        F.count(F.lit(1)).alias("silver_rows"), F.count_if(F.col("is_fraud")).alias("gold_rows")
    )
    total = F.count(F.lit(1))
    passed = sum((F.count_if(F.col(r)) for r in STRICT_RULES[1:]), F.count_if(F.col(STRICT_RULES[0])))
    counts = frames.checked.agg(
        total.alias("bronze_rows"),
        F.count_if(~F.col("_is_valid")).alias("quarantine_rows"),
        F.coalesce(round_ratio(F.count_if(F.col("_is_valid")) * 100, total), F.lit(100.0)).alias("valid_rate_pct"),
        F.coalesce(round_ratio(passed * 100, total * len(STRICT_RULES)), F.lit(100.0)).alias("rule_pass_rate_pct"),
    )
    one_row = counts.withColumn("k", F.lit(1)).join(scored_rows.withColumn("k", F.lit(1)), "k")
    one_row = one_row.join(dedup.duplicate_rows(bronze).withColumn("k", F.lit(1)), "k")
    return gate_states(one_row)


def gate_states(one_row: DataFrame) -> DataFrame:
    """(metric, value, state) rows: a gate passes with no quarantined rows, no
    duplicate rows, or all rules passed, else it warns; the others have none."""
    stack = ", ".join(f"'{m}', CAST(`{m}` AS DOUBLE)" for m in bundle.LAYER_METRICS)
    clean = F.when(F.col("metric") == "rule_pass_rate_pct", F.col("value") == 100).when(
        F.col("metric").isin("quarantine_rows", "duplicate_rows"), F.col("value") == 0
    )
    return one_row.select(F.expr(f"stack({len(bundle.LAYER_METRICS)}, {stack}) AS (metric, value)")).withColumn(
        "state", F.when(clean, "PASS").when(~clean, "WARNING")
    )


# ------------------------------------------------------------- scd2, alerts

SCD2_AS_OF = ("2024-01-01", "2024-02-01", "2024-03-01")
FILTER_ARGS = dict(
    start_date="2024-01-05",
    end_date="2024-01-25",
    cities=["CITY0", "CITY1", "CITY2", "CITY3", "CITY4", "CITY5"],
    merchants=["click", "purchase", "error"],
    statuses=["SUCCESS"],
    risk_levels=("Medium", "High", "Critical"),
    amount_min=5.0,
    amount_max=500.0,
    user_query="1",
    reasons=["Geo anomaly", "Device mule check"],
)
USER_PATTERN = r"^[13]\d*[2-6]$|^\D|^\S0\w$"  # \D, \S and \w would mean something else in lower case
SEARCH_TEXT = "utr-77"  # a text that only utr_number holds


def dim0(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.initialize(tables.customer_snapshot0(spark, sf_dir), SCD2_AS_OF[0])


def dim1(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.apply(dim0(spark, sf_dir), tables.customer_snapshot1(spark, sf_dir), SCD2_AS_OF[1])


def changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2.detect_changes(tables.customer_snapshot1(spark, sf_dir), dim0(spark, sf_dir), SCD2_AS_OF[1])


PIT_DAYS = ("2024-01-05", "2024-01-15")
PIT_COLUMNS = (
    "transaction_id", "user_id", "timestamp", "risk_score", "dim_name", "dim_bank", "dim_kyc_status", "dim_device_id",
    "dim_location_city", "dim_effective_start_date", "dim_effective_end_date",
)


def point_in_time(spark: SparkSession, sf_dir: str, **kw) -> DataFrame:
    """X11: every scored transaction with the customer version valid on its day."""
    first = scd2.initialize(tables.customer_snapshot0(spark, sf_dir), PIT_DAYS[0])
    dim = scd2.apply(first, tables.customer_snapshot1(spark, sf_dir), PIT_DAYS[1])
    return asof.point_in_time(scored(spark, sf_dir), dim, **kw).select(*PIT_COLUMNS)


def scd2_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["scd2_initial"] = dim0
    q["scd2_changes"] = lambda s, d: changes(s, d).select("user_id", "record_hash", "current_record_hash", "change")
    q["scd2_expire"] = lambda s, d: scd2.expire_set(changes(s, d))
    q["scd2_insert"] = lambda s, d: scd2.insert_set(changes(s, d))
    q["scd2_apply"] = dim1
    q["scd2_noop"] = lambda s, d: scd2.apply(dim1(s, d), tables.customer_snapshot1(s, d), SCD2_AS_OF[2])
    q["scd2_point_in_time"] = point_in_time
    # slices of 3 days, and users with more than 2 rows a day dealt to several tasks
    q["scd2_point_in_time_large"] = lambda s, d: point_in_time(s, d, slice_days=3, rows_per_task=2, small_input_bytes=0)
    q["scd2_current"] = lambda s, d: kpi.active_customers(dim1(s, d))
    return q


def scored_in_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Scores of the filter's dates only: rows out of the rules' reach of them are not read."""
    first, last = FILTER_ARGS["start_date"], FILTER_ARGS["end_date"]
    return incremental.rescore_range(tables.transactions(spark, sf_dir), first, last, CONFIG_A)


def alert_queries() -> dict[str, Query]:
    q: dict[str, Query] = {}
    q["filter_transactions"] = lambda s, d: alerts.filter_transactions(scored_in_range(s, d), **FILTER_ARGS).select(*SCORED_COLUMNS)
    q["filter_regex"] = lambda s, d: alerts.filter_transactions(
        scored(s, d), statuses=["FAILED"], risk_levels=None, user_query=USER_PATTERN, user_regex=True
    ).select(*SCORED_COLUMNS)
    q["filtered_kpis"] = lambda s, d: kpi.filtered(alerts.filter_transactions(scored_in_range(s, d), **FILTER_ARGS))
    q["alert_queue"] = lambda s, d: alerts.alert_queue(fraud(s, d), "risk_score", 100)
    q["alert_queue_amount"] = lambda s, d: alerts.alert_queue(fraud(s, d), "amount", 100)
    q["alert_queue_time"] = lambda s, d: alerts.alert_queue(fraud(s, d), "timestamp", 100)
    q["alert_search"] = lambda s, d: alerts.search(alerts.with_investigation_status(fraud(s, d)), SEARCH_TEXT).select(
        *alerts.ALERT_COLUMNS
    )
    q["high_risk_transactions"] = lambda s, d: alerts.high_risk_transactions(fraud(s, d), 100)
    return q


def all_queries() -> dict[str, Query]:
    out: dict[str, Query] = {}
    from paysignal.plans.io_queries import io_queries

    for group in (scoring_queries, quality_queries, scd2_queries, alert_queries, io_queries):
        for name, fn in group().items():
            out[name] = _q(fn)
    return out
