"""Adapters from the shared test tables to the payment model.

``events`` becomes a transaction stream and ``customer`` becomes customer
snapshots. Every derived column is a plain expression on the scanned row,
so Catalyst prunes the scan to the columns used and the adapters scale with
the input. The same mapping is written in SQL for the DuckDB oracle
(``paysignal.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paysignal.schema import RAW_COLUMNS

# Fixed values for the dirty variant: rows with event_id % 101 == r get defect r.
DIRTY_MODULUS = 101
DUPLICATE_MODULUS = 50
DIRTY_AS_OF = "2024-02-01 00:00:00"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _s(c: Column) -> Column:
    return c.cast("string")


def events_to_transactions(events: DataFrame, keep_event_id: bool = False) -> DataFrame:
    """Typed transactions (the Silver input schema) from ``events``;
    ``keep_event_id`` also passes ``event_id`` through as ``_eid``."""
    k = F.expr("try_cast(get_json_object(props, '$.k') as int)")
    uid = F.col("user_id")
    failed = F.col("event_type") == F.lit("error")
    return events.select(
        F.concat(F.lit("TXN-"), _s(F.col("event_id"))).alias("transaction_id"),
        F.concat(F.lit("UTR-"), _s(F.col("event_id"))).alias("utr_number"),
        _s(uid).alias("user_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.col("value").cast("double").alias("amount"),
        F.concat(F.lit("user"), _s(uid), F.lit("@bank")).alias("sender_vpa"),
        F.concat(F.lit("m"), _s(F.col("event_id") % 30), F.lit("@bank")).alias("receiver_vpa"),
        F.col("event_type").alias("merchant_category"),
        F.concat(F.lit("CITY"), _s(k % 12)).alias("location_city"),
        F.concat(F.lit("dev-"), _s(F.expr("user_id div 4")), F.lit("-"), _s(k % 5)).alias("device_id"),
        F.concat(F.lit("10.0."), _s(k), F.lit(".1")).alias("ip_address"),
        F.when(failed, "FAILED").otherwise("SUCCESS").alias("status"),
        F.when(failed, F.lit("err")).alias("failure_reason"),
        *([F.col("event_id").alias("_eid")] if keep_event_id else []),
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_to_transactions(table(spark, sf_dir, "events"))


def raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same rows as the all-string raw edge (as a CSV drop would deliver)."""
    t = transactions(spark, sf_dir)
    return t.select(
        *[
            (F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS") if c == "timestamp" else _s(F.col(c))).alias(c)
            for c in RAW_COLUMNS
        ]
    )


def dirty_raw_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw rows with one defect per ``event_id % 101`` residue 1..18, plus repeats.

    Residues: 1 id NULL, 2 utr NULL, 3 shared utr, 4 negative amount,
    5 amount 2,000,000, 6 bad sender VPA, 7 receiver NULL, 8 timestamp ten
    years ahead, 9 user NULL, 10 status PENDING, 11 FAILED without reason,
    12 device NULL, 13 ip ``x.y``, 14 merchant NULL, 15 city NULL, 16 amount
    NaN, 17 amount Infinity, 18 amount 1E20. Rows with ``event_id % 50 == 0``
    appear twice.
    """
    ev = table(spark, sf_dir, "events")
    base = events_to_transactions(ev, keep_event_id=True)
    r = F.col("_eid") % DIRTY_MODULUS
    ts_text = F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    null = F.lit(None).cast("string")
    amount_text = _s(F.col("amount"))

    def pick(residue: int, bad: Column, good: Column) -> Column:
        return F.when(r == residue, bad).otherwise(good)

    dirty = base.select(
        pick(1, null, F.col("transaction_id")).alias("transaction_id"),
        pick(2, null, pick(3, F.concat(F.lit("DUP-"), _s(F.expr("_eid div 202"))), F.col("utr_number"))).alias("utr_number"),
        pick(9, null, F.col("user_id")).alias("user_id"),
        pick(8, F.date_format(F.col("timestamp") + F.expr("INTERVAL 10 YEARS"), "yyyy-MM-dd HH:mm:ss.SSSSSS"), ts_text).alias("timestamp"),
        F.when(r == 4, _s(-F.col("amount")))
        .when(r == 5, "2000000.0")
        .when(r == 16, "NaN")
        .when(r == 17, "Infinity")
        .when(r == 18, "1E20")
        .otherwise(amount_text)
        .alias("amount"),
        pick(6, F.lit("bad vpa"), F.col("sender_vpa")).alias("sender_vpa"),
        pick(7, null, F.col("receiver_vpa")).alias("receiver_vpa"),
        pick(14, null, F.col("merchant_category")).alias("merchant_category"),
        pick(15, null, F.col("location_city")).alias("location_city"),
        pick(12, null, F.col("device_id")).alias("device_id"),
        pick(13, F.lit("x.y"), F.col("ip_address")).alias("ip_address"),
        pick(10, F.lit("PENDING"), pick(11, F.lit("FAILED"), F.col("status"))).alias("status"),
        pick(11, F.lit(""), F.col("failure_reason")).alias("failure_reason"),
        F.col("_eid"),
    )
    repeats = dirty.filter(F.col("_eid") % DUPLICATE_MODULUS == 0)
    return dirty.unionByName(repeats).drop("_eid")


# ---------------------------------------------------------------- customers

def customer_snapshot0(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer snapshot (SCD2 source) from the ``customer`` table."""
    c = table(spark, sf_dir, "customer")
    return _customer_rows(c.select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"))


def _customer_rows(c: DataFrame, city: Column | None = None, name: Column | None = None) -> DataFrame:
    key = F.col("c_custkey")
    # Kyc status by c_custkey % 3.
    kyc = F.when(key % 3 == 0, "FULL_KYC").when(key % 3 == 1, "MIN_KYC").otherwise("PENDING")
    return c.select(
        _s(key).alias("user_id"),
        (name if name is not None else F.col("c_name")).alias("name"),
        F.col("c_mktsegment").alias("bank"),
        kyc.alias("kyc_status"),
        F.concat(F.lit("dev-"), _s(key)).alias("device_id"),
        (city if city is not None else F.concat(F.lit("N"), _s(F.col("c_nationkey")))).alias("location_city"),
    )


def customer_snapshot1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Next snapshot: drops, city moves, name-only edits and new customers.

    c_custkey % 17 == 0 is missing; else % 10 == 0 moves city; else % 13 == 0
    changes only the name (not versioned); % 25 == 0 adds c_custkey + 1000000.
    """
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    key = F.col("c_custkey")
    kept = c.filter(key % 17 != 0)
    city = F.when(key % 10 == 0, F.concat(F.lit("M"), _s(F.col("c_nationkey")))).otherwise(
        F.concat(F.lit("N"), _s(F.col("c_nationkey")))
    )
    name = F.when((key % 10 != 0) & (key % 13 == 0), F.concat(F.col("c_name"), F.lit(" Jr"))).otherwise(F.col("c_name"))
    changed = _customer_rows(kept, city=city, name=name)
    added = _customer_rows(
        c.filter(key % 25 == 0).select(
            (key + F.lit(1000000)).alias("c_custkey"), "c_name", "c_nationkey", "c_mktsegment"
        )
    )
    return changed.unionByName(added)
