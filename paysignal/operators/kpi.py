"""Investigator KPIs over Gold tables and scored transactions.

Every KPI is one aggregate (partial aggregation before the shuffle) with an
optional sort / top-k. Money is summed at cent precision; averages of
integer scores are rounded half-up in exact integer arithmetic. Top-k sorts
carry the group key as a last tie-breaker so results are stable.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.config import RULE_NAMES
from paysignal.functions.columns import cents, coalesce_false, money, round_ratio


def _count_amount(df: DataFrame, key: str, count_name: str = "fraud_count", amount_name: str = "fraud_amount") -> DataFrame:
    return df.groupBy(key).agg(
        F.count(F.lit(1)).alias(count_name),
        money(F.sum(cents("amount"))).alias(amount_name),
    )


def total(fraud: DataFrame) -> DataFrame:
    """A3: total fraud count, amount, mean risk."""
    return fraud.agg(
        F.count(F.lit(1)).alias("total_fraud_transactions"),
        money(F.sum(cents("amount"))).alias("total_fraud_amount"),
        round_ratio(F.sum("risk_score"), F.count("risk_score")).alias("avg_fraud_risk"),
    )


def daily(fraud: DataFrame) -> DataFrame:
    """Fraud per transaction date, ordered by date."""
    return _count_amount(fraud, "transaction_date").orderBy("transaction_date")


def top_merchants(fraud: DataFrame, n: int = 10) -> DataFrame:
    """A5: top-n merchant categories by fraud count."""
    return _count_amount(fraud, "merchant_category").orderBy(F.desc("fraud_count"), "merchant_category").limit(n)


def mule_leaderboard(mules: DataFrame, n: int | None = 20) -> DataFrame:
    """A6 (n=20) / A9 (n=None): mule accounts by flagged count, then max risk."""
    out = mules.select(
        "user_id", "flagged_transaction_count", "distinct_devices", "distinct_cities", "max_risk_score"
    ).orderBy(F.desc("flagged_transaction_count"), F.desc("max_risk_score"), "user_id")
    return out.limit(n) if n else out


def by_city(fraud: DataFrame) -> DataFrame:
    """Fraud count and amount per city, count desc."""
    return _count_amount(fraud, "location_city").orderBy(F.desc("fraud_count"), "location_city")


def high_risk_users_top(fraud: DataFrame, n: int = 10) -> DataFrame:
    """Top-n users by max risk, then fraud amount."""
    return (
        fraud.groupBy("user_id")
        .agg(
            F.count(F.lit(1)).alias("fraud_txn_count"),
            money(F.sum(cents("amount"))).alias("fraud_amount"),
            F.max("risk_score").alias("max_risk_score"),
        )
        .orderBy(F.desc("max_risk_score"), F.desc("fraud_amount"), "user_id")
        .limit(n)
    )


def by_hour(fraud: DataFrame) -> DataFrame:
    """A10: fraud per hour of day (session time zone)."""
    return (
        fraud.withColumn("txn_hour", F.hour("timestamp"))
        .groupBy("txn_hour")
        .agg(F.count(F.lit(1)).alias("fraud_count"), money(F.sum(cents("amount"))).alias("fraud_amount"))
        .orderBy("txn_hour")
    )


def merchant_risk(fraud: DataFrame) -> DataFrame:
    """Per merchant count, amount and mean risk."""
    return (
        fraud.groupBy("merchant_category")
        .agg(
            F.count(F.lit(1)).alias("fraud_count"),
            money(F.sum(cents("amount"))).alias("fraud_amount"),
            round_ratio(F.sum("risk_score"), F.count("risk_score")).alias("avg_risk_score"),
        )
        .orderBy(F.desc("fraud_count"), F.desc("fraud_amount"), "merchant_category")
    )


def city_users(fraud: DataFrame) -> DataFrame:
    """Per city count, amount and distinct users."""
    return (
        fraud.groupBy("location_city")
        .agg(
            F.count(F.lit(1)).alias("fraud_count"),
            money(F.sum(cents("amount"))).alias("fraud_amount"),
            F.count_distinct("user_id").alias("unique_users"),
        )
        .orderBy(F.desc("fraud_count"), F.desc("fraud_amount"), "location_city")
    )


def executive(scored: DataFrame) -> DataFrame:
    """Valid rows, flagged rows, fraud rate %, flagged amount, mean risk
    over all rows, distinct users at High / Critical risk."""
    fraud = coalesce_false("is_fraud")
    valid = F.count(F.lit(1))
    flagged = F.count_if(fraud)
    return scored.agg(
        valid.alias("valid_transactions"),
        flagged.alias("flagged_transactions"),
        F.coalesce(round_ratio(flagged * 100, valid), F.lit(0.0)).alias("fraud_rate_pct"),
        F.coalesce(money(F.sum(F.when(fraud, cents("amount")))), F.lit(0.0)).alias("flagged_amount"),
        F.coalesce(round_ratio(F.sum("risk_score"), F.count("risk_score")), F.lit(0.0)).alias("avg_risk_score"),
        F.count_distinct(F.when(F.col("risk_level").isin("High", "Critical"), F.col("user_id"))).alias("high_risk_users"),
    )


def filtered(scored: DataFrame) -> DataFrame:
    """Rows, fraud rows, fraud amount and mean risk of a filtered view."""
    fraud = coalesce_false("is_fraud")
    return scored.agg(
        F.count(F.lit(1)).alias("filtered_transactions"),
        F.count_if(fraud).alias("fraud_transactions"),
        F.coalesce(money(F.sum(F.when(fraud, cents("amount")))), F.lit(0.0)).alias("fraud_amount"),
        round_ratio(F.sum("risk_score"), F.count("risk_score")).alias("avg_risk_score"),
    )


def amount_by_city(fraud: DataFrame) -> DataFrame:
    """Per city count and amount, amount desc."""
    return _count_amount(fraud, "location_city").orderBy(F.desc("fraud_amount"), "location_city")


def merchant_counts(fraud: DataFrame) -> DataFrame:
    """Fraud count per merchant, desc."""
    return fraud.groupBy("merchant_category").agg(F.count(F.lit(1)).alias("fraud_count")).orderBy(
        F.desc("fraud_count"), "merchant_category"
    )


def risk_histogram(scored: DataFrame) -> DataFrame:
    """Rows per risk score."""
    return scored.groupBy("risk_score").agg(F.count(F.lit(1)).alias("transactions")).orderBy("risk_score")


def rule_hits(fraud: DataFrame) -> DataFrame:
    """How many rows each rule flagged (one row per rule)."""
    agg = fraud.agg(*[F.count_if(coalesce_false(n)).alias(n) for n in RULE_NAMES])
    stack = ", ".join(f"'{n}', `{n}`" for n in RULE_NAMES)
    return agg.select(F.expr(f"stack({len(RULE_NAMES)}, {stack}) as (rule, hits)"))


def high_risk_users(fraud: DataFrame, n: int | None = None) -> DataFrame:
    """Per user count, amount and max risk; max risk, count, amount desc.
    Empty input gives an empty frame with the same schema."""
    out = (
        fraud.groupBy("user_id")
        .agg(
            F.count("transaction_id").alias("fraud_count"),
            money(F.sum(cents("amount"))).alias("flagged_amount"),
            F.max("risk_score").alias("max_risk_score"),
        )
        .orderBy(F.desc("max_risk_score"), F.desc("fraud_count"), F.desc("flagged_amount"), "user_id")
    )
    return out.limit(n) if n else out


def active_customers(dim: DataFrame) -> DataFrame:
    """Count of current dimension rows."""
    return dim.filter(coalesce_false("is_current")).agg(F.count(F.lit(1)).alias("active_customer_count"))
