"""Rule-based data quality: per-row rule flags, validity, quarantine, summaries.

A rule result that is NULL counts as failed. Two profiles (``config.STRICT``
with 15 rules, ``config.LENIENT`` with 13) share one engine.

Scale notes: the only non-row-local rule is ``utr_unique`` (every copy of a
repeated UTR fails). Instead of ``count(*) OVER (PARTITION BY utr)``, which
shuffles every full row and sends a hot UTR (or all NULL UTRs) to one task,
the counts are a narrow hash aggregate with map-side combine; only UTRs seen
more than once (NULL counted as one group) are joined back on a null-safe
key (broadcast below a checked row and byte bound, else a shuffle join that
AQE splits when skewed).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.config import AMOUNT_MAX, AMOUNT_MIN, IP_SHAPE, STRICT, VALID_STATUSES, QualityProfile
from paysignal.functions.columns import coalesce_false, round_ratio
from paysignal.operators.keys import MAX_BROADCAST_ROWS, SMALL_INPUT_BYTES, bounded, is_small

DQ_COLUMNS = ("_is_valid", "_dq_failures", "quarantine_reason")


def _ts(df: DataFrame) -> Column:
    dtype = df.schema["timestamp"].dataType
    if isinstance(dtype, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        return F.col("timestamp").cast("timestamp")
    return F.try_to_timestamp(F.col("timestamp").cast("string"))


def _as_of(as_of) -> Column:
    if as_of is None:
        return F.current_timestamp()
    if isinstance(as_of, Column):
        return as_of
    return F.lit(str(as_of)).cast("timestamp")


def utr_counts(df: DataFrame) -> DataFrame:
    """UTRs (NULL included, as one group) occurring more than once, with
    their counts: a narrow aggregate with map-side partial counting."""
    return (
        df.select(F.col("utr_number").alias("_utr_key"))
        .groupBy("_utr_key")
        .agg(F.count(F.lit(1)).alias("_utr_n"))
        .filter(F.col("_utr_n") > 1)
    )


def with_utr_unique(
    df: DataFrame,
    out: str = "utr_unique",
    max_broadcast_rows: int | None = MAX_BROADCAST_ROWS,
    small_input_bytes: int | None = SMALL_INPUT_BYTES,
) -> DataFrame:
    """Adds boolean ``out``: False for every member of a repeated UTR (NULL
    UTRs form one group, as a window over utr_number would).

    Only the repeated UTRs are joined back (null-safe key): broadcast when
    their count is within ``max_broadcast_rows``, otherwise a shuffle join
    whose skewed partitions AQE splits. Inputs estimated below
    ``small_input_bytes`` skip the counting job (Spark sizes the join)."""
    reps = utr_counts(df) if is_small(df, small_input_bytes) else bounded(utr_counts(df), max_broadcast_rows)[0]
    joined = df.join(reps, df["utr_number"].eqNullSafe(reps["_utr_key"]), "left")
    return joined.withColumn(out, F.col("_utr_n").isNull()).drop("_utr_n", "_utr_key")


def rule_columns(profile: QualityProfile, as_of=None, ts: Column | None = None) -> dict[str, Column]:
    """Rule name -> boolean Column (may be NULL; NULL means failed).
    Expects typed ``timestamp`` and numeric ``amount`` (``add_quality_rules``
    converts raw text with ``try_*`` casts first)."""
    ts = ts if ts is not None else F.col("timestamp")
    amount = F.col("amount")

    def present(c: str) -> Column:
        x = F.col(c)
        return (x.isNotNull() & (x.cast("string") != F.lit(""))) if profile.empty_is_null else x.isNotNull()

    def vpa(c: str) -> Column:
        x = F.col(c).cast("string")
        return (F.lower(x) if profile.vpa_lowercase else x).rlike(profile.vpa_pattern)

    status = F.upper(F.col("status").cast("string"))
    fr = F.col("failure_reason").cast("string")
    if profile.empty_is_null:
        failure_ok = (status != F.lit("FAILED")) | (fr != F.lit(""))
    else:
        failure_ok = F.when(status == F.lit("FAILED"), fr.isNotNull() & (F.length(fr) > 0)).otherwise(F.lit(True))
    cols = {
        "transaction_id_not_null": present("transaction_id"),
        "utr_not_null": F.col("utr_number").isNotNull(),
        "utr_number_not_null": F.col("utr_number").isNotNull(),
        "utr_unique": F.col("_utr_unique"),
        "amount_positive": (~F.isnan(amount) & (amount > F.lit(0))) if profile.empty_is_null else amount > F.lit(0),
        "sender_vpa_valid": vpa("sender_vpa"),
        "receiver_vpa_valid": vpa("receiver_vpa"),
        "timestamp_not_future": ts <= _as_of(as_of),
        "user_id_not_null": present("user_id"),
        "status_valid": status.isin(*VALID_STATUSES),
        "failure_reason_valid": failure_ok,
        "device_id_not_null": present("device_id"),
        "ip_address_valid": F.col("ip_address").cast("string").rlike(IP_SHAPE),
        "merchant_category_not_null": present("merchant_category"),
        "location_city_not_null": present("location_city"),
        "amount_reasonable": amount.between(AMOUNT_MIN, AMOUNT_MAX),
    }
    return {name: cols[name] for name in profile.rules}


def add_quality_rules(
    df: DataFrame,
    profile: QualityProfile = STRICT,
    as_of=None,
    max_broadcast_rows: int | None = MAX_BROADCAST_ROWS,
    small_input_bytes: int | None = SMALL_INPUT_BYTES,
) -> DataFrame:
    """Typed timestamp, one boolean column per rule (NULL->False),
    ``_is_valid``, ``_dq_failures`` (failed names in declared order) and
    ``quarantine_reason`` (the same names joined by ``"; "``).

    ``as_of`` bounds ``timestamp_not_future`` (default: query start time).
    """
    for c in ("utr_number", "sender_vpa", "receiver_vpa", "ip_address", "failure_reason"):
        if c not in df.columns:
            df = df.withColumn(c, F.lit(None).cast("string"))
    if "amount" not in df.columns:
        df = df.withColumn("amount", F.lit(None).cast("double"))
    elif not isinstance(df.schema["amount"].dataType, T.NumericType):
        df = df.withColumn("amount", F.col("amount").cast("string").try_cast("double"))
    base = with_utr_unique(df.withColumn("timestamp", _ts(df)), "_utr_unique", max_broadcast_rows, small_input_bytes)
    rules = rule_columns(profile, as_of)
    flagged = base.select("*", *[coalesce_false(c).alias(n) for n, c in rules.items()]).drop("_utr_unique")
    return with_validity(flagged, list(rules))


def with_validity(flagged: DataFrame, names: list[str] | tuple[str, ...]) -> DataFrame:
    """D16, D17, D21 from the rule columns (replaced if they are there already)."""
    valid = F.lit(True)
    for n in names:
        valid = valid & F.col(n)
    failures = F.array_compact(F.array(*[F.when(~F.col(n), F.lit(n)) for n in names]))
    return (
        flagged.withColumn("_is_valid", valid)
        .withColumn("_dq_failures", failures)
        .withColumn("quarantine_reason", F.concat_ws("; ", "_dq_failures"))
    )


def split_valid_invalid(checked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(valid, quarantine). Materialise ``checked`` once (or write it
    partitioned by ``_is_valid``) before taking both sides."""
    return checked.filter(F.col("_is_valid")), checked.filter(~coalesce_false("_is_valid"))


def summarize(checked: DataFrame) -> DataFrame:
    """Total / valid / invalid row counts."""
    return checked.agg(
        F.count(F.lit(1)).alias("total_rows"),
        F.count_if(F.col("_is_valid")).alias("valid_rows"),
        F.count_if(~F.col("_is_valid")).alias("invalid_rows"),
    )


def rule_summary(checked: DataFrame, profile: QualityProfile = STRICT) -> DataFrame:
    """Per rule passed / failed counts, pass rate % (2 dp, 100 when empty)
    and PASS / WARNING. One aggregate pass, then ``stack`` to rows."""
    names = list(profile.rules)
    agg = checked.agg(
        F.count(F.lit(1)).alias("_n"), *[F.count_if(F.col(n)).alias(f"p_{i}") for i, n in enumerate(names)]
    )
    stack = ", ".join(f"'{n}', {i}, `p_{i}`" for i, n in enumerate(names))
    long = agg.select("_n", F.expr(f"stack({len(names)}, {stack}) as (rule, rule_order, passed_records)"))
    failed = F.col("_n") - F.col("passed_records")
    return long.select(
        "rule",
        "rule_order",
        F.col("passed_records").cast("long").alias("passed_records"),
        failed.cast("long").alias("failed_records"),
        F.coalesce(round_ratio(F.col("passed_records") * 100, F.col("_n")), F.lit(100.0)).alias("pass_rate_pct"),
        F.when(failed == 0, "PASS").otherwise("WARNING").alias("status"),
    )


def reason_counts(quarantine: DataFrame) -> DataFrame:
    """How many quarantined rows failed each rule, most frequent first."""
    return (
        quarantine.select(F.explode("_dq_failures").alias("rule"))
        .groupBy("rule")
        .agg(F.count(F.lit(1)).alias("failed_rows"))
        .orderBy(F.desc("failed_rows"), "rule")
    )


def quarantine_preview(quarantine: DataFrame, n: int = 50) -> DataFrame:
    """The first ``n`` quarantined rows (id and reasons), stable order."""
    return (
        quarantine.select("transaction_id", "utr_number", "quarantine_reason")
        .orderBy(F.col("transaction_id").asc_nulls_first(), F.col("utr_number").asc_nulls_first(), "quarantine_reason")
        .limit(n)
        .select("transaction_id", "quarantine_reason")
    )
