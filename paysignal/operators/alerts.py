"""Investigator filters, search and alert queues.

Filters are plain predicates (pushed below the scoring windows only where
they touch partition keys; otherwise applied right after scoring). Queues
are ``orderBy(...).limit(n)``, which Spark plans as a per-partition top-n
plus a final merge (TakeOrderedAndProject), never a full sort.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.config import NO_RULE_LABEL, RULE_LABELS
from paysignal.functions.columns import coalesce_false, investigation_status

ANY_REASON = "Any reason"
# Display columns of the alert views, in order.
HIGH_RISK_COLUMNS = (
    "transaction_id",
    "user_id",
    "timestamp",
    "amount",
    "location_city",
    "device_id",
    "merchant_category",
    "fraud_reason",
    "risk_score",
    "risk_level",
)
ALERT_COLUMNS = (
    "transaction_id",
    "user_id",
    "timestamp",
    "amount",
    "location_city",
    "device_id",
    "fraud_reason",
    "risk_score",
    "risk_level",
    "investigation_status",
)


def _in(col: str, values: Sequence | None) -> Column:
    if values is None:
        return F.lit(True)
    if len(values) == 0:
        return F.lit(False)
    return coalesce_false(F.col(col).cast("string").isin(*[str(v) for v in values]))


def filter_transactions(
    scored: DataFrame,
    start_date: dt.date | str | None = None,
    end_date: dt.date | str | None = None,
    cities: Sequence[str] | None = None,
    merchants: Sequence[str] | None = None,
    statuses: Sequence[str] | None = None,
    risk_levels: Sequence[str] | None = ("Medium", "High", "Critical"),
    amount_min: float | None = None,
    amount_max: float | None = None,
    user_query: str | None = None,
    user_regex: bool = False,
    reasons: Sequence[str] | None = (ANY_REASON,),
) -> DataFrame:
    """F1-F5. ``None`` means "no filter" for a list; an empty list matches
    nothing. ``reasons`` are display labels (or ``No rule triggered``);
    ``Any reason`` disables that filter. NULLs never match an IN-list."""
    cond = F.lit(True)
    day = F.to_date("timestamp")
    if start_date is not None:
        cond = cond & coalesce_false(day >= F.lit(str(start_date)).cast("date"))
    if end_date is not None:
        cond = cond & coalesce_false(day <= F.lit(str(end_date)).cast("date"))
    cond = cond & _in("location_city", cities) & _in("merchant_category", merchants) & _in("status", statuses)
    cond = cond & _in("risk_level", risk_levels)
    if amount_min is not None:
        cond = cond & coalesce_false(F.col("amount") >= F.lit(float(amount_min)))
    if amount_max is not None:
        cond = cond & coalesce_false(F.col("amount") <= F.lit(float(amount_max)))
    if user_query:
        uid = F.col("user_id").cast("string")
        if user_regex:  # the pattern as it is: lower-casing it would turn \\D into \\d
            cond = cond & coalesce_false(uid.rlike("(?iu)" + user_query))
        else:
            cond = cond & coalesce_false(F.lower(uid).contains(user_query.lower()))
    if reasons is not None:
        if len(reasons) == 0:
            cond = cond & F.lit(False)
        elif ANY_REASON not in reasons:
            cond = cond & reason_match(reasons)
    return scored.filter(cond)


def reason_match(labels: Sequence[str]) -> Column:
    """Any selected label fired on the row (``No rule triggered`` = none fired)."""
    by_label = {v: k for k, v in RULE_LABELS.items()}
    hit = F.lit(False)
    for label in labels:
        if label == NO_RULE_LABEL:
            hit = hit | (F.size(F.col("fraud_reasons")) == 0)
        elif label in by_label:
            hit = hit | F.array_contains(F.col("fraud_reasons"), by_label[label])
    return coalesce_false(hit)


def search(df: DataFrame, query: str, columns: Sequence[str] | None = None) -> DataFrame:
    """case-insensitive substring match over the whole row: all columns
    (or the given ones) as text, arrays joined by commas, in order, separated
    by a space; NULLs are left out (the literal text, not a pattern)."""
    if not query:
        return df
    types = {f.name: f.dataType for f in df.schema.fields}
    parts = [
        F.array_join(F.col(f"`{c}`").cast("array<string>"), ",") if isinstance(types[c], T.ArrayType) else F.col(f"`{c}`").cast("string")
        for c in (df.columns if columns is None else columns)
    ]
    text = F.lower(F.concat_ws(" ", *parts))
    return df.filter(text.contains(query.lower()))


def with_investigation_status(fraud: DataFrame) -> DataFrame:
    return fraud.withColumn("investigation_status", investigation_status("risk_score"))


def alert_queue(fraud: DataFrame, sort_by: str = "risk_score", n: int = 100, query: str | None = None) -> DataFrame:
    """L1: newest / largest / riskiest alerts first, top ``n``, with R9 status."""
    if sort_by not in ("risk_score", "amount", "timestamp"):
        raise ValueError("sort_by must be one of risk_score, amount, timestamp")
    alerts = with_investigation_status(fraud)
    if query:
        alerts = search(alerts, query)
    return alerts.orderBy(F.desc(sort_by), "transaction_id").limit(n).select(*ALERT_COLUMNS)


def high_risk_transactions(fraud: DataFrame, n: int = 100) -> DataFrame:
    """L2: flagged rows by risk then time, newest first, top ``n``."""
    return fraud.orderBy(F.desc("risk_score"), F.desc("timestamp"), "transaction_id").limit(n).select(*HIGH_RISK_COLUMNS)
