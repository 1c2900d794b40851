"""Column expressions shared by the operators (all JVM-side, no UDFs)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MONEY = T.DecimalType(18, 2)
# Amounts beyond +-MONEY_MAX (infinite ones too) count as MONEY_MAX in sums: far
# over every rule limit, exact in double and decimal, and no cast can overflow.
MONEY_MAX = 1e15


def col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def coalesce_false(c) -> Column:
    """NULL rule results count as failed / not fired."""
    return F.coalesce(col(c), F.lit(False))


def cents(c) -> Column:
    """Money at cent precision, so sums are exact and order-independent.
    NaN counts as NULL; infinite and huge amounts count as MONEY_MAX."""
    x = col(c).cast("double")
    return F.when(~F.isnan(x), F.greatest(F.least(x, F.lit(MONEY_MAX)), F.lit(-MONEY_MAX))).cast(MONEY)


def money(sum_expr: Column) -> Column:
    """A decimal money total handed back as double."""
    return sum_expr.cast("double")


def round_ratio(num: Column, den: Column, digits: int = 2) -> Column:
    """round(num / den, digits) half-up in exact integer arithmetic.

    Used for averages of integer scores so every engine gets the same bits.
    ``num`` must be a non-negative integer expression; NULL when den is 0.
    """
    scale = 10**digits
    den = den.cast("long")
    q = F.call_function("div", num.cast("long") * (2 * scale) + den, F.nullif(den, F.lit(0).cast("long")) * 2)
    return F.when(den > 0, q.cast("double") / F.lit(float(scale)))


def unix_seconds(c) -> Column:
    """Whole seconds since the epoch (floor), the rule engines' time axis."""
    return F.unix_timestamp(col(c).cast("timestamp"))


def record_hash(*cols: str) -> Column:
    """sha2-256 hex over the tracked attributes, NULL -> '' and '||' separators."""
    return F.sha2(F.concat_ws("||", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in cols]), 256)


def risk_level(score) -> Column:
    # Bins (-1,0] None, (0,24] Low, (24,49] Medium, (49,79] High, (79,100] Critical.
    s = col(score)
    return (
        F.when(s.isNull(), F.lit(None).cast("string"))
        .when(s <= 0, "None")
        .when(s <= 24, "Low")
        .when(s <= 49, "Medium")
        .when(s <= 79, "High")
        .otherwise("Critical")
    )


def investigation_status(score) -> Column:
    # Fixed values: >= 80 Escalated, >= 40 Review, else New.
    s = col(score)
    return F.when(s >= 80, "Escalated").when(s >= 40, "Review").otherwise("New")


def inr_text(amount) -> Column:
    """Indian digit grouping, e.g. ``INR 12,34,567.50`` and ``-INR 5.00``.

    Two decimals, last three integer digits together, then groups of two.
    """
    a = col(amount)
    digits = F.format_string("%.2f", F.abs(a))
    grouped = F.regexp_replace(digits, r"(?<=\d)(?=(\d\d)*\d{3}\.)", ",")
    return F.concat(F.when(a < 0, F.lit("-")).otherwise(F.lit("")), F.lit("INR "), grouped)


def present(df: DataFrame) -> DataFrame:
    """Hand timestamps out as wall-clock TIMESTAMP_NTZ (session-TZ independent)."""
    out = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.TimestampType):
            out.append(F.col(f.name).cast(T.TimestampNTZType()).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)
