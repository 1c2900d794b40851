"""Point-in-time join: transactions with the dimension version valid on their day (X11).

No range join: the days on which a user has transactions and the days on which the
user's versions start are one sorted list. Lists are cut into slices of
``slice_days``; inside a slice the last version is carried forward, and what a
slice starts with is carried over from the slices before, which are one row per
user and slice. Days are reduced before anything is sorted, so a user's rows meet
only in the final equi-join on (user, day), where a hot day is dealt to several tasks.

Rows without a user or time, of unknown users, and of days before a user's first
version get NULLs. Of versions that start on the same day the last one closed counts.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from paysignal.operators.keys import SMALL_INPUT_BYTES
from paysignal.operators.spread import ROWS_PER_TASK, attach

ATTRIBUTES = ("name", "bank", "kyc_status", "device_id", "location_city", "effective_start_date", "effective_end_date")
SLICE_DAYS = 64


def valid_versions(days: DataFrame, dim: DataFrame, attributes: Sequence[str] = ATTRIBUTES, slice_days: int = SLICE_DAYS) -> DataFrame:
    """``user_id, _day`` (distinct, further columns kept) with ``_version``, the struct of
    ``attributes`` valid that day: started on it or before, and not ended on it or before."""
    start, end = F.col("effective_start_date"), F.col("effective_end_date")
    attributes = tuple(dict.fromkeys((*attributes, "effective_end_date")))
    starts = dim.filter(F.col("user_id").isNotNull() & start.isNotNull()).select(
        "user_id",
        start.alias("_day"),
        F.struct(F.coalesce(end, F.lit("9999-12-31").cast("date")).alias("_until"), *attributes).alias("_v"),
    )
    part = F.floor(F.datediff("_day", F.lit("1970-01-01")) / F.lit(int(slice_days))).cast("long").alias("_slice")
    asked = days.select("*", F.lit(None).cast(starts.schema["_v"].dataType).alias("_v"), F.lit(1).alias("_kind"), part)
    events = asked.unionByName(starts.select("*", F.lit(0).alias("_kind"), part), allowMissingColumns=True)

    inside = Window.partitionBy("user_id", "_slice").orderBy("_day", "_kind", "_v._until").rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy("user_id").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    ends = events.groupBy("user_id", "_slice").agg(
        F.max(F.when(F.col("_kind") == 0, F.struct("_day", "_v._until", "_v"))).alias("_last")
    )
    carry = ends.select("user_id", "_slice", F.last("_last._v", ignorenulls=True).over(before).alias("_carried"))
    found = events.withColumn("_here", F.last("_v", ignorenulls=True).over(inside)).filter(F.col("_kind") == 1)
    found = found.join(carry, ["user_id", "_slice"], "left").withColumn("_version", F.coalesce("_here", "_carried"))
    open_ = F.col("_day") < F.col("_version._until")
    return found.select(*days.columns, F.when(open_, F.col("_version").dropFields("_until")).alias("_version"))


def point_in_time(
    rows: DataFrame,
    dim: DataFrame,
    attributes: Sequence[str] = ATTRIBUTES,
    time: str = "timestamp",
    prefix: str = "dim_",
    slice_days: int = SLICE_DAYS,
    rows_per_task: int = ROWS_PER_TASK,
    small_input_bytes: int | None = SMALL_INPUT_BYTES,
) -> DataFrame:
    """``rows`` (user_id, ``time``, transaction_id, ...) with ``prefix`` + attribute of the version valid on their day."""
    dated = rows.withColumn("_day", F.to_date(time))
    days = (
        dated.filter(F.col("user_id").isNotNull() & F.col("_day").isNotNull())
        .groupBy("user_id", "_day")
        .agg(F.count(F.lit(1)).alias("_n"))
    )
    facts = valid_versions(days, dim, attributes, slice_days)
    joined = attach(dated, facts, ["user_id", "_day"], F.col("transaction_id"), "_n", rows_per_task, small_input_bytes)
    return joined.select(*rows.columns, *[F.col(f"_version.{a}").alias(f"{prefix}{a}") for a in attributes])
