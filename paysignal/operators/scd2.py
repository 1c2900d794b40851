"""Type 2 customer/device dimension as pure DataFrame transforms.

``apply(dim, source, as_of)`` returns the next dimension version; it never
overwrites what it reads (storage writes a new version directory, see
``sources.storage``). Tracked attributes are device_id, location_city, bank
and kyc_status (``record_hash``); a name-only change is not a new version.
Users missing from the source keep their current row (no expiry by absence).

Scale: one full outer join of the current rows with the (deduplicated)
source on user_id; both sides are unique per user_id after dedup, so the
join is 1:1 with no hot key. Historical (non-current) versions bypass the
join.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysignal.functions.columns import coalesce_false, record_hash
from paysignal.schema import DIM, DIM_COLUMNS

ATTRIBUTES = ("user_id", "name", "bank", "kyc_status", "device_id", "location_city")
TRACKED = ("device_id", "location_city", "bank", "kyc_status")


def _date(as_of) -> Column:
    if as_of is None:
        return F.current_date()
    if isinstance(as_of, Column):
        return as_of.cast("date")
    if isinstance(as_of, (dt.date, dt.datetime)):
        as_of = as_of.isoformat()[:10]
    return F.lit(str(as_of)).cast("date")


def dedup_source(source: DataFrame) -> DataFrame:
    """One source row per user_id (a snapshot must not repeat a user; if it
    does, keep the smallest attribute tuple, deterministically).

    Small snapshots: one groupBy(user_id), whose partitioning the SCD2 join
    reuses. Large ones: the repeated-key dedup, so only repeated users are
    shuffled and reduced (unique users pass through)."""
    from paysignal.operators.dedup import keep_first
    from paysignal.operators.keys import is_small

    rows = source.select(*[F.col(c).cast("string").alias(c) for c in ATTRIBUTES]).filter(F.col("user_id").isNotNull())
    if not is_small(rows):
        return keep_first(rows, key="user_id", order=())
    row = F.struct(*[F.col(c).alias(c) for c in ATTRIBUTES[1:]])
    return (
        rows.groupBy("user_id")
        .agg(F.min(row).alias("_r"))
        .select("user_id", *[F.col(f"_r.{c}").alias(c) for c in ATTRIBUTES[1:]])
    )


def normalize_source(source: DataFrame, as_of=None) -> DataFrame:
    """C1 + C2: start = as_of date, end NULL, current, record_hash."""
    return source.select(
        *[F.col(c).cast("string").alias(c) for c in ATTRIBUTES],
        _date(as_of).alias("effective_start_date"),
        F.lit(None).cast("date").alias("effective_end_date"),
        F.lit(True).alias("is_current"),
        record_hash(*TRACKED).alias("record_hash"),
    )


def initialize(source: DataFrame, as_of=None) -> DataFrame:
    """The first version of the dimension from a snapshot."""
    return normalize_source(dedup_source(source), as_of).select(*DIM_COLUMNS)


def detect_changes(source: DataFrame, dim: DataFrame, as_of=None) -> DataFrame:
    """Source rows classified against the current dimension rows.

    Columns: the 10 dimension columns of the source version plus
    ``current_record_hash`` and ``change`` in (new, changed, unchanged).
    """
    src = normalize_source(dedup_source(source), as_of)
    cur = dim.filter(coalesce_false("is_current")).select("user_id", F.col("record_hash").alias("current_record_hash"))
    joined = src.join(cur, on="user_id", how="left")
    change = (
        F.when(F.col("current_record_hash").isNull(), "new")
        .when(F.col("record_hash") != F.col("current_record_hash"), "changed")
        .otherwise("unchanged")
    )
    return joined.withColumn("change", change)


def expire_set(changes: DataFrame) -> DataFrame:
    """J4 input: users whose current version must be closed."""
    return changes.filter(F.col("change") == "changed").select("user_id", "record_hash", "effective_start_date")


def insert_set(changes: DataFrame) -> DataFrame:
    """Brand-new users and new versions of changed users."""
    new = changes.filter(F.col("change") == "new").select(*DIM_COLUMNS)
    changed = changes.filter(F.col("change") == "changed").select(*DIM_COLUMNS)
    return new.unionByName(changed)


def apply(dim: DataFrame, source: DataFrame, as_of=None, mark_changes: bool = False) -> DataFrame:
    """C7 (J4 + C4 in one pass): the next dimension version.

    Current rows whose user changed are closed (end = as_of, not current);
    new versions and new users are added; everything else is unchanged.
    ``mark_changes`` adds boolean ``_changed`` (closed or added rows), so a
    caller can detect a no-op without a second join.
    """
    day = _date(as_of)
    src = normalize_source(dedup_source(source), as_of).withColumn("_s", F.lit(True))
    dim = dim.select(*DIM_COLUMNS)
    history = dim.filter(~coalesce_false("is_current"))
    cur = dim.filter(coalesce_false("is_current")).withColumn("_t", F.lit(True))
    t = cur.select(*[F.col(c).alias(f"t_{c}") for c in DIM_COLUMNS], "_t")
    s = src.select(*[F.col(c).alias(f"s_{c}") for c in DIM_COLUMNS], "_s")
    j = t.join(s, F.col("t_user_id") == F.col("s_user_id"), "full_outer")
    has_t, has_s = coalesce_false("_t"), coalesce_false("_s")
    changed = has_t & has_s & (F.col("t_record_hash") != F.col("s_record_hash"))
    kept = F.struct(
        *[
            (
                F.when(changed, day).otherwise(F.col("t_effective_end_date")) if c == "effective_end_date"
                else F.when(changed, F.lit(False)).otherwise(F.col("t_is_current")) if c == "is_current"
                else F.col(f"t_{c}")
            ).alias(c)
            for c in DIM_COLUMNS
        ],
        changed.alias("_changed"),
    )
    added = F.struct(*[F.col(f"s_{c}").alias(c) for c in DIM_COLUMNS], F.lit(True).alias("_changed"))
    rows = F.array_compact(F.array(F.when(has_t, kept), F.when(has_s & (~has_t | changed), added)))
    out = [*DIM_COLUMNS, "_changed"] if mark_changes else list(DIM_COLUMNS)
    merged = j.select(F.explode(rows).alias("_r")).select(*[F.col(f"_r.{c}").alias(c) for c in out])
    if mark_changes:
        history = history.withColumn("_changed", F.lit(False))
    return history.unionByName(merged)


def has_changes(source: DataFrame, dim: DataFrame, as_of=None) -> bool:
    """Whether applying ``source`` would change the dimension (one small job)."""
    changes = detect_changes(source, dim, as_of)
    return not changes.filter(F.col("change") != "unchanged").isEmpty()


def current(dim: DataFrame) -> DataFrame:
    """Current versions only."""
    return dim.filter(coalesce_false("is_current"))


def empty_dim(spark) -> DataFrame:
    return spark.createDataFrame([], DIM)
