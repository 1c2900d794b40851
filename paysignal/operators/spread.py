"""Building blocks for keys of any size: running sums in blocks with a carry,
and facts attached to rows whose key may be hot.

Both replace a window or join that would put all rows of one key into one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysignal.operators.keys import SMALL_INPUT_BYTES, bounded, is_small

#: Rows of one key beyond which they are dealt to several tasks.
ROWS_PER_TASK = 2_000_000


def same(left: DataFrame, right: DataFrame, on: Sequence[str]) -> Column:
    out = F.lit(True)
    for c in on:
        out = out & left[c].eqNullSafe(right[c])
    return out


def running_sums(events: DataFrame, key: str, time: str, columns: Sequence[str], block: int) -> DataFrame:
    """``events`` (one row per key and time) with each column replaced by its sum up to and including that time.

    Two levels: running sums inside blocks of ``block`` time units, and the sums of
    all earlier blocks, which are one row per key and block. A key is never one
    task, only its blocks' totals are. Rows without a time are a block of their own.
    """
    at = F.floor(F.col(time) / F.lit(block)).cast("long")
    rows = events.withColumn("_blk", at)
    inside = Window.partitionBy(key, "_blk").orderBy(time).rowsBetween(Window.unboundedPreceding, 0)
    before = Window.partitionBy(key).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    totals = rows.filter(F.col("_blk").isNotNull()).groupBy(key, "_blk").agg(*[F.sum(c).alias(c) for c in columns])
    carry = totals.select(
        F.col(key).alias("_ck"), F.col("_blk").alias("_cb"), *[F.sum(c).over(before).alias(f"_c_{c}") for c in columns]
    )
    run = rows.withColumns({c: F.sum(c).over(inside) for c in columns})
    joined = run.join(carry, run[key].eqNullSafe(carry["_ck"]) & (run["_blk"] == carry["_cb"]), "left")
    kept = [F.col(c) for c in events.columns if c not in columns]
    return joined.select(*kept, *[(F.col(c) + F.coalesce(F.col(f"_c_{c}"), F.lit(0))).alias(c) for c in columns])


def attach(
    rows: DataFrame,
    facts: DataFrame,
    on: Sequence[str],
    tie: Column,
    count: str = "_n",
    rows_per_task: int = ROWS_PER_TASK,
    small_input_bytes: int | None = SMALL_INPUT_BYTES,
) -> DataFrame:
    """``rows`` left-joined with ``facts``, which are unique by ``on`` (null equals null) and hold in
    ``count`` how many rows there are of each key.

    Keys of more than ``rows_per_task`` rows are dealt to several tasks: by ``tie``, and their
    one fact is repeated for each. There are at most rows / rows_per_task such keys.
    """
    named = {c: f"_f_{c}" for c in on}
    right = facts.select(*[F.col(c).alias(named[c]) for c in on], *[c for c in facts.columns if c not in (*on, count)], count)

    def key(left: DataFrame, other: DataFrame, names: dict) -> Column:
        out = F.lit(True)
        for c in on:
            out = out & left[c].eqNullSafe(other[names[c]])
        return out

    if is_small(rows, small_input_bytes):
        return rows.join(right, key(rows, right, named), "left").drop(*named.values(), count)
    parts = F.ceil(F.col(count) / F.lit(int(rows_per_task))).cast("int")
    hot, _ = bounded(facts.filter(F.col(count) > rows_per_task).select(*[F.col(c).alias(f"_h_{c}") for c in on], parts.alias("_m")))
    dealt = rows.join(hot, key(rows, hot, {c: f"_h_{c}" for c in on}), "left").drop(*[f"_h_{c}" for c in on])
    dealt = dealt.withColumn("_salt", F.pmod(F.xxhash64(tie), F.coalesce("_m", F.lit(1))).cast("int")).drop("_m")
    spread = right.withColumn("_part", F.explode(F.sequence(F.lit(0), F.greatest(parts, F.lit(1)) - 1)))
    joined = dealt.join(spread, key(dealt, spread, named) & (dealt["_salt"] == spread["_part"]), "left")
    return joined.drop(*named.values(), count, "_salt", "_part")
