"""Batch deduplication and duplicate reporting.

Keep-first is a hash aggregate of ``min(struct(order..., row))`` per key:
the aggregate is partial (map-side combine), so a key repeated a billion
times costs one row per map task before the shuffle, unlike
``row_number() OVER (PARTITION BY key)`` which ships every copy to one task.
Only rows whose key repeats reach that aggregate (see ``operators.keys``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paysignal.operators.keys import MAX_BROADCAST_ROWS, SMALL_INPUT_BYTES, bounded, is_small, repeated_keys


def row_key(df: DataFrame, key: str) -> Column:
    """The dedup key: ``key``, or for a NULL key the whole row (so identical
    bad copies collapse and distinct ones survive, as in the Bronze stream)."""
    whole = F.concat(F.lit("\u0000"), F.to_json(F.struct(*[F.col(c) for c in df.columns])))
    return F.coalesce(F.col(key).cast("string"), whole)


def keep_first(
    df: DataFrame,
    key: str = "transaction_id",
    order: tuple[str, ...] = ("timestamp",),
    max_broadcast_rows: int | None = MAX_BROADCAST_ROWS,
    small_input_bytes: int | None = SMALL_INPUT_BYTES,
) -> DataFrame:
    """One row per ``key``: smallest ``order`` (NULLs last), ties by the
    row's own column values. Rows with a NULL key are deduplicated as whole
    rows.

    Large inputs: repeated keys are found first (narrow aggregate). When they
    fit the broadcast bound, rows with a unique key pass straight through
    (broadcast anti join, no shuffle) and only rows with a repeated key are
    shuffled and reduced. Otherwise, and for inputs estimated below
    ``small_input_bytes``, every row goes through the aggregate. Either way
    the input is read in one pass per branch, never re-derived per NULL/non-NULL split."""
    cols = df.columns
    rank = []
    for c in order:
        rank += [F.col(c).isNull().alias(f"_o{len(rank)}"), F.col(c).alias(f"_o{len(rank) + 1}")]
    row = F.struct(*rank, *[F.col(c).alias(f"_v{i}") for i, c in enumerate(cols)])
    keyed = df.withColumn("_dk", row_key(df, key))

    def reduce(rows: DataFrame) -> DataFrame:
        return rows.groupBy("_dk").agg(F.min(row).alias("_m")).select(*[F.col(f"_m._v{i}").alias(c) for i, c in enumerate(cols)])

    if is_small(df, small_input_bytes):
        return reduce(keyed)
    reps, small = bounded(repeated_keys(keyed, "_dk").select("_dk"), max_broadcast_rows)
    if small:
        singles = keyed.join(reps, on="_dk", how="left_anti").select(*cols)
        multi = keyed.join(reps, on="_dk", how="left_semi")
        return singles.unionByName(reduce(multi))
    reps.unpersist()
    return reduce(keyed)


def duplicate_rows(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Rows whose key occurs more than once (all copies, NULL is a key)."""
    return (
        df.groupBy(key)
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > 1)
        .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("duplicate_rows"))
    )


def duplicate_groups(df: DataFrame, key: str = "transaction_id") -> DataFrame:
    """Keys occurring more than once and how often."""
    return df.groupBy(key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)
