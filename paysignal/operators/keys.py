"""Repeated-key detection shared by dedup and the UTR uniqueness rule.

Repeated keys are found with a narrow aggregate (only the key column is
shuffled, after map-side partial counting). Real data repeats few keys, so
the repeated set is usually tiny: it is measured first (rows and key bytes)
and broadcast only within both bounds (a checked size); above them, the
join falls back to a shuffle join, where AQE splits skewed partitions. Either way full rows are never shuffled just to learn that a
key is unique.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

MAX_BROADCAST_ROWS = 2_000_000
MAX_BROADCAST_BYTES = 256 << 20
_PERSISTED: list[DataFrame] = []
# Below this estimated input size one shuffle is cheaper than the extra
# counting job, so operators take their single-job plan.
SMALL_INPUT_BYTES = 1 << 30


def estimated_bytes(df: DataFrame) -> int:
    """Bytes the plan reads: the sum of its leaf relations' sizes (file sizes
    for scans) from the analysed plan. Catalyst's estimate for a whole plan
    is useless here: without CBO a join's estimate is the product of its
    sides. No job runs."""
    try:
        leaves = df._jdf.queryExecution().analyzed().collectLeaves()
        return sum(int(str(leaves.apply(i).stats().sizeInBytes())) for i in range(leaves.size()))
    except Exception:  # noqa: BLE001 - no estimate: treat as large
        return 1 << 62


def is_small(df: DataFrame, small_input_bytes: int | None = SMALL_INPUT_BYTES) -> bool:
    return bool(small_input_bytes) and estimated_bytes(df) < small_input_bytes


def repeated_keys(df: DataFrame, key: str, count_col: str = "_n") -> DataFrame:
    """Non-NULL keys that occur more than once, with their counts."""
    return (
        df.select(key)
        .filter(F.col(key).isNotNull())
        .groupBy(key)
        .agg(F.count(F.lit(1)).alias(count_col))
        .filter(F.col(count_col) > 1)
    )


def bounded(
    keys: DataFrame, max_rows: int | None = MAX_BROADCAST_ROWS, max_bytes: int = MAX_BROADCAST_BYTES
) -> tuple[DataFrame, bool]:
    """(keys, broadcastable). Persists ``keys`` (it is read twice: measured,
    then joined) and broadcasts only when it has at most ``max_rows`` rows
    and at most ``max_bytes`` of key data (strings by their UTF-8 length,
    other values as 8 bytes) - one small job measures both. The persisted
    blocks are recomputed from lineage if an executor is lost."""
    if max_rows is None or max_rows <= 0:
        return keys, False
    keys = keys.persist()
    _PERSISTED.append(keys)
    size = sum(
        (F.coalesce(F.octet_length(F.col(f"`{f.name}`")), F.lit(0)) if isinstance(f.dataType, T.StringType) else F.lit(8))
        for f in keys.schema.fields
    )
    m = keys.limit(max_rows + 1).agg(F.count(F.lit(1)).alias("n"), F.sum(size).alias("b")).first()
    small = m.n <= max_rows and (m.b or 0) <= max_bytes
    return (F.broadcast(keys), True) if small else (keys, False)


def release() -> int:
    """Unpersist the key sets measured by ``bounded`` (call after the jobs
    that joined them have run); returns how many were released."""
    n = len(_PERSISTED)
    while _PERSISTED:
        _PERSISTED.pop().unpersist()
    return n
