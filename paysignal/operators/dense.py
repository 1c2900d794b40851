"""The fraud rules on keys of any density: nothing but blocks of bounded size is one task.

``rules.score`` cuts a hot key by time, which ends where a slice is as narrow as the
rules' view. Here the range rules never see rows, only seconds, and the ordered
rules see blocks of rows in their order:

* velocity: amounts are summed per (user, second); each sum enters at its second and
  leaves one second past the window; the total is a running sum over seconds.
* device users: (device, user, second) without repeats; a user enters when not seen
  for longer than the window, and leaves that long after the last sight; the number
  is a running sum over the seconds of the device.
* city jumps, failure bursts: users of more rows than a task should hold are cut into
  blocks by time cell, and cells that are still too large by split points of their
  order (timestamp, id) from a sample by hash. Rows inside a block see their
  neighbours there; the first and last rows of all blocks of a user meet once more,
  and only those that lack neighbours in their block take their flags from there.

Running sums are two-level (``spread.running_sums``), and what was found per
second comes back to the rows by equi-joins that deal hot seconds to several tasks.
Scores equal those of ``rules.score``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysignal.config import RuleConfig
from paysignal.functions.columns import cents, coalesce_false, unix_seconds
from paysignal.operators.keys import bounded
from paysignal.operators.spread import attach, running_sums

#: Samples per block that split points are taken from, and blocks of a cell at most.
SAMPLES = 64
CELL_BLOCKS = 1 << 20


def _sum_events(enter: DataFrame, leave: DataFrame, key: str, columns: list[str], block: int) -> DataFrame:
    """Running sums at the seconds of ``enter`` (which has ``_n``); ``leave`` has the same columns."""
    both = enter.withColumn("_asked", F.lit(True)).unionByName(leave, allowMissingColumns=True)
    events = both.groupBy(key, "_u").agg(
        *[F.sum(c).alias(c) for c in columns], F.sum("_n").alias("_n"), F.max("_asked").alias("_asked")
    )
    return running_sums(events, key, "_u", columns, block).filter("_asked").drop("_asked")


def velocity(df: DataFrame, cfg: RuleConfig) -> DataFrame:
    """(user_id, _u, _v, _n): the sum of amounts over [u - V, u], NULL if there is none."""
    amount = cents("amount")
    seconds = df.groupBy("user_id", "_u").agg(
        F.coalesce(F.sum(amount), F.lit(0)).alias("_v"), F.count(amount).alias("_c"), F.count(F.lit(1)).alias("_n")
    )
    leave = seconds.filter(F.col("_u").isNotNull()).select(
        "user_id", (F.col("_u") + cfg.velocity_window_s + 1).alias("_u"), (-F.col("_v")).alias("_v"), (-F.col("_c")).alias("_c")
    )
    sums = _sum_events(seconds, leave, "user_id", ["_v", "_c"], cfg.bucket_for(cfg.velocity_window_s, 0))
    return sums.select("user_id", "_u", F.when(F.col("_c") > 0, F.col("_v")).alias("_v"), "_n")


def device_users(df: DataFrame, cfg: RuleConfig) -> DataFrame:
    """(device_id, _u, _users, _n): distinct non-NULL users of the device over [u - M, u]."""
    back = cfg.mule_window_s
    seen = df.groupBy("device_id", "user_id", "_u").agg(F.count(F.lit(1)).alias("_n"))
    order = Window.partitionBy("device_id", "user_id", F.col("_u").isNull()).orderBy("_u")
    prev_u, next_u, u = F.lag("_u").over(order), F.lead("_u").over(order), F.col("_u")
    user = F.col("user_id").isNotNull()
    marked = seen.withColumns(
        {
            "_users": F.when(user & (prev_u.isNull() | (u - prev_u > back)), 1).otherwise(0),
            "_gone": F.when(user & u.isNotNull() & (next_u.isNull() | (next_u - u > back)), 1).otherwise(0),
        }
    )
    enter = marked.groupBy("device_id", "_u").agg(F.sum("_users").alias("_users"), F.sum("_n").alias("_n"))
    leave = marked.filter("_gone = 1").groupBy("device_id", (u + back + 1).alias("_u")).agg((-F.sum("_gone")).alias("_users"))
    return _sum_events(enter, leave, "device_id", ["_users"], cfg.bucket_for(back, 0))


def _blocks(df: DataFrame, cfg: RuleConfig) -> DataFrame:
    """Adds ``_blk`` (in the order of the rows of a user) and ``_hot``: the user has several blocks."""
    bucket, most = cfg.bucket_for(cfg.user_lookback_s, cfg.user_lookahead_s), int(cfg.hot_cell_rows)
    cell = F.floor(F.col("_u") / F.lit(bucket)).cast("long")
    counts = df.filter(F.col("_u").isNotNull()).groupBy("user_id", cell.alias("_cell")).agg(F.count(F.lit(1)).alias("_n"))
    users, _ = bounded(counts.groupBy(F.col("user_id").alias("_hu")).agg(F.sum("_n").alias("_t")).filter(F.col("_t") > most).select("_hu"))
    cells, _ = bounded(counts.filter(F.col("_n") > most).select(F.col("user_id").alias("_cu"), F.col("_cell").alias("_cc"), F.col("_n").alias("_cn")))
    place = F.struct(F.col("timestamp"), F.col("transaction_id"))
    inside = df["user_id"].eqNullSafe(cells["_cu"]) & (cell == cells["_cc"])
    # of each cell about SAMPLES rows a block, drawn by hash; every SAMPLES-th is a split point
    parts, whole = F.ceil(F.col("_cn") / F.lit(most)), 1 << 30
    lot = F.pmod(F.xxhash64("transaction_id", F.lit(1)), F.lit(whole)).cast("double")
    drawn = df.join(cells, inside).filter(lot * F.col("_cn") < F.lit(float(whole * SAMPLES)) * parts)
    points = drawn.groupBy("_cu", "_cc").agg(F.sort_array(F.collect_list(place)).alias("_p"), F.max(parts).cast("int").alias("_k"))
    at = F.transform(F.sequence(F.lit(1), F.greatest(F.col("_k") - 1, F.lit(1))), lambda i: F.get("_p", F.floor(i * F.size("_p") / F.col("_k")).cast("int")))
    splits, _ = bounded(points.select(F.col("_cu").alias("_su"), F.col("_cc").alias("_sc"), at.alias("_splits")))
    with_user = df.join(users, df["user_id"].eqNullSafe(users["_hu"]), "left").withColumn("_hot", F.col("_hu").isNotNull())
    with_user = with_user.drop("_hu").withColumn("_cell", cell)
    known = with_user.join(splits, with_user["user_id"].eqNullSafe(splits["_su"]) & (with_user["_cell"] == splits["_sc"]), "left")
    sub = F.coalesce(F.size(F.filter("_splits", lambda s: s <= place)), F.lit(0))
    timeless = -1 - F.pmod(F.xxhash64("transaction_id"), F.lit(1024))  # their rules compare no times, in any block
    blk = F.when(F.col("_u").isNull(), timeless).when(F.col("_hot"), F.col("_cell") * F.lit(CELL_BLOCKS) + sub).otherwise(F.lit(0))
    return known.withColumn("_blk", blk).drop("_su", "_sc", "_splits", "_cell")


def _ordered_flags(order, cfg: RuleConfig) -> dict[str, Column]:
    """geo_anomaly and failure_burst_check from the neighbours in ``order``."""
    n, g, u, city = cfg.burst_failures, cfg.geo_window_s, F.col("_u"), F.col("location_city")
    status = F.upper(F.col("status"))
    prev_city, next_city = F.lag("location_city").over(order), F.lead("location_city").over(order)
    geo = (prev_city.isNotNull() & (prev_city != city) & ((u - F.lag("_u").over(order)) <= g)) | (
        next_city.isNotNull() & (next_city != city) & ((F.lead("_u").over(order) - u) <= g)
    )
    burst = (status == F.lit("SUCCESS")) & ((u - F.lag("_u", n).over(order)) <= cfg.burst_window_s)
    for i in range(1, n + 1):
        burst = burst & (F.lag(status, i).over(order) == F.lit("FAILED"))
    return {"geo_anomaly": coalesce_false(geo), "failure_burst_check": coalesce_false(burst)}


def ordered_features(df: DataFrame, cfg: RuleConfig) -> DataFrame:
    n = cfg.burst_failures
    keys = ("_u", "timestamp", "transaction_id")
    view = _blocks(df, cfg).repartition("user_id", "_blk")
    inside = Window.partitionBy("user_id", "_blk").orderBy(*keys)
    marked = view.withColumns(
        {
            **_ordered_flags(inside, cfg),
            "_rn": F.row_number().over(inside),
            "_more": F.lead(F.lit(1)).over(inside).isNotNull(),
            "_many": F.lead(F.lit(1), n + 1).over(inside).isNotNull(),
        }
    )
    split = F.col("_hot") & F.col("_u").isNotNull()
    edge = split & ((F.col("_rn") <= n) | ~F.col("_more"))
    # the first and last n + 1 rows of all blocks: enough neighbours for every edge row
    near = marked.filter(split & ((F.col("_rn") <= n + 1) | ~F.col("_many")))
    again = near.withColumns(_ordered_flags(Window.partitionBy("user_id").orderBy(*keys), cfg))
    return marked.filter(~edge).unionByName(again.filter(edge)).drop("_rn", "_more", "_many", "_hot", "_blk")


def features(df: DataFrame, cfg: RuleConfig) -> DataFrame:
    """``df`` (with ``_u``) and the flags and numbers of the four rules."""
    tie, small = F.col("transaction_id"), cfg.split_min_input_bytes
    rows = attach(ordered_features(df, cfg), velocity(df, cfg), ["user_id", "_u"], tie, "_n", cfg.hot_cell_rows, small)
    rows = attach(rows, device_users(df, cfg), ["device_id", "_u"], tie, "_n", cfg.hot_cell_rows, small)
    return rows.withColumns(
        {
            "velocity_amount_1m": F.col("_v").cast("double"),
            "velocity_check": coalesce_false(F.col("_v") > F.lit(cfg.velocity_limit)),
            "device_users_10m": F.coalesce("_users", F.lit(0)).cast("int"),
            "device_mule_check": F.coalesce("_users", F.lit(0)) >= F.lit(cfg.mule_users),
        }
    ).drop("_v", "_users")


def score(df: DataFrame, cfg: RuleConfig | None = None, label_style: str = "names") -> DataFrame:
    """As ``rules.score``."""
    from paysignal.operators.rules import conclude

    cfg = cfg or RuleConfig()
    base = df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withColumn("_u", unix_seconds("timestamp"))
    return conclude(features(base, cfg), label_style, cfg)
