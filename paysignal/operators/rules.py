"""The four windowed fraud rules, risk score, reasons and levels.

Semantics (per transaction, whole-second time axis ``u``):

* velocity_check      - sum(amount) of the user's rows with u in [u0 - V, u0]
                        (peers in the same second included) > limit.
* geo_anomaly         - the previous or next row of the user (total order
                        timestamp, transaction_id) has a different non-NULL
                        city and is at most G seconds away.
* device_mule_check   - distinct non-NULL users on the device with u in
                        [u0 - M, u0] >= mule_users.
* failure_burst_check - status SUCCESS, the previous N rows of the user all
                        FAILED and the N-th previous is at most B seconds back.

Scale design: a plain ``Window.partitionBy(user_id)`` sends a hot user (one
key may hold a third of all rows) to one task. Every window here looks at
most ``lookback`` seconds back and ``lookahead`` seconds ahead, so each
partition is split into time slices of ``bucket`` seconds and every row is
also copied into the neighbouring slices whose view reaches it (halo rows).
Slice k sees exactly the rows with u in [k*bucket - lookback,
(k+1)*bucket + lookahead); windows run per (key, slice) and only the slice's
own (core) rows are kept. That is exact (a predecessor outside the view is
farther than any rule window, so the rule is false either way) and it copies
only rows within ``lookback + lookahead`` of a slice edge. Scoring is two
exchanges: (user, slice) then (device, slice). Cells that stay too large however they are cut by time go
to ``operators.dense``.

The two range aggregates (velocity sum, distinct users per device) are
differences of prefix frames (RANGE UNBOUNDED PRECEDING .. x), which Spark
grows incrementally, rather than sliding RANGE frames, which it
re-aggregates for every row (quadratic on a dense key). Hot (key, slice)
cells are cut into sub-slices (``hot_cells``).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from paysignal.config import NO_RULE_LABEL, RULE_LABELS, RULE_NAMES, RuleConfig
from paysignal.functions.columns import cents, coalesce_false, risk_level, unix_seconds
from paysignal.operators import dense
from paysignal.operators.keys import bounded, estimated_bytes

FEATURE_COLUMNS = (
    "transaction_date",
    "velocity_amount_1m",
    "device_users_10m",
    *RULE_NAMES,
    "risk_score",
    "fraud_reasons",
    "fraud_reason",
    "is_fraud",
    "risk_level",
)


SUB = 4096  # slice id = cell * SUB + sub-slice; max_split must stay below it


def _cell(x: Column, bucket: int) -> Column:
    return F.floor(x / F.lit(bucket)).cast("long")


def hot_counts(df: DataFrame, key: str, bucket: int, cfg: RuleConfig) -> DataFrame | None:
    """(_hk, _hc, _n): cells of more than ``cfg.hot_cell_rows`` rows; None if the input is
    small. A narrow pre-pass: only the key and time columns are read."""
    if estimated_bytes(df) < cfg.split_min_input_bytes:
        return None
    counts = (
        df.select(F.col(key).alias("_hk"), _cell(F.col("_u"), bucket).alias("_hc"))
        .filter(F.col("_hc").isNotNull())
        .groupBy("_hk", "_hc")
        .agg(F.count(F.lit(1)).alias("_n"))
        .filter(F.col("_n") > F.lit(int(cfg.hot_cell_rows)))
    )
    return bounded(counts)[0]


def most_slices(bucket: int, span: int, cfg: RuleConfig) -> int:
    """Into how many sub-slices a cell may be cut: a sub-slice of w seconds copies a row into
    1 + span / w views; narrower ones than span / 4 would copy more than they divide."""
    return 1 if span > bucket else min(int(cfg.max_split), SUB - 1, max(1, 4 * bucket // max(span, 1)))


def hot_cells(
    df: DataFrame, key: str, bucket: int, cfg: RuleConfig, span: int = 0, counts: DataFrame | None = None
) -> DataFrame | None:
    """(key, cell) -> sub-slice counts of the cell and its two neighbours, for the hot cells
    (``counts``, if known); None when there are none. A map too large to broadcast is joined by shuffle."""
    limit = most_slices(bucket, span, cfg)
    if not cfg.split_hot_cells or limit < 2:
        return None
    counts = hot_counts(df, key, bucket, cfg) if counts is None else counts
    if counts is None:
        return None
    counts = counts.select(
        "_hk", "_hc", F.least(F.ceil(F.col("_n") / F.lit(int(cfg.hot_cell_rows))), F.lit(limit)).cast("int").alias("_m")
    )
    # each hot cell informs itself and its two neighbours: one lookup per row
    spread = counts.select(
        "_hk",
        F.explode(F.array(*[F.struct((F.col("_hc") - d).alias("_hc"), F.lit(d).alias("_d"), F.col("_m").alias("_m")) for d in (-1, 0, 1)])).alias("_x"),
    ).select("_hk", "_x._hc", "_x._d", "_x._m")
    table = spread.groupBy("_hk", "_hc").agg(
        *[F.max(F.when(F.col("_d") == d, F.col("_m"))).alias(f"_m{i}") for i, d in enumerate((-1, 0, 1))]
    )
    table, _ = bounded(table)
    if table.isEmpty():
        table.unpersist()
        return None
    return table


def _slice_views(
    df: DataFrame, u: str, lookback: int, lookahead: int, bucket: int, out: str, key: str | None = None,
    hot: DataFrame | None = None,
) -> DataFrame:
    """Explode each row into the time slices whose view contains it.

    Adds ``out`` (slice id) and ``_core`` (this slice owns the row). Rows with
    a NULL time form one slice of their own (NULL id). With ``hot`` (from
    ``hot_cells``), cells of a hot key are cut into sub-slices; a row is then
    copied into every (sub-)slice of its own and neighbouring cells whose
    view [start - lookback, end + lookahead) contains it.
    """
    uc = F.col(u)
    if hot is None or lookback + lookahead > bucket:
        first = _cell(uc - F.lit(lookahead), bucket)
        last = _cell(uc + F.lit(lookback), bucket)
        return df.withColumn(out, F.explode_outer(F.sequence(first, last))).withColumn(
            "_core", F.col(out).eqNullSafe(_cell(uc, bucket))
        )
    k = _cell(uc, bucket)
    look = hot.withColumnRenamed("_hk", "_lk").withColumnRenamed("_hc", "_lc")
    j = df.join(look, df[key].eqNullSafe(look["_lk"]) & (k == look["_lc"]), "left").drop("_lk", "_lc")

    def subs(d: int, m: Column) -> Column:
        c = k + F.lit(d)
        w = F.ceil(F.lit(bucket) / m).cast("long")
        base = c * F.lit(bucket)
        lo = F.greatest(F.floor((uc - F.lit(lookahead) - base) / w), F.lit(0)).cast("long")
        hi = F.least(F.floor((uc + F.lit(lookback) - base) / w), (m - 1).cast("long")).cast("long")
        return F.when(lo <= hi, F.sequence(c * F.lit(SUB) + lo, c * F.lit(SUB) + hi)).otherwise(
            F.array().cast("array<bigint>")
        )

    ms = [F.coalesce(F.col(f"_m{i}"), F.lit(1)) for i in range(3)]
    ids = F.when(uc.isNull(), F.array(F.lit(None).cast("long"))).otherwise(
        F.concat(subs(-1, ms[0]), subs(0, ms[1]), subs(1, ms[2]))
    )
    w0 = F.ceil(F.lit(bucket) / ms[1]).cast("long")
    own = k * F.lit(SUB) + F.least(F.floor((uc - k * F.lit(bucket)) / w0), (ms[1] - 1).cast("long")).cast("long")
    return (
        j.withColumn(out, F.explode(ids))
        .withColumn("_core", F.col(out).eqNullSafe(own))
        .drop("_m0", "_m1", "_m2")
    )


def _prefix(part: list[str], upto: int = 0):
    """RANGE (UNBOUNDED PRECEDING, ``upto``] over the whole-second time axis.
    Spark grows prefix frames incrementally (one pass), unlike sliding RANGE
    frames, which it re-aggregates for every row."""
    return Window.partitionBy(*part).orderBy("_u").rangeBetween(Window.unboundedPreceding, upto)


def user_features(df: DataFrame, cfg: RuleConfig, hot: DataFrame | None = None) -> DataFrame:
    """velocity, geo and burst features over (user_id, slice) windows.

    velocity = prefix sum up to u minus prefix sum up to u - V - 1: the sum
    over [u - V, u] with same-second peers; a prefix count of non-NULL
    amounts keeps SUM's NULL-when-empty result. Rows with a NULL time are
    peers only of each other (their own slice), so they take the full sum."""
    back, ahead = cfg.user_lookback_s, cfg.user_lookahead_s
    part = ["user_id", "_ub"]
    view = _slice_views(df, "_u", back, ahead, cfg.bucket_for(back, ahead), "_ub", "user_id", hot).repartition(*part)
    # (_u, timestamp, id) is the same total order as (timestamp, id) since _u is
    # monotone in timestamp; leading with _u lets the prefix frames below reuse this sort
    ordered = Window.partitionBy(*part).orderBy("_u", "timestamp", "transaction_id")

    n = cfg.burst_failures
    status = F.upper(F.col("status"))
    lag_status = [F.lag(status, i).over(ordered) for i in range(1, n + 1)]
    lag_u = F.lag("_u", n).over(ordered)
    prev_city, next_city = F.lag("location_city").over(ordered), F.lead("location_city").over(ordered)
    prev_u, next_u = F.lag("_u").over(ordered), F.lead("_u").over(ordered)
    city, u = F.col("location_city"), F.col("_u")
    g = cfg.geo_window_s

    geo = (prev_city.isNotNull() & (prev_city != city) & ((u - prev_u) <= g)) | (
        next_city.isNotNull() & (next_city != city) & ((next_u - u) <= g)
    )
    burst = (status == F.lit("SUCCESS")) & ((u - lag_u) <= cfg.burst_window_s)
    for s in lag_status:
        burst = burst & (s == F.lit("FAILED"))

    amount = cents("amount")
    upto, before = _prefix(part), _prefix(part, -(cfg.velocity_window_s + 1))
    total = F.when(u.isNull(), F.sum(amount).over(upto)).otherwise(
        F.sum(amount).over(upto) - F.coalesce(F.sum(amount).over(before), F.lit(0))
    )
    present = F.when(u.isNull(), F.count(amount).over(upto)).otherwise(
        F.count(amount).over(upto) - F.count(amount).over(before)
    )
    velocity = F.when(present > 0, total)
    return (
        view.withColumn("geo_anomaly", coalesce_false(geo))
        .withColumn("failure_burst_check", coalesce_false(burst))
        .withColumn("_v", velocity)
        .withColumn("velocity_amount_1m", F.col("_v").cast("double"))
        .withColumn("velocity_check", coalesce_false(F.col("_v") > F.lit(cfg.velocity_limit)))
        .filter(F.col("_core"))
        .drop("_ub", "_core", "_v")
    )


def device_features(df: DataFrame, cfg: RuleConfig, hot: DataFrame | None = None) -> DataFrame:
    """Distinct non-NULL users per device over [u - M, u].

    With each row covering its user from u until the user's next row on the
    device or u + M + 1, whichever is first, the distinct count at time t is
        (rows up to t)
      - (rows up to t whose previous same-user row is at most M earlier)
      - (rows up to t - M - 1 whose next same-user row is more than M later, or absent),
    three prefix counts (same-second repeats supersede each other). Rows with
    a NULL time count each of their users once."""
    back = cfg.mule_window_s
    part = ["device_id", "_db"]
    # one exchange serves every window: (device, slice, user) and (device, slice)
    view = _slice_views(df, "_u", back, 0, cfg.bucket_for(back, 0), "_db", "device_id", hot).repartition(*part)
    per_user = Window.partitionBy(*part, "user_id").orderBy("_u", "transaction_id")
    u, has_user = F.col("_u"), F.col("user_id").isNotNull()
    prev_u, next_u = F.lag("_u").over(per_user), F.lead("_u").over(per_user)
    first = F.lag("transaction_id").over(per_user).isNull() & (F.row_number().over(per_user) == 1)
    rows = F.when(~has_user, 0).when(u.isNull(), F.when(first, 1).otherwise(0)).otherwise(1)
    superseding = F.when(has_user & u.isNotNull() & prev_u.isNotNull() & ((u - prev_u) <= back), 1).otherwise(0)
    lapsing = F.when(has_user & u.isNotNull() & (next_u.isNull() | ((next_u - u) > back)), 1).otherwise(0)
    flagged = view.withColumn("_r", rows).withColumn("_s", superseding).withColumn("_l", lapsing)
    upto, before = _prefix(part), _prefix(part, -(back + 1))
    users = F.sum("_r").over(upto) - F.sum("_s").over(upto) - F.coalesce(F.sum("_l").over(before), F.lit(0))
    return (
        flagged.withColumn("device_users_10m", F.coalesce(users, F.lit(0)).cast("int"))
        .withColumn("device_mule_check", F.col("device_users_10m") >= F.lit(cfg.mule_users))
        .filter(F.col("_core"))
        .drop("_db", "_core", "_r", "_s", "_l")
    )


def risk_score(cfg: RuleConfig) -> Column:
    total = sum(F.when(coalesce_false(name), F.lit(int(cfg.weights[name]))).otherwise(F.lit(0)) for name in RULE_NAMES)
    return F.least(total, F.lit(int(cfg.cap))).cast("int")


def fraud_reasons() -> Column:
    return F.array_compact(F.array(*[F.when(coalesce_false(n), F.lit(n)) for n in RULE_NAMES]))


def reason_text(label_style: str = "names") -> Column:
    """``names``: ``velocity_check,geo_anomaly``; ``labels``: ``Velocity check, Geo anomaly``
    or ``No rule triggered``."""
    if label_style == "names":
        return F.concat_ws(",", fraud_reasons())
    labels = F.concat_ws(", ", F.array_compact(F.array(*[F.when(coalesce_false(n), F.lit(RULE_LABELS[n])) for n in RULE_NAMES])))
    return F.when(labels == "", F.lit(NO_RULE_LABEL)).otherwise(labels)


def score(df: DataFrame, cfg: RuleConfig | None = None, label_style: str = "names") -> DataFrame:
    """Silver rows -> scored rows (input columns + FEATURE_COLUMNS).

    Needs transaction_id, user_id, timestamp, amount, location_city,
    device_id, status. Helper columns (lags, prev/next) are not kept.
    """
    cfg = cfg or RuleConfig()
    base = df.withColumn("timestamp", F.col("timestamp").cast("timestamp")).withColumn("_u", unix_seconds("timestamp"))
    user_span = cfg.user_lookback_s + cfg.user_lookahead_s
    user_bucket, device_bucket = cfg.bucket_for(cfg.user_lookback_s, cfg.user_lookahead_s), cfg.bucket_for(cfg.mule_window_s, 0)
    user_n, device_n = hot_counts(base, "user_id", user_bucket, cfg), hot_counts(base, "device_id", device_bucket, cfg)
    if too_dense(user_n, user_bucket, user_span, cfg) or too_dense(device_n, device_bucket, cfg.mule_window_s, cfg):
        return conclude(dense.features(base, cfg), label_style, cfg)
    user_hot = hot_cells(base, "user_id", user_bucket, cfg, user_span, user_n)
    device_hot = hot_cells(base, "device_id", device_bucket, cfg, cfg.mule_window_s, device_n)
    return conclude(device_features(user_features(base, cfg, user_hot), cfg, device_hot), label_style, cfg)


def too_dense(counts: DataFrame | None, bucket: int, span: int, cfg: RuleConfig) -> bool:
    """Some cell keeps more than ``hot_cell_rows`` rows a task however it is cut by time."""
    if not cfg.split_hot_cells or counts is None:
        return False
    most = int(cfg.hot_cell_rows) * most_slices(bucket, span, cfg)
    return not counts.filter(F.col("_n") > F.lit(most)).isEmpty()


def conclude(flagged: DataFrame, label_style: str = "names", cfg: RuleConfig | None = None) -> DataFrame:
    """Rule flags -> score, reasons, level (FEATURE_COLUMNS); helper columns go."""
    cfg = cfg or RuleConfig()
    return (
        flagged.withColumn("transaction_date", F.to_date("timestamp"))
        .withColumn("risk_score", risk_score(cfg))
        .withColumn("fraud_reasons", fraud_reasons())
        .withColumn("fraud_reason", reason_text(label_style))
        .withColumn("is_fraud", F.col("risk_score") > 0)
        .withColumn("risk_level", risk_level("risk_score"))
        .drop("_u")
    )


def rule_coverage(scored: DataFrame) -> DataFrame:
    """One row per rule: whether it fired anywhere, and how often."""
    agg = scored.agg(*[F.count_if(coalesce_false(n)).alias(n) for n in RULE_NAMES])
    stack = ", ".join(f"'{n}', `{n}`" for n in RULE_NAMES)
    return agg.select(F.expr(f"stack({len(RULE_NAMES)}, {stack}) as (rule, hits)")).withColumn(
        "fired", F.col("hits") > 0
    )
