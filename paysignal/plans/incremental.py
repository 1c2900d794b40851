"""Incremental rescoring of a date range (equals a full recompute on it).

A row at time t depends only on the same user's rows in
[t - user_lookback, t + user_lookahead] and the same device's rows in
[t - mule_window, t]. So rescoring the dates [start, end] reads Silver rows
with timestamp in [start - max_lookback, end + 1 day + lookahead), scores
them, and keeps the rows dated inside the range. The timestamp bounds are
plain filters, pushed into the parquet scan (and pruned by partition when
Silver is partitioned by date); the result replaces just those date
partitions in a new version of the scored table, which carries all others
over. A date of the range without rows any more has no partition any more.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.config import RuleConfig
from paysignal.operators import rules
from paysignal.sources.storage import TableStore


def _day(d) -> dt.date:
    return d if isinstance(d, dt.date) else dt.date.fromisoformat(str(d)[:10])


def context_bounds(start, end, cfg: RuleConfig) -> tuple[dt.datetime, dt.datetime]:
    back = max(cfg.user_lookback_s, cfg.mule_window_s)
    lo = dt.datetime.combine(_day(start), dt.time()) - dt.timedelta(seconds=back)
    hi = dt.datetime.combine(_day(end) + dt.timedelta(days=1), dt.time()) + dt.timedelta(seconds=cfg.user_lookahead_s + 1)
    return lo, hi


def rescore_range(silver: DataFrame, start, end, cfg: RuleConfig | None = None) -> DataFrame:
    """Scored rows for transaction dates in [start, end] (inclusive)."""
    cfg = cfg or RuleConfig()
    lo, hi = context_bounds(start, end, cfg)
    ts = F.col("timestamp")
    cond = (ts >= F.lit(lo.isoformat(" ")).cast("timestamp")) & (ts < F.lit(hi.isoformat(" ")).cast("timestamp"))
    if "transaction_date" in silver.columns:  # partition pruning on date-partitioned inputs
        d = F.col("transaction_date")
        cond = cond & (d >= F.lit(lo.date().isoformat()).cast("date")) & (d <= F.lit(hi.date().isoformat()).cast("date"))
    ctx = silver.filter(cond)
    scored = rules.score(ctx, cfg)
    d = F.col("transaction_date")
    return scored.filter((d >= F.lit(str(_day(start))).cast("date")) & (d <= F.lit(str(_day(end))).cast("date")))


def rescore_into(store: TableStore, silver: DataFrame, scored_name: str, start, end, cfg: RuleConfig | None = None) -> int:
    """Recompute the date range; the next version has its partitions anew."""
    out = rescore_range(silver, start, end, cfg)
    if store.exists(scored_name):  # same columns, same order as the stored table
        out = out.select(*store.read(scored_name).columns)
    first, last = str(_day(start)), str(_day(end))
    return store.replace_partitions(scored_name, out, "transaction_date", lambda day: first <= day <= last)
