"""Scores and Gold kept up to date as rows arrive (R1-R7, A1-A4 on a stream).

Each micro-batch goes into Silver (``silver_store``), which notes the dates it
changed: dates of new rows, and of rows whose validity it took back. A changed row
can change the score of rows up to the rules' look-back after it and look-ahead
before it. So the dates within these are scored again, from Silver with its context, in
place of their stored scores, and so are their Gold partials. Scores, partials and
the number of the Silver commit they follow are one commit: a run that ended in between
is caught up by the next one, from the dates noted since.

In whatever order and however late rows arrive, the scores equal a batch run over
all of Silver.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession

from paysignal.config import STRICT, QualityProfile, RuleConfig
from paysignal.plans import gold_store, incremental, silver_store
from paysignal.sources.commits import Commits
from paysignal.sources.storage import TableStore

SCORES, FOLLOWS = "live_scores", "silver_commit"


def affected(dates: Iterable[str], cfg: RuleConfig) -> list[tuple[dt.date, dt.date]]:
    """Ranges of dates whose scores rows of ``dates`` can change, merged, in order."""
    days = lambda seconds: dt.timedelta(days=-(-seconds // 86400))
    back, ahead = days(cfg.user_lookahead_s), days(max(cfg.user_lookback_s, cfg.mule_window_s))
    out: list[tuple[dt.date, dt.date]] = []
    for day in sorted(dt.date.fromisoformat(d) for d in set(dates)):
        lo, hi = day - back, day + ahead
        if out and lo <= out[-1][1] + dt.timedelta(days=1):
            out[-1] = (out[-1][0], max(hi, out[-1][1]))
        else:
            out.append((lo, hi))
    return out


def catch_up(store: TableStore, cfg: RuleConfig | None = None, profile: QualityProfile = STRICT) -> dict:
    """Bring scores and partials to the last Silver commit."""
    cfg = cfg or RuleConfig()
    silver, commits = Commits(store, "silver"), Commits(store, "live")
    now, before = silver.current(), commits.current()
    missed = range(before.versions.get(FOLLOWS, 0) + 1, now.number + 1)
    dates = {d for n in missed for d in silver.at(n).notes.get("dates", "").split(",") if d}
    if not dates:
        return {"scored_dates": 0}
    rows, out, days = silver_store.silver(store, profile), None, set()
    for lo, hi in affected(dates, cfg):
        part = incremental.rescore_range(rows, lo, hi, cfg)
        out = part if out is None else out.unionByName(part)
        days |= {str(lo + dt.timedelta(days=i)) for i in range((hi - lo).days + 1)}
    version = store.replace_partitions(SCORES, out.drop("fraud_reasons"), "transaction_date", days.__contains__, before.version(SCORES))
    partials = gold_store.write_partials(store, store.read(SCORES, version), before, days)
    commits.commit(before, {SCORES: version, **partials, FOLLOWS: now.number})
    return {"scored_dates": len(days)}


def scores(store: TableStore) -> DataFrame:
    return store.read(SCORES, Commits(store, "live").current().version(SCORES))


def marts(store: TableStore) -> dict[str, DataFrame]:
    return gold_store.marts(store, "live")


def step(store: TableStore, batch: DataFrame, number: int, cfg: RuleConfig | None = None, as_of=None, profile: QualityProfile = STRICT, **kw) -> dict:
    done = silver_store.step(store, batch, number, as_of, profile, **kw)
    return done | catch_up(store, cfg, profile)


def run(
    spark: SparkSession,
    store: TableStore,
    bronze_path: str,
    checkpoint: str,
    cfg: RuleConfig | None = None,
    as_of=None,
    profile: QualityProfile = STRICT,
    max_files_per_trigger: int | None = None,
    **kw,
) -> list[dict]:
    """Every Bronze file that is new since the last run, batch by batch; stops when none is left."""
    reader = spark.readStream.schema(spark.read.parquet(bronze_path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    done: list[dict] = []
    query = (
        reader.parquet(bronze_path)
        .writeStream.foreachBatch(lambda rows, number: done.append(step(store, rows, number, cfg, as_of, profile, **kw)))
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return done
