"""Gold from partial aggregates per date, refreshed where scores changed.

Three tables of mergeable partials, partitioned by date, one commit:

* cells: flagged rows by date, hour, merchant and city: counts, cents, score sums;
* keys: by date, merchant, city and user: what exact distinct users need;
* mules: rows of the device rule by date, user, device and city.

``refresh`` recomputes only the dates given, from those partitions of the scores;
a date without rows any more goes. The marts merge partials of all dates: sums of sums,
maxima of maxima, and exact distinct counts over the key sets. They equal the marts
computed from all scores. (Replacing a date instead of subtracting from it keeps
maxima and distinct counts exact.)
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from paysignal.functions.columns import cents, coalesce_false, money, round_ratio
from paysignal.operators.gold import fraud_transactions
from paysignal.sources.commits import Commit, Commits
from paysignal.sources.storage import TableStore

CELLS, KEYS, MULES = "gold_cells", "gold_keys", "gold_mules"


def partials(scored: DataFrame) -> dict[str, DataFrame]:
    fraud = fraud_transactions(scored)
    n, amount = F.count(F.lit(1)).alias("n"), F.sum(cents("amount")).alias("cents")
    cells = fraud.groupBy("transaction_date", F.hour("timestamp").alias("txn_hour"), "merchant_category", "location_city").agg(
        n, amount, F.sum("risk_score").alias("risk_sum"), F.count("risk_score").alias("risk_n")
    )
    keys = fraud.groupBy("transaction_date", "merchant_category", "location_city", "user_id").agg(
        n, amount, F.max("risk_score").alias("max_risk_score")
    )
    mules = scored.filter(coalesce_false("device_mule_check")).groupBy("transaction_date", "user_id", "device_id", "location_city").agg(
        n, F.max("risk_score").alias("max_risk_score"), F.min("timestamp").alias("first_ts"), F.max("timestamp").alias("last_ts")
    )
    return {CELLS: cells, KEYS: keys, MULES: mules}


def write_partials(store: TableStore, scored: DataFrame, before: Commit, dates: Iterable[str] | None = None) -> dict:
    """Versions of the three tables: of all dates, or with those of ``dates`` anew."""
    if dates is None or before.version(CELLS) is None:
        return {name: store.write(name, df, ["transaction_date"]) for name, df in partials(scored).items()}
    days = {str(d) for d in dates}
    asked = scored.filter(F.col("transaction_date").isin(*[F.lit(d).cast("date") for d in sorted(days)]))
    return {
        name: store.replace_partitions(name, df, "transaction_date", days.__contains__, before.version(name))
        for name, df in partials(asked).items()
    }


def refresh(store: TableStore, scored: DataFrame, start=None, end=None) -> dict:
    """Partials of all dates, or of those from ``start`` to ``end`` anew."""
    commits = Commits(store, "gold")
    before, dates = commits.current(), None
    if start is not None:
        first, last = (dt.date.fromisoformat(str(d)) for d in (start, end))
        dates = [str(first + dt.timedelta(days=i)) for i in range((last - first).days + 1)]
    return commits.commit(before, write_partials(store, scored, before, dates)).versions


def _merged(df: DataFrame, by: Iterable[str], *more) -> DataFrame:
    return df.groupBy(*by).agg(F.sum("n").alias("n"), money(F.sum("cents")).alias("amount"), *more)


def marts(store: TableStore, commits: str = "gold") -> dict[str, DataFrame]:
    """The Gold marts, as of the last commit, with the columns of ``operators.gold`` and ``operators.kpi``."""
    now = Commits(store, commits).current()
    cells, keys, mules = (store.read(name, now.version(name)) for name in (CELLS, KEYS, MULES))
    mean = round_ratio(F.sum("risk_sum"), F.sum("risk_n"))
    users = F.count_distinct("user_id")

    def named(df: DataFrame, n: str = "fraud_count", amount: str = "fraud_amount") -> DataFrame:
        return df.withColumnsRenamed({"n": n, "amount": amount})

    day = ["transaction_date", "merchant_category"]
    merchant_users = keys.groupBy(*day).agg(users.alias("distinct_users"))
    merchant = _merged(cells, day, mean.alias("avg_risk_score"))
    met = merchant["transaction_date"].eqNullSafe(merchant_users["transaction_date"]) & merchant["merchant_category"].eqNullSafe(
        merchant_users["merchant_category"]
    )
    return {
        "mule_accounts": mules.groupBy("user_id").agg(
            F.sum("n").alias("flagged_transaction_count"),
            F.count_distinct("device_id").alias("distinct_devices"),
            F.count_distinct("location_city").alias("distinct_cities"),
            F.max("max_risk_score").alias("max_risk_score"),
            F.min("first_ts").alias("first_flagged_timestamp"),
            F.max("last_ts").alias("last_flagged_timestamp"),
        ),
        "merchant_kpi": named(
            merchant.join(merchant_users, met).select(*[merchant[c] for c in merchant.columns], "distinct_users"), "fraud_transaction_count"
        ),
        "total": cells.agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("total_fraud_transactions"), money(F.sum("cents")).alias("total_fraud_amount"),
            mean.alias("avg_fraud_risk"),
        ),
        "daily": named(_merged(cells, ["transaction_date"])),
        "city": named(_merged(cells, ["location_city"])),
        "hour": named(_merged(cells, ["txn_hour"])),
        "merchant": named(_merged(cells, ["merchant_category"], mean.alias("avg_risk_score"))),
        "city_users": named(_merged(keys, ["location_city"], users.alias("unique_users"))),
        "users": named(_merged(keys, ["user_id"], F.max("max_risk_score").alias("max_risk_score")), "fraud_txn_count"),
    }
