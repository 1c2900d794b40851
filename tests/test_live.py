"""Bronze without state, scores and Gold as rows arrive, Z-order files."""

import datetime as dt
import random
import uuid

import pytest
from pyspark.sql import functions as F

from paysignal.config import RuleConfig
from paysignal.operators import gold, rules
from paysignal.plans import bronze_store, gold_store, live, silver_store
from paysignal.schema import RAW, RAW_COLUMNS
from paysignal.sources.commits import Commits
from paysignal.sources.storage import TableStore
from paysignal.streaming import bronze

AS_OF = "2024-06-01"


@pytest.fixture()
def store(spark, tmp_dir):
    return TableStore(spark, f"{tmp_dir}/{uuid.uuid4().hex}")


def raw(spark, items):
    """(id, utr, user, time, amount, city, device, status)"""
    rows = [(i, u, who, at, str(a), "a@b", "c@d", "m", city, dev, "1.2.3.4", st, "err" if st == "FAILED" else "") for i, u, who, at, a, city, dev, st in items]
    return spark.createDataFrame(rows, RAW)


def keyed(df):
    return bronze.prepare_bronze(df.withColumn("_source_file", F.lit("f.csv")), dedup=False)


def plain(k, at="2024-01-01 10:00:00"):
    return (k, f"U{k}", "u", at, 5.0, "A", "d", "SUCCESS")


def test_late_copies_and_batches_delivered_again(spark, store, monkeypatch):
    monkeypatch.setattr(bronze_store, "FOLDERS", 2)
    batches = [[plain("1"), plain("1"), plain("2"), (None, *plain("x")[1:])], [plain("3")], [plain("2", "2025-01-01 10:00:00"), plain("4")], [(None, *plain("x")[1:])]]
    for number, items in enumerate(batches):
        bronze_store.step(store, keyed(raw(spark, items)), number, buckets=4)
    assert not bronze_store.step(store, keyed(raw(spark, [plain("9")])), 3, buckets=4)["applied"]
    got = bronze_store.rows(store).collect()
    assert sorted(str(r.transaction_id) for r in got) == ["1", "2", "3", "4", "None"]
    assert {r.transaction_id: r.timestamp.year for r in got}["2"] == 2024
    assert len(store.partitions(bronze_store.KEYS)) <= 4 * 2


def test_the_stream_holds_no_state(spark, store):
    base = f"{store.root}/in"
    for k in range(3):
        raw(spark, [plain(str(i)) for i in range(k * 2, k * 2 + 4)]).coalesce(1).write.mode("append").option("header", True).csv(base)
    done = bronze_store.run(spark, store, base, f"{store.root}/ckpt", buckets=4, max_files_per_trigger=1)
    assert done["state_rows"] == 0 and done["added"] == 8 and len(done["batches"]) == 3
    assert bronze_store.run(spark, store, base, f"{store.root}/ckpt", buckets=4)["added"] == 0


CFG = RuleConfig(
    velocity_window_s=40_000, velocity_limit=60.0, geo_window_s=90_000, mule_window_s=50_000, mule_users=2, burst_failures=2, burst_window_s=100_000
)


def moves(seed, n=80):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        at = dt.datetime(2024, 1, 1) + dt.timedelta(seconds=rng.randint(0, 12 * 86400))
        utr = f"U{i}" if rng.random() < 0.9 else f"U{rng.randint(0, n)}"
        out.append((f"T{i:03d}", utr, rng.choice("uvw"), str(at), rng.choice([5.0, 20.0]), rng.choice("AB"), rng.choice("de"), rng.choice(["SUCCESS", "FAILED"])))
    return out


SHOWN = ["transaction_id", "velocity_amount_1m", "device_users_10m", "risk_score", "fraud_reason", "transaction_date"]


def shown(df):
    return sorted(map(str, df.select(*SHOWN).collect()))


def test_scores_and_marts_follow_the_rows_in_any_order(spark, store, monkeypatch):
    items = moves(1)
    live.step(store, raw(spark, items[:40]), 0, CFG, AS_OF, buckets=4)
    with monkeypatch.context() as m:  # a run that ends between Silver and scores
        m.setattr(live, "catch_up", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            live.step(store, raw(spark, items[40:60]), 1, CFG, AS_OF, buckets=4)
    live.step(store, raw(spark, items[40:60]), 1, CFG, AS_OF, buckets=4)  # delivered again
    live.step(store, raw(spark, items[60:]), 2, CFG, AS_OF, buckets=4)
    whole = rules.score(silver_store.silver(store), CFG)
    assert shown(live.scores(store)) == shown(whole)
    marts, fraud = live.marts(store), gold.fraud_transactions(whole)
    assert sorted(map(str, marts["mule_accounts"].collect())) == sorted(map(str, gold.mule_accounts(whole).select(*marts["mule_accounts"].columns).collect()))
    assert marts["total"].first()[0] == fraud.count()
    assert Commits(store, "live").current().versions[live.FOLLOWS] == 3


def test_only_dates_in_reach_are_scored_again(spark, store):
    live.step(store, raw(spark, [plain(str(d), f"2024-01-{d:02d} 10:00:00") for d in range(1, 20)]), 0, RuleConfig(), AS_OF, buckets=4)
    before = set(store.partitions(live.SCORES))
    done = live.step(store, raw(spark, [plain("new", "2024-01-10 12:00:00")]), 1, RuleConfig(), AS_OF, buckets=4)
    gone = {x.rsplit("=", 1)[-1] for x in before - set(store.partitions(live.SCORES))}
    assert done["scored_dates"] == 3 and gone == {"2024-01-09", "2024-01-10", "2024-01-11"}
    assert live.affected(["2024-01-03", "2024-01-09", "2024-01-04"], RuleConfig()) == [
        (dt.date(2024, 1, 2), dt.date(2024, 1, 5)), (dt.date(2024, 1, 8), dt.date(2024, 1, 10))
    ]
    assert gold_store.CELLS in Commits(store, "live").current().versions


def test_a_filter_on_either_column_reads_few_files(spark, store):
    df = spark.range(40_000).select(
        F.concat(F.lit("u"), F.pmod(F.xxhash64("id"), F.lit(500)).cast("string")).alias("user_id"),
        F.when(F.col("id") % 97 > 0, F.pmod(F.xxhash64("id", F.lit(7)), F.lit(200)).cast("int")).alias("shop"),
    )
    store.write("t", df, zorder_by=["user_id", "shop"], files=64)
    assert sorted(map(str, store.read("t").collect())) == sorted(map(str, df.collect()))
    files = store.read("t").groupBy(F.input_file_name().alias("f")).agg(
        *[f(c).alias(f"{name}_{c}") for c in ("user_id", "shop") for name, f in (("lo", F.min), ("hi", F.max))]
    ).collect()
    assert len(files) > 40
    for column, values in (("user_id", [f"u{i}" for i in range(0, 500, 7)]), ("shop", range(0, 200, 7))):
        read = [sum(r[f"lo_{column}"] is not None and r[f"lo_{column}"] <= v <= r[f"hi_{column}"] for r in files) for v in values]
        assert sum(read) / len(read) < len(files) / 3  # about 8 of 64


def test_zorder_of_one_value_and_of_nothing(spark, store):
    df = spark.createDataFrame([("a", 1)] * 5 + [(None, None)], "user_id string, shop int")
    store.write("t", df, zorder_by=["user_id", "shop"], files=2)
    assert store.read("t").count() == 6
    store.write("e", df.limit(0), zorder_by=["user_id", "shop"], files=2)
    assert store.read("e").count() == 0 and RAW_COLUMNS


def test_live_scores_input_is_written_by_every_task(spark, tmp_dir, monkeypatch):
    import datetime as dt

    from paysignal.plans import io_queries
    from paysignal.sources import storage

    at = dt.datetime(2024, 1, 5)
    rows = [(i, at + dt.timedelta(minutes=i), i % 7, "view", 1.5, f'{{"k": {i % 9}}}') for i in range(400)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp, user_id long, event_type string, value double, props string")
    events.repartition(4).write.parquet(f"{tmp_dir}/events.parquet")
    seen = {}

    def run(spark_, store, path, *a, max_files_per_trigger, **kw):
        seen.update(files=sum(x.endswith(".parquet") for x in storage.list_dir(spark_, path)), most=max_files_per_trigger)

    monkeypatch.setattr(io_queries.live, "run", run)
    monkeypatch.setattr(io_queries.live, "scores", lambda store: events.selectExpr(*[f"1 AS {c}" for c in io_queries.SCORED_OUT]))
    io_queries.live_scores(spark, tmp_dir)
    assert seen["files"] > 3 * 3 and seen["files"] / 2 < seen["most"] < seen["files"]  # two batches
