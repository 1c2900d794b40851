"""Stores kept up to date step by step: equal to one run, and only what changed is written."""

import datetime as dt
import uuid

import pytest
from pyspark.sql import functions as F

from paysignal.config import STRICT, STRICT_RULES
from paysignal.operators import quality, scd2
from paysignal.plans import dimension_store, gold_store, silver_store
from paysignal.schema import CUSTOMER, RAW
from paysignal.sources.commits import Commits
from paysignal.sources.storage import TableStore, list_dir, path_exists, written_bytes

AS_OF = "2024-06-01"


@pytest.fixture()
def store(spark, tmp_dir):
    return TableStore(spark, f"{tmp_dir}/{uuid.uuid4().hex}")


def bronze(spark, items):
    """(id, utr, day) as raw rows."""
    rows = [
        (i, utr, "u", None if day is None else f"2024-01-{day:02d} 10:00:00", "5.0", "a@b", "c@d", "m", "city", "dev", "1.2.3.4", "success", "")
        for i, utr, day in items
    ]
    return spark.createDataFrame(rows, RAW)


def flags(df):
    return sorted(map(str, df.select("transaction_id", "utr_number", *STRICT_RULES, "_is_valid", "quarantine_reason").collect()))


ITEMS = [("a", "1", 1), ("b", "2", 1), ("c", "3", 2), ("d", None, 2), ("e", "9", None)]
MORE = [("f", "3", 3), ("g", "4", 3), ("h", None, 3), ("i", "9", 1)]


def test_two_silver_steps_equal_one(spark, store):
    silver_store.step(store, bronze(spark, ITEMS), 0, AS_OF)
    done = silver_store.step(store, bronze(spark, MORE), 1, AS_OF)
    assert flags(silver_store.checked(store)) == flags(quality.add_quality_rules(bronze(spark, ITEMS + MORE), STRICT, AS_OF))
    assert done["dates_rewritten"] == 2  # the dates of c and d, and of e: none; the date of b is only added to
    valid = {r.transaction_id for r in silver_store.silver(store).collect()}
    assert valid == {"a", "b", "g"} and silver_store.quarantine(store).count() == 6


def test_only_touched_buckets_and_dates_are_rewritten(spark, store):
    silver_store.step(store, bronze(spark, [(str(i), f"U{i}", 1 + i % 20) for i in range(200)]), 0, AS_OF)
    before = {t: set(store.partitions(t)) for t in (silver_store.LEDGER, silver_store.CHECKED)}
    silver_store.step(store, bronze(spark, [("new", "U7", 25)]), 1, AS_OF)
    after = {t: set(store.partitions(t)) for t in before}
    gone = {t: before[t] - after[t] for t in before}
    assert len(gone[silver_store.LEDGER]) == 1 and {x.rsplit("=")[-1] for x in gone[silver_store.CHECKED]} == {"2024-01-08"}
    assert len(after[silver_store.CHECKED] - before[silver_store.CHECKED]) == 2  # that date anew, and the new row's


def test_a_batch_delivered_again_changes_nothing(spark, store):
    silver_store.step(store, bronze(spark, ITEMS), 4, AS_OF)
    before = flags(silver_store.checked(store))
    assert not silver_store.step(store, bronze(spark, ITEMS), 4, AS_OF)["applied"]
    assert flags(silver_store.checked(store)) == before


def test_a_step_that_ends_before_its_commit_changes_nothing(spark, store, monkeypatch):
    silver_store.step(store, bronze(spark, ITEMS), 0, AS_OF)
    before = flags(silver_store.checked(store))
    with monkeypatch.context() as m:
        m.setattr(Commits, "commit", lambda *a, **k: 1 / 0)
        with pytest.raises(ZeroDivisionError):
            silver_store.step(store, bronze(spark, MORE), 1, AS_OF)
    assert flags(silver_store.checked(store)) == before
    assert not list_dir(spark, f"{store.root}/_stage")
    silver_store.step(store, bronze(spark, MORE), 1, AS_OF)
    assert flags(silver_store.checked(store)) == flags(quality.add_quality_rules(bronze(spark, ITEMS + MORE), STRICT, AS_OF))


def test_dates_of_many_folders_become_one(spark, store, monkeypatch):
    monkeypatch.setattr(silver_store, "FOLDERS", 3)
    for k in range(5):
        silver_store.step(store, bronze(spark, [(str(k), f"U{k}", 1)]), k, AS_OF)
    assert len(store.partitions(silver_store.CHECKED)) <= 3 and silver_store.silver(store).count() == 5


def test_two_writers_cannot_both_commit(spark, store):
    commits = Commits(store, "x")
    now = commits.current()
    commits.commit(now, {"t": 1})
    with pytest.raises(Exception):
        commits.commit(now, {"t": 2})
    assert commits.current().versions == {"t": 1}


def customers(spark, n, city=lambda i: "A"):
    return spark.createDataFrame([(f"u{i}", "n", "b", "k", "d", city(i)) for i in range(n)], CUSTOMER)


def dims(df):
    return sorted(map(str, df.collect()))


def test_dimension_steps_equal_apply(spark, store):
    plain, days = None, ["2024-01-01", "2024-02-01", "2024-02-01", "2024-03-01"]
    snapshots = [customers(spark, 50), customers(spark, 60, lambda i: "AB"[i % 2]), customers(spark, 60, lambda i: "CAB"[i % 3]), customers(spark, 20)]
    for snapshot, day in zip(snapshots, days):
        dimension_store.step(store, snapshot, day, buckets=8)
        plain = scd2.initialize(snapshot, day) if plain is None else scd2.apply(plain, snapshot, day)
        plain = spark.createDataFrame(plain.collect(), plain.schema)
    assert dims(dimension_store.dimension(store)) == dims(plain)
    assert dims(dimension_store.current(store)) == dims(plain.filter("is_current"))


def test_a_dimension_step_writes_touched_buckets_only(spark, store):
    dimension_store.step(store, customers(spark, 3000), "2024-01-01", buckets=64)
    dimension_store.step(store, customers(spark, 3000, lambda i: "B"), "2024-02-01", buckets=64)  # a history of 3000
    done = dimension_store.step(store, customers(spark, 3000, lambda i: "C" if i == 5 else "B"), "2024-03-01", buckets=64)
    assert done["buckets"] == 1
    whole, last = (written_bytes(spark, store.path(dimension_store.CURRENT, v)) for v in (2, 3))
    assert last < whole / 10
    added = [spark.read.parquet(store.path(dimension_store.HISTORY, v)).count() for v in (1, 2)]
    assert added == [3000, 1]
    versions = store.versions(dimension_store.CURRENT)
    assert dimension_store.step(store, customers(spark, 5, lambda i: "B"), "2024-04-01", buckets=64)["action"] == "no-op"
    assert store.versions(dimension_store.CURRENT) == versions


def scored(spark, rows):
    full = [(d, dt.datetime(2024, 1, d, h), "m", c, u, "d", a, 40, f, f) for d, h, c, u, a, f in rows]
    df = spark.createDataFrame(
        full, "n int, timestamp timestamp, merchant_category string, location_city string, user_id string, device_id string, "
        "amount double, risk_score int, is_fraud boolean, device_mule_check boolean"
    )
    return df.withColumn("transaction_date", F.to_date("timestamp")).drop("n")


def test_gold_reads_and_writes_touched_dates_only(spark, store):
    rows = [(d, h, "AB"[h % 2], f"u{h}", 10.0 * h, h != 3) for d in (1, 2, 3) for h in range(5)]
    gold_store.refresh(store, scored(spark, rows))
    before = set(store.partitions(gold_store.CELLS))
    changed = [r for r in rows if r[0] != 2] + [(2, 7, "C", "u9", 1.0, True)]
    gold_store.refresh(store, scored(spark, changed), "2024-01-02", "2024-01-02")
    assert {x.rsplit("=")[-1] for x in before - set(store.partitions(gold_store.CELLS))} == {"2024-01-02"}
    marts = gold_store.marts(store)
    assert marts["total"].first()[0] == 9 and {r.user_id for r in marts["mule_accounts"].collect()} == {"u0", "u1", "u2", "u4", "u9"}
    gold_store.refresh(store, scored(spark, changed).limit(0), "2024-01-01", "2024-01-31")
    assert marts["total"].first()[0] == 9  # readers of the version before are undisturbed
    marts = gold_store.marts(store)
    assert marts["total"].first()[0] == 0 and marts["merchant_kpi"].count() == 0


def test_empty_partitioned_tables_keep_their_schema(spark, store):
    store.write("t", spark.range(3).limit(0).withColumn("day", F.lit("x")), ["day"])
    assert store.read("t").columns == ["id", "day"] and store.read("t").count() == 0
    assert path_exists(spark, f"{store.path('t')}/_schema")
