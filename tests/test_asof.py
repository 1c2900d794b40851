"""Point-in-time join: boundaries, gaps, slices and hot users against brute force."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from paysignal.operators import asof
from paysignal.schema import DIM

DAY = dt.date(2024, 1, 1)


def day(n):
    return DAY + dt.timedelta(days=n)


def version(user, start, end, bank):
    return (user, f"name-{user}", bank, "FULL_KYC", "dev", "city", day(start), None if end is None else day(end), end is None, "h")


def rows(spark, items):
    rows = [(f"T{i}", u, None if n is None else dt.datetime.combine(day(n), dt.time(12))) for i, (u, n) in enumerate(items)]
    return spark.createDataFrame(rows, "transaction_id string, user_id string, timestamp timestamp")


def brute(items, dim):
    out = []
    for i, (u, n) in enumerate(items):
        fit = [v for v in dim if u is not None and n is not None and v[0] == u and v[6] <= day(n)]
        best = max(fit, key=lambda v: (v[6], v[7] or dt.date.max), default=None)
        out.append((f"T{i}", best[2] if best and (best[7] is None or day(n) < best[7]) else None))
    return sorted(out)


def found(df):
    return sorted((r.transaction_id, r.dim_bank) for r in df.collect())


def test_boundaries(spark):
    dim = [version("a", 5, 10, "one"), version("a", 10, None, "two"), version("b", 3, 3, "gone"), version("b", 3, None, "kept"), version("c", 1, 4, "left")]
    items = [("a", 4), ("a", 5), ("a", 9), ("a", 10), ("a", 300), ("b", 3), ("c", 3), ("c", 4), ("c", 50), ("x", 7), (None, 7), ("a", None)]
    got = asof.point_in_time(rows(spark, items), spark.createDataFrame(dim, DIM))
    assert found(got) == brute(items, dim)
    assert dict(found(got))["T3"] == "two" and dict(found(got))["T5"] == "kept" and dict(found(got))["T7"] is None


@pytest.mark.parametrize("seed", [1, 2])
def test_slices_and_hot_users(spark, seed):
    rng = random.Random(seed)
    dim = []
    for u in ("hot", "b", "c"):
        starts = sorted(rng.sample(range(200), 12))
        dim += [version(u, s, e, f"{u}{s}") for s, e in zip(starts, [*starts[1:], None])]
    items = [(rng.choice(["hot", "hot", "hot", "b", "c", "d"]), rng.randint(0, 220)) for _ in range(400)] + [("hot", 77)] * 200
    got = asof.point_in_time(
        rows(spark, items), spark.createDataFrame(dim, DIM), slice_days=7, rows_per_task=10, small_input_bytes=0
    )
    assert found(got) == brute(items, dim)


def test_no_range_join(spark, capsys):
    got = asof.point_in_time(rows(spark, [("a", 1)]), spark.createDataFrame([version("a", 0, None, "x")], DIM), small_input_bytes=0)
    got.explain("formatted")
    plan = capsys.readouterr().out
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan


def test_empty(spark):
    dim = spark.createDataFrame([], DIM)
    assert found(asof.point_in_time(rows(spark, [("a", 1)]), dim)) == [("T0", None)]
    assert asof.point_in_time(rows(spark, [("a", 1)]).filter(F.lit(False)), dim).count() == 0
