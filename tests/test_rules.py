"""Fraud rules: boundaries, sliced windows vs a brute-force checker, plan shape,
and the deterministic fixture's golden numbers."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from paysignal.config import RuleConfig
from paysignal.operators import generator, rules
from paysignal.plans import silver as silver_plan
from paysignal.schema import TYPED

T0 = dt.datetime(2024, 1, 1, 12, 0, 0)


def rows(spec):
    """spec: (txn, user, device, seconds, amount, city, status)"""
    out = []
    for txn, user, device, secs, amount, city, status in spec:
        out.append(
            (txn, "UTR" + txn, user, T0 + dt.timedelta(seconds=secs), float(amount), "a@b", "c@d", "m", city, device,
             "1.1.1.1", status, "err" if status == "FAILED" else None)
        )
    return out


def score(spark, spec, cfg=None):
    df = spark.createDataFrame(rows(spec), TYPED)
    out = rules.score(df, cfg or RuleConfig()).orderBy("transaction_id").collect()
    return {r.transaction_id: r for r in out}


def test_velocity_frame_is_inclusive_at_60s(spark):
    r = score(spark, [("a", "u", "d1", 0, 30000, "X", "SUCCESS"), ("b", "u", "d2", 60, 20000.01, "X", "SUCCESS"),
                      ("c", "u", "d3", 121, 1, "X", "SUCCESS")])
    assert r["b"].velocity_check and r["b"].velocity_amount_1m == 50000.01
    assert not r["a"].velocity_check and not r["c"].velocity_check


def test_velocity_limit_is_strict(spark):
    r = score(spark, [("a", "u", "d", 0, 25000, "X", "SUCCESS"), ("b", "u", "d", 10, 25000, "X", "SUCCESS")])
    assert not r["b"].velocity_check  # exactly 50000 is not above the limit


def test_velocity_counts_same_second_peers(spark):
    r = score(spark, [("a", "u", "d", 5, 30000, "X", "SUCCESS"), ("b", "u", "d", 5, 30000, "X", "SUCCESS")])
    assert r["a"].velocity_check and r["b"].velocity_check


def test_geo_boundary_300s_both_directions(spark):
    r = score(spark, [("a", "u", "d", 0, 1, "Mumbai", "SUCCESS"), ("b", "u", "d", 300, 1, "Delhi", "SUCCESS"),
                      ("c", "u", "d", 601, 1, "Pune", "SUCCESS")])
    assert r["a"].geo_anomaly and r["b"].geo_anomaly and not r["c"].geo_anomaly


def test_geo_only_adjacent_rows(spark):
    r = score(spark, [("a", "u", "d", 0, 1, "Mumbai", "SUCCESS"), ("b", "u", "d", 10, 1, "Mumbai", "SUCCESS"),
                      ("c", "u", "d", 20, 1, "Mumbai", "SUCCESS")])
    assert not any(x.geo_anomaly for x in r.values())


def test_mule_three_users_flags_from_third(spark):
    r = score(spark, [("a", "u1", "D", 0, 1, "X", "SUCCESS"), ("b", "u2", "D", 300, 1, "X", "SUCCESS"),
                      ("c", "u3", "D", 600, 1, "X", "SUCCESS"), ("d", "u4", "D", 1300, 1, "X", "SUCCESS")])
    assert [r[k].device_mule_check for k in "abcd"] == [False, False, True, False]
    assert r["c"].device_users_10m == 3


def test_mule_ignores_null_users(spark):
    r = score(spark, [("a", "u1", "D", 0, 1, "X", "SUCCESS"), ("b", None, "D", 10, 1, "X", "SUCCESS"),
                      ("c", "u2", "D", 20, 1, "X", "SUCCESS")])
    assert not r["c"].device_mule_check and r["c"].device_users_10m == 2


def test_burst_needs_five_failures_within_600s(spark):
    spec = [(f"f{i}", "u", "d", i * 60, 1, "X", "FAILED") for i in range(5)] + [("s", "u", "d", 300, 1, "X", "SUCCESS")]
    r = score(spark, spec)
    assert r["s"].failure_burst_check and r["s"].risk_score == 35
    spec2 = [(f"f{i}", "u", "d", i * 151, 1, "X", "FAILED") for i in range(5)] + [("s", "u", "d", 604, 1, "X", "SUCCESS")]
    assert not score(spark, spec2)["s"].failure_burst_check
    spec3 = [(f"f{i}", "u", "d", i * 60, 1, "X", "FAILED") for i in range(4)] + [("s", "u", "d", 300, 1, "X", "SUCCESS")]
    assert not score(spark, spec3)["s"].failure_burst_check


def test_score_reasons_and_levels(spark):
    spec = [("a", "u", "D", 0, 60000, "Mumbai", "SUCCESS"), ("b", "u", "D", 30, 1, "Delhi", "SUCCESS"),
            ("c", "v", "D", 40, 1, "Delhi", "SUCCESS"), ("d", "w", "D", 50, 1, "Delhi", "SUCCESS"),
            ("e", "w", "D", 55, 60000, "Pune", "SUCCESS")]
    r = score(spark, spec)
    assert r["a"].risk_score == 65 and r["a"].fraud_reason == "velocity_check,geo_anomaly" and r["a"].risk_level == "High"
    assert r["c"].risk_score == 0 and r["c"].risk_level == "None" and not r["c"].is_fraud
    assert r["d"].fraud_reasons == ["geo_anomaly", "device_mule_check"] and r["d"].risk_score == 65
    assert r["e"].risk_score == 100 and r["e"].risk_level == "Critical"


def test_labels_style(spark):
    df = spark.createDataFrame(rows([("a", "u", "D", 0, 1, "X", "SUCCESS")]), TYPED)
    assert rules.score(df, label_style="labels").first().fraud_reason == "No rule triggered"


def test_empty_input_keeps_schema(spark):
    df = spark.createDataFrame([], TYPED)
    out = rules.score(df)
    assert out.count() == 0
    assert {"risk_score", "fraud_reason", "is_fraud", "risk_level", "transaction_date"} <= set(out.columns)


def test_scoring_plan_has_two_exchanges(spark):
    df = spark.createDataFrame(rows([("a", "u", "D", 0, 1, "X", "SUCCESS")]), TYPED)
    plan = rules.score(df)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 2, plan


# ---------------------------------------------------------------- brute force

def brute(spec, cfg):
    """Whole-partition window semantics: total order (time NULLS FIRST, id);
    a NULL time is a peer of other NULL times only."""
    out = {}
    by_user, by_dev = {}, {}
    for r in spec:
        by_user.setdefault(r[1], []).append(r)
        by_dev.setdefault(r[2], []).append(r)

    def in_frame(x, secs, width):
        return x[3] is None if secs is None else (x[3] is not None and secs - width <= x[3] <= secs)

    for txn, user, device, secs, amount, city, status in spec:
        mine = sorted(by_user[user], key=lambda x: (x[3] is not None, x[3] or 0, x[0]))
        pos = [x[0] for x in mine].index(txn)
        vel = sum(round(x[4], 2) for x in mine if in_frame(x, secs, cfg.velocity_window_s))
        prev = mine[pos - 1] if pos > 0 else None
        nxt = mine[pos + 1] if pos + 1 < len(mine) else None

        def near(other, later):
            if other is None or secs is None or other[3] is None or other[5] == city:
                return False
            return (other[3] - secs if later else secs - other[3]) <= cfg.geo_window_s

        geo = near(prev, False) or near(nxt, True)
        n = cfg.burst_failures
        burst = (
            status == "SUCCESS" and secs is not None and pos >= n
            and all(mine[pos - i][6] == "FAILED" for i in range(1, n + 1))
            and mine[pos - n][3] is not None and secs - mine[pos - n][3] <= cfg.burst_window_s
        )
        users = {x[1] for x in by_dev[device] if in_frame(x, secs, cfg.mule_window_s) and x[1] is not None}
        out[txn] = (round(vel, 2) > cfg.velocity_limit, geo, len(users) >= cfg.mule_users, burst, len(users))
    return out


row_strategy = st.tuples(
    st.sampled_from(["u1", "u2", "u3", None]),
    st.sampled_from(["d1", "d2"]),
    st.one_of(st.integers(min_value=0, max_value=200), st.integers(min_value=0, max_value=200), st.none()),
    st.sampled_from([1.0, 10.0, 25.5, 40.0]),
    st.sampled_from(["A", "B"]),
    st.sampled_from(["SUCCESS", "FAILED"]),
)


def rows_nullable(spec):
    out = rows([(t, u, d, 0 if s is None else s, a, c, st_) for t, u, d, s, a, c, st_ in spec])
    return [r if spec[i][3] is not None else r[:3] + (None,) + r[4:] for i, r in enumerate(out)]


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(row_strategy, min_size=1, max_size=30), st.sampled_from([5, 7, 13, 50]))
def test_sliced_windows_match_brute_force(spark, raw, bucket):
    cfg = RuleConfig(velocity_window_s=20, velocity_limit=50.0, geo_window_s=9, mule_window_s=15, mule_users=2,
                     burst_failures=2, burst_window_s=30, bucket_seconds=bucket)
    spec = [(f"t{i:03d}", u, d, s, a, c, st_) for i, (u, d, s, a, c, st_) in enumerate(raw)]
    df = spark.createDataFrame(rows_nullable(spec), TYPED)
    got = {
        r.transaction_id: (r.velocity_check, r.geo_anomaly, r.device_mule_check, r.failure_burst_check, r.device_users_10m)
        for r in rules.score(df, cfg).collect()
    }
    assert got == brute(spec, cfg)


# --------------------------------------------------------------- fixture golden

def test_fixture_golden_counts(spark):
    raw = generator.fixture(spark)
    assert raw.count() == 5000 and raw.select("transaction_id").distinct().count() == 4980
    frames = silver_plan.build(raw, as_of="2026-09-01 00:00:00", dedup_first=True)
    assert frames.silver.count() == 4980
    other = silver_plan.build(raw, as_of="2026-09-01 00:00:00", dedup_first=False)
    assert other.silver.count() == 4960 and other.quarantine.count() == 40
    scored = rules.score(frames.silver).cache()
    counts = scored.agg(*[F.count_if(c).alias(c) for c in ("velocity_check", "geo_anomaly", "device_mule_check", "failure_burst_check", "is_fraud")]).first()
    assert tuple(counts) == (2, 8, 1, 1, 11)
    hist = {r.risk_score: r["count"] for r in scored.filter("is_fraud").groupBy("risk_score").count().collect()}
    assert hist == {25: 7, 35: 1, 40: 2, 65: 1}
    ids = {r.transaction_id for r in scored.filter("velocity_check").collect()}
    assert ids == {"TXN-00000055", "TXN-00000132"}
    assert rules.rule_coverage(scored).filter(~F.col("fired")).count() == 0
    scored.unpersist()


@settings(max_examples=40, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(row_strategy, min_size=1, max_size=40),
    st.sampled_from([40, 47, 64]),
    st.sampled_from([1, 2, 3]),
    st.sampled_from([2, 3, 5]),
)
def test_hot_cell_splitting_matches_brute_force(spark, raw, bucket, hot_rows, split):
    cfg = RuleConfig(velocity_window_s=20, velocity_limit=50.0, geo_window_s=9, mule_window_s=15, mule_users=2,
                     burst_failures=2, burst_window_s=30, bucket_seconds=bucket, split_hot_cells=True,
                     hot_cell_rows=hot_rows, max_split=split, split_min_input_bytes=0)
    spec = [(f"t{i:03d}", u, d, s, a, c, st_) for i, (u, d, s, a, c, st_) in enumerate(raw)]
    df = spark.createDataFrame(rows_nullable(spec), TYPED)
    got = {
        r.transaction_id: (r.velocity_check, r.geo_anomaly, r.device_mule_check, r.failure_burst_check, r.device_users_10m)
        for r in rules.score(df, cfg).collect()
    }
    assert got == brute(spec, cfg)


def test_hot_key_is_split_across_sub_slices(spark):
    cfg = RuleConfig(bucket_seconds=7200, hot_cell_rows=10, max_split=8, split_min_input_bytes=0)
    spec = [(f"h{i:04d}", "HOT", "D", i * 36, 1, "X", "SUCCESS") for i in range(200)]
    df = spark.createDataFrame(rows(spec), TYPED).withColumn("_u", F.unix_timestamp("timestamp"))
    hot = rules.hot_cells(df, "user_id", 7200, cfg)
    assert hot is not None and hot.filter("_m1 = 8").count() == 1
    view = rules._slice_views(df, "_u", 900, 300, 7200, "_ub", "user_id", hot)
    cores = view.filter("_core").groupBy("_ub").count().collect()
    assert len(cores) == 8 and sum(r["count"] for r in cores) == 200
