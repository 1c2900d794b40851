"""Scoring in blocks of bounded size equals scoring in slices, on keys of any density."""

import random

import pytest
from pyspark.sql import functions as F

from paysignal.config import RuleConfig
from paysignal.functions.columns import unix_seconds
from paysignal.operators import dense, rules

SCHEMA = (
    "transaction_id string, user_id string, timestamp string, amount double, location_city string, "
    "device_id string, status string"
)


def rows_of(seed, n, seconds, users=3):
    rng = random.Random(seed)
    out = []
    for i in range(n):
        at = rng.randint(0, seconds)
        time = None if rng.random() < 0.02 else f"2024-01-01 {at // 3600:02d}:{at // 60 % 60:02d}:{at % 60:02d}.{rng.randint(0, 3)}"
        out.append(
            (
                f"T{i:05d}",
                rng.choice([None, *[f"u{k}" for k in range(users)]]),
                time,
                rng.choice([None, float("nan"), 10.0, 25.5, 1e20]),
                rng.choice([None, "A", "B"]),
                rng.choice([None, "d0", "d1"]),
                rng.choice(["FAILED", "FAILED", "SUCCESS", None]),
            )
        )
    return out


def scores(df):
    cols = ["transaction_id", "velocity_amount_1m", "device_users_10m", "geo_anomaly", "failure_burst_check", "risk_score", "fraud_reason"]
    return sorted(map(str, df.select(*cols).collect()))


@pytest.mark.parametrize("seed,hot,bucket", [(1, 3, 40), (2, 1, 7), (3, 10, 1000), (4, 10**6, 60)])
def test_blocks_equal_slices(spark, seed, hot, bucket):
    cfg = RuleConfig(
        velocity_window_s=20, velocity_limit=60.0, geo_window_s=15, mule_window_s=30, mule_users=2, burst_failures=2,
        burst_window_s=30, bucket_seconds=bucket, hot_cell_rows=hot, split_min_input_bytes=0, split_hot_cells=False,
    )
    df = spark.createDataFrame(rows_of(seed, 250, 400), SCHEMA).repartition(3)
    assert scores(dense.score(df, cfg)) == scores(rules.score(df, cfg.with_(bucket_seconds=None)))


def test_one_dense_second(spark):
    rows = [(f"T{i:05d}", "u", "2024-01-01 00:00:00", 1.0, "AB"[i % 2], "d", "SUCCESS" if i % 7 == 0 else "FAILED") for i in range(600)]
    df = spark.createDataFrame(rows, SCHEMA)
    cfg = RuleConfig(hot_cell_rows=20, split_min_input_bytes=0, velocity_limit=100.0)
    assert scores(dense.score(df, cfg)) == scores(rules.score(df, RuleConfig(velocity_limit=100.0)))


def test_a_hot_user_is_many_blocks(spark):
    """One user, one hour: more blocks than slices could be cut, none much over its share."""
    cfg = RuleConfig(hot_cell_rows=500, split_min_input_bytes=0)
    df = spark.range(60_000).select(
        F.format_string("T%07d", "id").alias("transaction_id"), F.lit("u").alias("user_id"),
        F.timestamp_seconds(F.lit(1704067200) + F.col("id") % 3600).alias("timestamp"), F.lit(1.0).alias("amount"),
        F.lit("A").alias("location_city"), F.lit("d").alias("device_id"), F.lit("SUCCESS").alias("status"),
    )
    sizes = [r["count"] for r in dense._blocks(df.withColumn("_u", unix_seconds("timestamp")), cfg).groupBy("_blk").count().collect()]
    bucket, span = cfg.bucket_for(cfg.user_lookback_s, cfg.user_lookahead_s), cfg.user_lookback_s + cfg.user_lookahead_s
    assert sum(sizes) == 60_000 and len(sizes) > 4 * bucket // span and max(sizes) < 2 * cfg.hot_cell_rows


def test_scoring_takes_blocks_where_slices_end(spark, monkeypatch):
    taken = []
    features = dense.features
    monkeypatch.setattr(dense, "features", lambda df, cfg: taken.append(1) or features(df, cfg))
    df = spark.createDataFrame(rows_of(5, 300, 30), SCHEMA)
    cfg = RuleConfig(hot_cell_rows=2, split_min_input_bytes=0)
    assert scores(rules.score(df, cfg)) == scores(rules.score(df, RuleConfig())) and taken


def test_empty(spark):
    df = spark.createDataFrame([], SCHEMA)
    assert dense.score(df, RuleConfig(split_min_input_bytes=0)).count() == 0
