"""Opt-in deep property check (PAYSIGNAL_DEEP=1): 200 random cases across
slice widths, with and without hot-cell splitting, against the brute force."""

import os

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from paysignal.config import RuleConfig
from paysignal.operators import rules
from paysignal.schema import TYPED
from test_rules import brute, row_strategy, rows_nullable

pytestmark = pytest.mark.skipif(os.environ.get("PAYSIGNAL_DEEP") != "1", reason="set PAYSIGNAL_DEEP=1")


@settings(max_examples=200, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(row_strategy, min_size=1, max_size=40),
    st.sampled_from([5, 7, 13, 40, 47, 64]),
    st.booleans(),
    st.sampled_from([1, 2, 3]),
    st.sampled_from([2, 3, 5]),
)
def test_deep_windows_match_brute_force(spark, raw, bucket, split, hot_rows, max_split):
    cfg = RuleConfig(velocity_window_s=20, velocity_limit=50.0, geo_window_s=9, mule_window_s=15, mule_users=2,
                     burst_failures=2, burst_window_s=30, bucket_seconds=bucket, split_hot_cells=split,
                     hot_cell_rows=hot_rows, max_split=max_split, split_min_input_bytes=0)
    spec = [(f"t{i:03d}", u, d, s, a, c, st_) for i, (u, d, s, a, c, st_) in enumerate(raw)]
    df = spark.createDataFrame(rows_nullable(spec), TYPED)
    got = {
        r.transaction_id: (r.velocity_check, r.geo_anomaly, r.device_mule_check, r.failure_burst_check, r.device_users_10m)
        for r in rules.score(df, cfg).collect()
    }
    assert got == brute(spec, cfg)
