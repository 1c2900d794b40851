"""Physical-plan shape of the large-input paths (forced on small data)."""

from paysignal.config import STRICT
from paysignal.operators import dedup, quality
from paysignal.sources import tables

from sf_paths import SF_SMALL


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_utr_check_broadcasts_repeated_keys(spark):
    d = tables.dirty_raw_transactions(spark, SF_SMALL)
    p = plan(quality.add_quality_rules(d, STRICT, tables.DIRTY_AS_OF, small_input_bytes=0))
    assert "BroadcastHashJoin" in p and "LeftOuter" in p
    assert "SortMergeJoin" not in p


def test_keep_first_passes_unique_rows_through(spark):
    p = plan(dedup.keep_first(tables.transactions(spark, SF_SMALL), small_input_bytes=0))
    assert "LeftAnti" in p and "LeftSemi" in p and "BroadcastHashJoin" in p
