"""Dashboard bundle: source resolution with fixture fallback, stored Gold preference."""

from pyspark.sql import functions as F

from paysignal.config import RuleConfig
from paysignal.plans import bundle, jobs
from paysignal.sources.storage import TableStore


def test_fallback_bundle_on_fixture(spark, tmp_dir):
    b = bundle.bundle_from_root(spark, f"{tmp_dir}/nothing-here", as_of="2026-09-01 00:00:00", cfg=RuleConfig())
    assert b.source_label == bundle.FALLBACK_LABEL and not b.stored_gold_detected
    m = {r.metric: r.value for r in bundle.layer_counts(b).collect()}
    # lenient rules on the raw fixture: every repeated row fails utr_unique
    assert m["bronze_rows"] == 5000 and m["silver_rows"] == 4960 and m["quarantine_rows"] == 40
    assert m["gold_rows"] == 11 and m["duplicate_rows"] == 40
    assert m["valid_rate_pct"] == 99.2
    labels = {r.fraud_reason for r in b.gold.select("fraud_reason").distinct().collect()}
    assert "Geo anomaly" in labels and "No rule triggered" not in labels


def test_bundle_prefers_stored_gold(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    seed = bundle.bundle_from_root(spark, f"{tmp_dir}/none", as_of="2026-09-01 00:00:00")
    store.write(jobs.SCORED, seed.scored.drop("fraud_reasons").limit(100).withColumn("is_fraud", F.lit(True)))
    b = bundle.bundle_from_root(spark, f"{tmp_dir}/none", store=store, as_of="2026-09-01 00:00:00")
    assert b.stored_gold_detected and b.gold.count() == 100 and "stored Gold" in b.source_note


def test_bundle_prefers_precomputed_file_output(spark, tmp_dir):
    root = f"{tmp_dir}/site"
    seed = bundle.bundle_from_root(spark, f"{tmp_dir}/none", as_of="2026-09-01 00:00:00")
    seed.gold.select("transaction_id", "amount", "is_fraud").limit(7).write.parquet(f"{root}/gold/fraud_transactions.parquet")
    b = bundle.bundle_from_root(spark, root, as_of="2026-09-01 00:00:00")
    assert b.stored_gold_detected and b.gold.count() == 7
    # from CSV, where everything is text; an empty output before it is passed over
    site = f"{tmp_dir}/csv-site"
    seed.gold.limit(0).select("transaction_id", "is_fraud").write.option("header", True).csv(f"{site}/sample_data/fraud_transactions.csv")
    seed.gold.select("transaction_id", "amount", "risk_score", "is_fraud").limit(5).write.option("header", True).csv(
        f"{site}/gold/fraud_transactions.csv"
    )
    b = bundle.bundle_from_root(spark, site, as_of="2026-09-01 00:00:00")
    types = dict(b.gold.dtypes)
    assert b.gold.count() == 5 and (types["amount"], types["risk_score"], types["is_fraud"]) == ("double", "int", "boolean")


def test_empty_upload_is_rejected(spark):
    import pytest

    from paysignal.schema import RAW

    with pytest.raises(ValueError, match="empty"):
        bundle.build_bundle(spark.createDataFrame([], RAW), require_rows=True)
    assert bundle.build_bundle(spark.createDataFrame([], RAW)).scored.count() == 0


RAW_ROW = ("T{0}", "U{0}", "u{1}", "2026-08-01 10:0{1}:00", "99.5", "u{1}@bank", "m1@bank", "food", "Pune", "d{1}", "10.0.0.1", "SUCCESS", "")


def test_large_source_is_scored_from_silver_written_once(spark, tmp_dir, monkeypatch):
    from paysignal.schema import RAW_COLUMNS

    names = ("transaction_id", "utr_number", "user_id", "timestamp", "amount", "sender_vpa", "receiver_vpa", "merchant_category",
             "location_city", "device_id", "ip_address", "status", "failure_reason")
    rows = [tuple(x.format(i, i % 3) for x in RAW_ROW) for i in (*range(12), 3)]
    spark.createDataFrame(rows, ", ".join(f"{c} string" for c in names)).select(*RAW_COLUMNS).write.option("header", True).csv(
        f"{tmp_dir}/site/sample_data/upi_transactions.csv"
    )
    taken = lambda b: sorted(tuple(map(str, r)) for r in b.scored.collect())
    plain = taken(bundle.bundle_from_root(spark, f"{tmp_dir}/site", as_of="2026-09-01 00:00:00"))
    monkeypatch.setattr(bundle, "is_small", lambda *a: False)
    large = bundle.bundle_from_root(spark, f"{tmp_dir}/site", as_of="2026-09-01 00:00:00")
    assert len(plain) == 11 and taken(large) == plain  # both rows of a repeated UTR fail
    read = large.scored.inputFiles()
    assert read and all("paysignal-bundle-" in x for x in read)


def test_stored_gold_scores_nothing(spark, tmp_dir, monkeypatch):
    stored = spark.createDataFrame([("T1", True), ("T2", False)], "transaction_id string, is_fraud boolean")

    def score(*a, **kw):
        raise AssertionError("scored")

    monkeypatch.setattr(bundle.rules, "score", score)
    b = bundle.bundle_from_root(spark, f"{tmp_dir}/none", as_of="2026-09-01 00:00:00", precomputed=stored)
    assert [r.transaction_id for r in b.gold.collect()] == ["T1"]
