"""End-to-end jobs on the deterministic fixture and the customer adapter."""

from pyspark.sql import functions as F

from paysignal.config import RuleConfig
from paysignal.operators import generator
from paysignal.plans import incremental, jobs
from paysignal.sources import tables
from paysignal.sources.storage import TableStore

from sf_paths import SF_SMALL


def test_bronze_to_gold_on_fixture(spark, tmp_dir):
    src = f"{tmp_dir}/landing"
    raw = generator.fixture(spark).select(*[F.col(c).cast("string").alias(c) for c in generator.fixture(spark).columns])
    raw.write.option("header", True).csv(src)
    store = TableStore(spark, f"{tmp_dir}/lake")
    b = jobs.bronze_job(spark, store.root, src)
    assert spark.read.parquet(f"{store.root}/{jobs.BRONZE}").count() == 4980
    s = jobs.silver_job(spark, store, as_of="2026-09-01 00:00:00")
    assert s == {"total_rows": 4980, "valid_rows": 4980, "invalid_rows": 0}, (b, s)
    assert jobs.quarantine(store).count() == 0
    silver = jobs.read_silver(store)
    assert silver.count() == 4980 and silver.filter("_source_file IS NULL OR _ingestion_timestamp IS NULL").isEmpty()
    assert not {"utr_unique", "_dq_failures"} & set(silver.columns)
    assert spark.sql(f"SELECT COUNT(*) FROM silver.{jobs.SILVER}").first()[0] == 4980
    assert spark.sql(f"SELECT COUNT(*) FROM silver.{jobs.QUARANTINE}").first()[0] == 0
    # a date range reads Silver's own partitions only
    plan = incremental.rescore_range(silver, "2026-08-30", "2026-08-30", RuleConfig())._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [" in plan and "transaction_date" in plan.split("PartitionFilters: [", 1)[1].split("]", 1)[0]
    jobs.score_job(store)
    out = jobs.gold_job(spark, store, computed_at=F.lit("2026-09-01 00:00:00").cast("timestamp"), database="gold_test")
    assert spark.sql(f"SELECT COUNT(*) FROM {out[jobs.FRAUD]}").first()[0] == 11
    assert spark.sql(f"SELECT user_id FROM {out[jobs.MULES]}").first()[0] == "USR_MULE_C"
    kpi = spark.sql(f"SELECT SUM(fraud_transaction_count) FROM {out[jobs.MERCHANT_KPI]}").first()[0]
    assert kpi == 11
    # incremental rescoring of one day equals the full scores for that day
    before = store.read(jobs.SCORED).filter("transaction_date = '2026-08-30'").select("transaction_id", "risk_score")
    before = {tuple(r) for r in before.collect()}
    scored_schema = store.read(jobs.SCORED).schema
    jobs.rescore_job(store, "2026-08-30", "2026-08-30", RuleConfig())
    after = {tuple(r) for r in store.read(jobs.SCORED).filter("transaction_date = '2026-08-30'").select("transaction_id", "risk_score").collect()}
    assert after == before and len(after) > 0
    assert store.read(jobs.SCORED).schema == scored_schema


def test_silver_job_dashboard_order_quarantines_repeats(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    raw = generator.fixture(spark)
    s = jobs.silver_job(spark, store, bronze=raw, as_of="2026-09-01 00:00:00", dedup_first=False)
    assert s["invalid_rows"] == 40 and store.read(jobs.SILVER).count() == 4960


def test_scd2_job_versions(spark, tmp_dir):
    store = TableStore(spark, tmp_dir)
    first = jobs.scd2_job(spark, store, tables.customer_snapshot0(spark, SF_SMALL), "2024-01-01", database="dim_test")
    second = jobs.scd2_job(spark, store, tables.customer_snapshot1(spark, SF_SMALL), "2024-02-01", database="dim_test")
    third = jobs.scd2_job(spark, store, tables.customer_snapshot1(spark, SF_SMALL), "2024-03-01", database="dim_test")
    assert (first["action"], second["action"], third["action"]) == ("initialized", "applied", "no-op")
    assert (first["version"], second["version"], third["version"]) == (1, 2, 2)
    assert second["active_customer_count"] == third["active_customer_count"]


def test_incremental_filter_reaches_the_scan(spark, tmp_dir):
    from paysignal.plans import incremental

    path = f"{tmp_dir}/silver"
    tables.transactions(spark, SF_SMALL).withColumn("transaction_date", F.to_date("timestamp")).write.partitionBy(
        "transaction_date"
    ).parquet(path)
    silver = spark.read.parquet(path)
    out = incremental.rescore_range(silver, "2024-01-10", "2024-01-12", RuleConfig())
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(timestamp), GreaterThanOrEqual(timestamp" in plan
    assert "PartitionFilters: [isnotnull(transaction_date" in plan


def test_cli_runs_all_jobs(spark, tmp_dir, capsys):
    import json

    src = f"{tmp_dir}/landing"
    raw = generator.fixture(spark)
    raw.select(*[F.col(c).cast("string").alias(c) for c in raw.columns]).write.option("header", True).csv(src)
    jobs.main(["all", "--root", f"{tmp_dir}/lake", "--source", src, "--as-of", "2026-09-01 00:00:00",
               "--rules", '{"velocity_limit": 50000, "mule_users": 3}'])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    assert out["silver"]["valid_rows"] == 4980 and out["score"]["scored_version"] == 1
    assert set(out["gold"]) == {jobs.FRAUD, jobs.MULES, jobs.MERCHANT_KPI}
    snap = f"{tmp_dir}/customers.csv"
    tables.customer_snapshot0(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(snap)
    jobs.main(["scd2", "--root", f"{tmp_dir}/lake", "--source", snap, "--as-of", "2024-01-01"])
    out = json.loads(capsys.readouterr().out.strip().splitlines()[-1])
    n = tables.table(spark, SF_SMALL, "customer").count()
    assert out["scd2"]["action"] == "initialized" and out["scd2"]["active_customer_count"] == n


def test_jobs_of_the_stores(spark, tmp_dir, monkeypatch, capsys):
    """bronze, live and dimension from the command line, on one root, twice."""
    import json

    monkeypatch.setattr("paysignal.session.get_spark", lambda *a, **k: spark)
    root, src = f"{tmp_dir}/lake", f"{tmp_dir}/landing"
    tables.raw_transactions(spark, SF_SMALL).limit(60).coalesce(1).write.option("header", True).csv(src)
    tables.customer_snapshot0(spark, SF_SMALL).coalesce(1).write.option("header", True).csv(f"{tmp_dir}/customers.csv")
    for _ in range(2):
        jobs.main(["bronze", "--root", root, "--source", src, "--by-own-header", "--state-store", "memory"])
        jobs.main(["live", "--root", root, "--as-of", "2024-06-01"])
        jobs.main(["dimension", "--root", root, "--source", f"{tmp_dir}/customers.csv", "--as-of", "2024-01-01"])
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert said[1]["live"][0]["applied"] and said[4]["live"] == [] and said[5]["dimension"]["action"] == "no-op"
    from paysignal.plans import live

    assert live.scores(TableStore(spark, root)).count() > 0
