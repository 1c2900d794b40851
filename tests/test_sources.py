"""Readers, envelopes, exports, storage, generators and catalog registration."""

import json
import os

import pytest
from pyspark.sql import functions as F

from paysignal.operators import generator, standardize
from paysignal.schema import RAW, RAW_COLUMNS, REQUIRED_COLUMNS
from paysignal.sources import files, storage, tables
from paysignal.functions.columns import inr_text

from sf_paths import SF_SMALL


def local(path):
    return path.replace("file:", "", 1) if path.startswith("file:") else path


def rows8(spark):
    return tables.raw_transactions(spark, SF_SMALL).orderBy("transaction_id").limit(8)


def test_multi_format_round_trip(spark, tmp_dir):
    df = rows8(spark).cache()
    df.coalesce(1).write.option("header", True).csv(f"{tmp_dir}/t.csv")
    df.write.parquet(f"{tmp_dir}/t.parquet")
    df.write.json(f"{tmp_dir}/t.jsonl")
    for path in ("t.csv", "t.parquet", "t.jsonl"):
        got = files.read_table(spark, f"{tmp_dir}/{path}", schema=RAW)
        assert got.count() == 8
        assert standardize.missing_required_columns(got) == []
    df.unpersist()


def test_unsupported_type_names_formats(spark, tmp_dir):
    with pytest.raises(ValueError, match="CSV, JSON, and Parquet"):
        files.read_table(spark, f"{tmp_dir}/x.txt")


def test_missing_column_report(spark):
    df = rows8(spark).drop("amount")
    assert standardize.missing_required_columns(df) == ["amount"]


@pytest.mark.parametrize("schema", [RAW, None])
@pytest.mark.parametrize("shape", ["array", "data", "transactions", "columns", "nested columns", "record"])
def test_json_envelopes(spark, tmp_dir, shape, schema):
    recs = [{"transaction_id": f"T{i}", "amount": str(i)} for i in range(3)]
    doc = {
        "array": recs,
        "data": {"data": recs},
        "transactions": {"transactions": recs},
        "columns": {"transaction_id": [r["transaction_id"] for r in recs], "amount": [r["amount"] for r in recs]},
        "nested columns": {"data": {"transaction_id": [r["transaction_id"] for r in recs], "amount": [0, 1, 2]}},
        "record": recs[2],
    }[shape]
    path = local(f"{tmp_dir}/{shape}.json")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump(doc, fh, indent=2)
    got = {r.transaction_id: r.amount for r in files.read_table(spark, path, schema=schema).collect()}
    assert got == ({"T2": "2"} if shape == "record" else {"T0": "0", "T1": "1", "T2": "2"})


def test_json_documents_of_several_shapes_in_one_folder(spark, tmp_dir):
    base = local(f"{tmp_dir}/docs")
    os.makedirs(base)
    for i, doc in enumerate([[{"transaction_id": "A"}], {"data": [{"transaction_id": "B"}]}, {"transaction_id": ["C", "D"]}]):
        with open(f"{base}/{i}.json", "w") as fh:
            json.dump(doc, fh)
    for schema in (RAW, None):
        got = files.read_table(spark, f"{tmp_dir}/docs", fmt="json", schema=schema)
        assert sorted(r.transaction_id for r in got.collect()) == ["A", "B", "C", "D"]


def test_csv_columns_are_found_by_name(spark, tmp_dir):
    from pyspark.sql import types as T

    with open(local(f"{tmp_dir}.csv"), "w") as fh:
        fh.write("utr_number,extra,transaction_id,amount\nU1,x,00123,1.5\nU2,y,T2,oops\n")
    got = {r.transaction_id: r for r in files.read_csv(spark, f"{tmp_dir}.csv", RAW).collect()}
    assert got["00123"].utr_number == "U1" and got["T2"].user_id is None and "extra" not in got["T2"].asDict()
    typed = T.StructType([T.StructField("amount", T.DoubleType()), T.StructField("transaction_id", T.StringType())])
    assert [tuple(r) for r in files.read_csv(spark, f"{tmp_dir}.csv", typed).collect()] == [(1.5, "00123"), (None, "T2")]
    assert files.read_csv(spark, f"{tmp_dir}.csv", None).columns == ["utr_number", "extra", "transaction_id", "amount"]


def test_csv_export_header_and_lines(spark, tmp_dir):
    df = rows8(spark)
    storage.csv_export(df.coalesce(1), f"{tmp_dir}/out", ["transaction_id", "amount"])
    parts = [p for p in os.listdir(local(f"{tmp_dir}/out")) if p.endswith(".csv")]
    lines = open(os.path.join(local(f"{tmp_dir}/out"), parts[0])).read().splitlines()
    assert lines[0] == "transaction_id,amount" and len(lines) == 9


def test_partitioned_clustered_and_catalog(spark, tmp_dir):
    store = storage.TableStore(spark, tmp_dir)
    t = tables.transactions(spark, SF_SMALL).withColumn("transaction_date", F.to_date("timestamp"))
    store.write("tx", t, partition_by=["transaction_date"], cluster_by=["user_id"])
    assert store.read("tx").count() == t.count()
    name = store.register("tx", "test_gold")
    assert spark.sql(f"SELECT COUNT(*) AS n FROM {name}").first().n == t.count()
    one_day = t.select("transaction_date").first().transaction_date
    part = t.filter(F.col("transaction_date") == one_day)
    rest, day = t.count() - part.count(), str(one_day)
    store.replace_partitions("tx", part.limit(1), "transaction_date", lambda x: x == day)
    assert store.read("tx").filter(F.col("transaction_date") == one_day).count() == 1 and store.read("tx").count() == rest + 1
    # a day without rows any more goes; the version before stays as it was
    store.replace_partitions("tx", part.limit(0), "transaction_date", lambda x: x == day)
    assert store.read("tx").count() == rest and store.read("tx", 2).count() == rest + 1 and store.current_version("tx") == 3
    assert store.read("tx").schema.fieldNames() == store.read("tx", 1).schema.fieldNames()
    name = store.register("tx", "test_gold")
    assert spark.sql(f"SELECT COUNT(*) AS n FROM {name}").first().n == rest


def test_resolve_source(spark, tmp_dir):
    path, label = files.resolve_source(spark, [(f"{tmp_dir}/missing.csv", "primary"), (SF_SMALL, "fallback")])
    assert path == SF_SMALL and label == "fallback"
    assert files.resolve_source(spark, [(f"{tmp_dir}/nope", "x")])[0] is None


def test_generator_ids_unique_and_deterministic(spark):
    ev, cu = tables.table(spark, SF_SMALL, "events"), tables.table(spark, SF_SMALL, "customer")
    tx = generator.transactions(ev, cu, seed=42)
    n = tx.count()
    assert n == ev.count() + 8 * (6 + 2 + 6 + 3)
    assert tx.select("transaction_id").distinct().count() == n
    again = generator.transactions(ev, cu, seed=42)
    assert tx.exceptAll(again).count() == 0
    assert tx.columns == list(RAW_COLUMNS)
    cust = generator.customer_rows(cu)
    kyc = {r.kyc_status for r in cust.select("kyc_status").distinct().collect()}
    assert kyc <= {"FULL_KYC", "MIN_KYC", "PENDING"} and cust.count() == cu.count()


def test_generator_clusters_fire_rules(spark):
    from paysignal.operators import rules
    from paysignal.plans import silver as silver_plan

    ev, cu = tables.table(spark, SF_SMALL, "events"), tables.table(spark, SF_SMALL, "customer")
    raw = generator.transactions(ev, cu, seed=7)
    scored = rules.score(silver_plan.build(raw, as_of="2024-02-02 00:00:00").silver)
    fired = scored.agg(*[F.count_if(c).alias(c) for c in ("velocity_check", "geo_anomaly", "device_mule_check", "failure_burst_check")]).first()
    assert all(v > 0 for v in fired)


def test_write_dataset_counts(spark, tmp_dir):
    n = generator.write_dataset(rows8(spark), f"{tmp_dir}/gen")
    assert n == 8


def test_inr_text(spark):
    df = spark.createDataFrame([(1234567.5,), (-5.0,), (999.0,), (100000.0,)], ["a"])
    got = [r.t for r in df.select(inr_text("a").alias("t")).collect()]
    assert got == ["INR 12,34,567.50", "-INR 5.00", "INR 999.00", "INR 1,00,000.00"]


def test_required_columns_fixed():
    assert len(REQUIRED_COLUMNS) == 8


def test_many_envelope_documents(spark, monkeypatch):
    from paysignal.plans import io_queries

    monkeypatch.setattr(io_queries, "ENVELOPE_ROWS", 100)
    n = tables.raw_transactions(spark, SF_SMALL).count()
    assert io_queries.json_envelope(spark, SF_SMALL).count() == n


def test_generator_exact_total_rows(spark):
    ev, cu = tables.table(spark, SF_SMALL, "events"), tables.table(spark, SF_SMALL, "customer")
    assert generator.transactions(ev, cu, total_rows=500).count() == 500
    assert generator.transactions(ev, cu, total_rows=100).count() == 100  # clusters truncated
    a = sorted(r.transaction_id for r in generator.transactions(ev, cu, total_rows=300).collect())
    b = sorted(r.transaction_id for r in generator.transactions(ev, cu, total_rows=300).collect())
    assert a == b


def test_optional_output_probe_order(spark, tmp_dir):
    root = f"{tmp_dir}/site"
    assert files.find_optional_output(spark, root, "fraud_transactions") is None
    spark.createDataFrame([("g",)], "src string").write.parquet(f"{root}/gold/fraud_transactions.parquet")
    assert files.find_optional_output(spark, root, "fraud_transactions").first().src == "g"
    spark.createDataFrame([("d",)], "src string").write.parquet(f"{root}/delta/gold/fraud_transactions.parquet")
    assert files.find_optional_output(spark, root, "fraud_transactions").first().src == "d"
    spark.createDataFrame([("s",)], "src string").write.option("header", True).csv(f"{root}/sample_data/fraud_transactions.csv")
    assert files.find_optional_output(spark, root, "fraud_transactions").first().src == "s"


def test_column_document_parsed_once(spark, tmp_dir):
    path = local(f"{tmp_dir}/columns.json")
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as fh:
        json.dump({"transaction_id": [f"T{i}" for i in range(600)], "amount": ["1.5"] * 599, "status": None}, fh)
    got = files.read_json_envelope(spark, path, RAW)
    # one parse a kind (columns, array of records, record), however many fields and rows there are
    assert got._jdf.queryExecution().optimizedPlan().toString().count("from_json(") <= 3
    rows = {r.transaction_id: (r.amount, r.status) for r in got.collect()}
    assert len(rows) == 600
    assert rows["T0"] == ("1.5", None) and rows["T599"] == (None, None)
