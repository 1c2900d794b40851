"""Streaming Bronze: multi-run availableNow with duplicates, late rows, NULL ids."""

from paysignal.schema import RAW, RAW_COLUMNS
from paysignal.streaming import bronze


def write_batch(spark, path, rows):
    spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], RAW).coalesce(1).write.option(
        "header", True
    ).csv(path)


def row(txn, ts, **kw):
    base = dict(transaction_id=txn, utr_number="U" + str(txn), user_id="u", timestamp=ts, amount="10", status="SUCCESS")
    base.update(kw)
    return base


def test_incremental_runs_dedup_late_and_null_ids(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt"
    write_batch(spark, f"{src}/b1", [
        row("A", "2025-08-01 10:00:00"), row("A", "2025-08-01 10:00:00"), row("B", "2025-08-01 11:00:00"),
        row(None, "2025-08-01 10:30:00", user_id="x"), row(None, "2025-08-01 10:31:00", user_id="y"),
        row("N", None),
    ])
    bronze.run_bronze(spark, f"{src}/*", out, ckpt)
    first = spark.read.parquet(out)
    assert first.count() == 5  # A once, B, two distinct NULL-id rows, NULL-time row
    assert {"_ingestion_timestamp", "_source_file"} <= set(first.columns)
    write_batch(spark, f"{src}/b2", [
        row("A", "2025-08-01 12:00:00"),  # repeat id: dropped (state kept)
        row("C", "2025-08-01 12:00:00"),  # new
        row("L", "2025-08-01 09:00:00"),  # late, but new: kept
        row("M", None),  # NULL time is never late
    ])
    bronze.run_bronze(spark, f"{src}/*", out, ckpt)
    ids = sorted(str(r.transaction_id) for r in spark.read.parquet(out).collect())
    assert ids == ["A", "B", "C", "L", "M", "N", "None", "None"]
    # third run with no new files writes nothing new
    bronze.run_bronze(spark, f"{src}/*", out, ckpt)
    assert spark.read.parquet(out).count() == 8


def test_within_watermark_mode_and_memory_store(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt"
    write_batch(spark, f"{src}/b1", [row("A", "2025-08-01 10:00:00"), row("A", "2025-08-01 10:00:00"), row("B", "2025-08-01 10:05:00")])
    summary = bronze.run_bronze(spark, f"{src}/*", out, ckpt, within_watermark=True, state_store="memory")
    assert summary["rows"] == 3
    assert sorted(r.transaction_id for r in spark.read.parquet(out).collect()) == ["A", "B"]


def test_size_shuffles_respects_explicit_setting(spark):
    from paysignal.session import size_shuffles

    before = spark.conf.get("spark.sql.shuffle.partitions")
    # the test session sets the value explicitly, so it is left alone
    assert size_shuffles(spark, 10 << 40) == int(before)
    assert spark.conf.get("spark.sql.shuffle.partitions") == before


def test_state_store_option_is_applied(spark, tmp_dir):
    import os

    src = f"{tmp_dir}/in"
    write_batch(spark, f"{src}/b1", [row("A", "2025-08-01 10:00:00")])
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    kinds = {}
    for store in ("memory", "rocksdb"):
        bronze.run_bronze(spark, f"{src}/*", f"{tmp_dir}/o-{store}", f"{tmp_dir}/c-{store}", state_store=store)
        found = [f for _, _, names in os.walk(f"{tmp_dir}/c-{store}/state".replace("file:", "", 1)) for f in names if f[0] not in "._"]
        kinds[store] = {f.rsplit(".", 1)[-1] for f in found}
    assert "delta" in kinds["memory"] and "delta" not in kinds["rocksdb"] and kinds["rocksdb"] & {"zip", "changelog"}
    assert spark.conf.get(name, None) == before


def test_late_rows_are_dropped_on_request_and_reported(spark, tmp_dir):
    src, out, ckpt = f"{tmp_dir}/in", f"{tmp_dir}/bronze", f"{tmp_dir}/ckpt"
    write_batch(spark, f"{src}/b1", [row("A", "2025-08-01 10:00:00"), row("B", "2025-08-01 11:00:00")])
    assert bronze.run_bronze(spark, f"{src}/*", out, ckpt, drop_late=True)["late_rows_dropped"] == 0
    write_batch(spark, f"{src}/b2", [row("L", "2025-08-01 09:00:00"), row("C", "2025-08-01 12:00:00"), row("M", None)])
    run = bronze.run_bronze(spark, f"{src}/*", out, ckpt, drop_late=True)
    assert run["late_rows_dropped"] == 1 and run["rows"] == 3
    assert sorted(r.transaction_id for r in spark.read.parquet(out).collect()) == ["A", "B", "C", "M"]


def test_all_batches_are_reported(spark, tmp_dir):
    """More micro-batches than Spark keeps reports of."""
    src = f"{tmp_dir}/in"
    rows = [row(f"T{i}", "2025-08-01 10:00:00") for i in range(105)]
    spark.createDataFrame([tuple(r.get(c) for c in RAW_COLUMNS) for r in rows], RAW).repartition(105).write.option(
        "header", True
    ).option("maxRecordsPerFile", 1).csv(src)
    before = spark.conf.get("spark.sql.streaming.numRecentProgressUpdates")
    spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", "20")
    try:
        run = bronze.run_bronze(spark, src, f"{tmp_dir}/o", f"{tmp_dir}/c", max_files_per_trigger=2, state_store="memory")
    finally:
        spark.conf.set("spark.sql.streaming.numRecentProgressUpdates", before)
    assert run["rows"] == 105 and run["batches"] >= 50


def test_files_under_another_header_fail(spark, tmp_dir):
    import pytest

    write_batch(spark, f"{tmp_dir}/in/b1", [row("A", "2025-08-01 10:00:00")])
    shuffled = [RAW_COLUMNS[1], RAW_COLUMNS[0], *RAW_COLUMNS[2:]]
    spark.createDataFrame([tuple(row("B", "2025-08-01 10:00:00").get(c) for c in RAW_COLUMNS)], RAW).select(*shuffled).write.option(
        "header", True
    ).csv(f"{tmp_dir}/in/b2")
    with pytest.raises(Exception):
        bronze.run_bronze(spark, f"{tmp_dir}/in/*", f"{tmp_dir}/o", f"{tmp_dir}/c")
