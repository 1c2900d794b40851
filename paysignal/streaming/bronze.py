"""Incremental Bronze ingestion with Structured Streaming.

File stream (all text, columns by their header names) ->
typed event time + audit columns -> streaming dedup on the
transaction id -> append-only parquet sink, exactly-once via checkpoint,
run with ``availableNow`` (process what is there, then stop; the next run
picks up only new files).

Dedup key: ``transaction_id``; rows with a NULL id are keyed by their whole
raw row, so distinct bad rows reach Silver quarantine instead of collapsing
into one NULL key.

State: ``dropDuplicates`` on the id keeps every id forever (the event time
is not part of the key, so the watermark never evicts) - exact, with state
growing with the number of distinct ids, so the RocksDB state store is the
default (off-heap, on local disk, checkpointed). ``within_watermark=True`` switches to
``dropDuplicatesWithinWatermark``, which evicts state but accepts a repeat
that arrives more than the watermark delay after the first copy.
Late rows: exact dedup needs no watermark, so by default none is set and late
rows reach Silver, whatever files share a micro-batch. ``drop_late=True`` sets
it: rows whose event time is older than the watermark of an earlier batch are
then dropped, rows with a NULL event time never, and the run reports how many
(``late_rows_dropped``); which rows that is depends on the batches.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from paysignal.schema import RAW, RAW_COLUMNS
from paysignal.sources.files import csv_reader, header_of

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
IN_MEMORY = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"


def read_source_stream(
    spark: SparkSession,
    root: str,
    pattern: str = "*.csv",
    max_files_per_trigger: int | None = None,
    fmt: str = "csv",
) -> DataFrame:
    """New files under ``root`` matching ``pattern`` as a stream."""
    reader = spark.readStream.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    if fmt == "landed":
        return reader.schema(T.StructType([*RAW.fields, T.StructField("_source_file", T.StringType())])).parquet(f"{root}/*")
    if fmt != "csv":
        return reader.schema(RAW).format(fmt).load(root)
    # columns by their header names: the first file's header, to which every file is held
    found = csv_reader(reader, header_of(spark, root, pathGlobFilter=pattern)).csv(root)
    kept = [(F.col(f"`{c}`") if c in found.columns else F.lit(None).cast("string")).alias(c) for c in RAW_COLUMNS]
    return found.select(*kept, F.col("_metadata.file_path").alias("_source_file"))


def own_headers(rows: DataFrame) -> DataFrame:
    """Lines ``value, _source_file, _block, _line`` of CSV files to RAW_COLUMNS and
    ``_source_file``, every file by its own header (its first line that is not blank):
    columns in any order, missing ones NULL, further ones left out.

    Lines are split by Spark's CSV parser into fields by place, and each name's place
    comes from the file's header, one row a file. Records on several lines are not supported."""
    lines = rows.filter(F.trim("value") != "")
    heads = lines.filter("_block = 0").groupBy("_source_file").agg(F.min(F.struct("_line", "value")).alias("_h"))
    heads = heads.select("_source_file", F.col("_h._line").alias("_head_line"), F.col("_h.value").alias("_head"))
    width = heads.agg(F.max(F.size(F.split("_head", ",")))).first()[0] or 1
    places = ", ".join(f"c{i} string" for i in range(width))

    def fields(text: str) -> Column:
        parsed = F.from_csv(F.col(text), places, {"mode": "PERMISSIVE"})
        return F.array(*[parsed[f"c{i}"] for i in range(width)])

    names = F.transform(fields("_head"), lambda x: F.lower(F.trim(F.regexp_replace(x, "^\ufeff", ""))))
    heads = heads.select("_source_file", "_head_line", names.alias("_names"))
    joined = lines.join(heads, "_source_file").filter("_line <> _head_line").select("_source_file", "_names", fields("value").alias("_f"))
    at = {c: F.array_position("_names", c).cast("int") for c in RAW_COLUMNS}
    return joined.select(*[F.when(at[c] > 0, F.get("_f", at[c] - 1)).alias(c) for c in RAW_COLUMNS], "_source_file")


def land_csv(
    spark: SparkSession, source_root: str, landing: str, checkpoint: str, pattern: str = "*.csv", max_files_per_trigger: int | None = None
) -> int:
    """New files under ``source_root`` to Parquet in ``landing``, every file by its own header.

    A micro-batch is written to a folder named by its number, over what an attempt
    before it left, so that each file lands once. Returns the number of batches."""
    reader = spark.readStream.option("pathGlobFilter", pattern)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", int(max_files_per_trigger))
    lines = reader.text(source_root).select(
        "value", F.col("_metadata.file_path").alias("_source_file"), F.col("_metadata.file_block_start").alias("_block")
    )
    done = []

    def land(rows: DataFrame, number: int) -> None:
        numbered = rows.withColumn("_line", F.monotonically_increasing_id())
        own_headers(numbered).write.mode("overwrite").parquet(f"{landing}/batch={number:08d}")
        done.append(number)

    query = lines.writeStream.foreachBatch(land).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return len(done)


def dedup_key() -> F.Column:
    """transaction_id, or for a NULL id the whole raw row (exact: identical
    bad copies collapse, distinct ones survive; same rule as batch dedup)."""
    whole = F.concat(F.lit("\u0000"), F.to_json(F.struct(*[F.col(c) for c in RAW_COLUMNS])))
    return F.coalesce(F.col("transaction_id"), whole)


def prepare_bronze(
    df: DataFrame, watermark: str = "10 minutes", within_watermark: bool = False, drop_late: bool = False, dedup: bool = True
) -> DataFrame:
    """P9 + M2/M3/M7: typed event time, audit columns, dedup, and a watermark
    where late rows are to go (``drop_late``) or state is to end
    (``within_watermark``). ``dedup=False`` leaves copies in and adds ``_dedup_key``."""
    out = (
        df.withColumn("_dedup_key", dedup_key())
        .withColumn("timestamp", F.try_to_timestamp(F.col("timestamp")))
        .withColumn("_ingestion_timestamp", F.current_timestamp())
    )
    if "_source_file" not in df.columns:
        out = out.withColumn("_source_file", F.col("_metadata.file_path"))
    if not dedup:
        return out
    if within_watermark:
        out = out.withWatermark("timestamp", watermark).dropDuplicatesWithinWatermark(["_dedup_key"])
    elif drop_late:
        out = out.withWatermark("timestamp", watermark).dropDuplicates(["_dedup_key"])
    else:
        out = out.dropDuplicates(["_dedup_key"])
    return out.drop("_dedup_key")


def write_bronze_stream(df: DataFrame, checkpoint: str, path: str, query_name: str | None = None) -> StreamingQuery:
    """Append to parquet, checkpointed, process available data then stop."""
    writer = df.writeStream.format("parquet").outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        writer = writer.queryName(query_name)
    return writer.trigger(availableNow=True).start(path)


def run_bronze(
    spark: SparkSession,
    source_root: str,
    bronze_path: str,
    checkpoint: str,
    pattern: str = "*.csv",
    watermark: str = "10 minutes",
    within_watermark: bool = False,
    max_files_per_trigger: int | None = None,
    state_store: str = "rocksdb",
    drop_late: bool = False,
    by_own_header: bool = False,
) -> dict:
    """One incremental run; returns batches and rows of this run, and the
    rows that the watermark dropped as late.

    ``by_own_header`` reads every file by its own header (``land_csv``, into a folder
    beside the checkpoint), so that the header may change between files; otherwise
    a file whose header differs from the first one's ends the run with an error.

    ``state_store="rocksdb"`` (default) keeps the dedup state on local disk
    with checkpointed changelogs instead of executor heap; the provider is
    fixed when a checkpoint is created. ``"memory"`` keeps Spark's default."""
    provider = {"rocksdb": ROCKSDB, "memory": IN_MEMORY}[state_store]
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, provider)
    try:
        if by_own_header:
            landing = f"{checkpoint.rstrip('/')}-landing"
            land_csv(spark, source_root, landing, f"{checkpoint.rstrip('/')}-landed", pattern, max_files_per_trigger)
            stream = read_source_stream(spark, landing, "*.parquet", max_files_per_trigger, "landed")
        else:
            stream = read_source_stream(spark, source_root, pattern, max_files_per_trigger)
        rows = prepare_bronze(stream, watermark, within_watermark, drop_late)
        query = write_bronze_stream(rows, checkpoint, bronze_path)
    finally:
        spark.conf.set(name, before) if before is not None else spark.conf.unset(name)
    # Spark keeps the latest hundred reports only: gather them while the query runs
    reports: dict[int, dict] = {}
    ended = False
    while not ended:
        ended = query.awaitTermination(1)
        reports.update({p["batchId"]: p for p in query.recentProgress})
    if query.exception() is not None:
        raise query.exception()
    done = [reports[k] for k in sorted(reports)]
    return {
        "batches": len(done),
        "last_batch_id": done[-1]["batchId"] if done else None,
        "rows": sum(p["numInputRows"] for p in done),
        "late_rows_dropped": sum(o["numRowsDroppedByWatermark"] for p in done for o in p["stateOperators"]),
    }
