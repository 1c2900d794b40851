"""File readers: batch CSV with a declared schema, multi-format upload
reader, JSON envelopes, and source resolution (S3, S5, S6, S7)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paysignal.schema import RAW
from paysignal.sources.storage import path_exists, written_bytes

SUPPORTED = "Supported file types are CSV, JSON, and Parquet."
ENVELOPE_KEYS = ("data", "transactions")


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = RAW) -> DataFrame:
    """S3: header CSV, columns taken by their header names as text (no
    inference pass), then those of ``schema`` in its order and types: missing
    ones are NULL, values of another type NULL, further ones are left out, and
    bad rows keep NULL fields (PERMISSIVE) so the quality rules can quarantine
    them. Without ``schema`` all columns stay text (``standardize`` types them).

    The files of a folder share one header; a file whose header differs fails
    (``enforceSchema=false``) instead of being read under wrong names."""
    return _conform(csv_reader(spark.read, header_of(spark, path)).csv(path), schema)


def header_of(spark: SparkSession, path: str, **options) -> T.StructType:
    """The header's columns, in its order, as text (reads one line)."""
    found = spark.read.options(header=True, **options).csv(path).columns
    return T.StructType([T.StructField(c, T.StringType()) for c in found])


def csv_reader(reader, header: T.StructType):
    """A batch or stream reader that holds every file to ``header``."""
    return reader.schema(header).options(header=True, mode="PERMISSIVE", enforceSchema=False)


def suffix(path: str) -> str:
    name = path.rstrip("/").rsplit("/", 1)[-1].lower()
    return name.rsplit(".", 1)[-1] if "." in name else ""


def read_table(spark: SparkSession, path: str, fmt: str | None = None, schema: T.StructType | None = None) -> DataFrame:
    """Pick the reader by suffix (or ``fmt``): csv, parquet / pq, json
    (envelope aware), jsonl / ndjson (one record per line, splittable).
    Anything else raises ``ValueError`` naming the supported formats."""
    kind = (fmt or suffix(path)).lower()
    if kind == "csv":
        return read_csv(spark, path, schema)
    if kind in ("parquet", "pq"):
        return spark.read.parquet(path)
    if kind == "json":
        sizes = spark.read.format("binaryFile").load(path).agg(F.max("length")).first()[0] if schema is not None else 0
        return read_json_array(spark, path, schema) if (sizes or 0) > LARGE_DOCUMENT else read_json_envelope(spark, path, schema)
    if kind in ("jsonl", "ndjson"):
        reader = spark.read.schema(schema) if schema is not None else spark.read
        return reader.json(path)
    raise ValueError(SUPPORTED)


def read_json_envelope(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """Each file is one JSON document, and its own shape decides how it is
    read: an array of records; an object whose ``data`` (else
    ``transactions``) member holds an array of records or an object of column
    arrays; an object of column arrays; or one record. A folder may mix them.

    Documents are read as text and parsed with explicit schemas (no inference
    pass when ``schema`` is given): whichever parse yields values for a
    document is its shape. A document is parsed by one task; many documents are read
    in parallel, and large ones by ``read_json_array``."""
    value = F.col("value")
    member = F.coalesce(*[F.get_json_object(value, f"$.{k}") for k in ENVELOPE_KEYS])
    docs = spark.read.text(path, wholetext=True)
    docs = docs.select(F.when(_starts(value, "["), value).otherwise(F.coalesce(member, value)).alias("value"))
    schema = _field_names(docs) if schema is None else schema
    names = [f"`{f.name}`" for f in schema.fields]
    # Values of any type as text first, so one odd value never loses its record.
    record = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    columns = T.StructType([T.StructField(f.name, T.ArrayType(T.StringType())) for f in schema.fields])

    def parsed(text: Column, kind: T.DataType) -> Column:
        return F.from_json(text, kind, {"mode": "PERMISSIVE"})

    # parsed once a document, and as a column of its own: every array is taken from it
    docs = docs.withColumn("columns", F.when(~_starts(value, "["), parsed(value, columns)))
    held = [F.coalesce(F.col("columns")[f.name], F.array().cast("array<string>")) for f in schema.fields]
    zipped = F.arrays_zip(*held).cast(T.ArrayType(record))
    records = F.when(_starts(value, "["), parsed(value, T.ArrayType(record))).otherwise(
        F.when(F.size(zipped) > 0, zipped).otherwise(F.array(parsed(value, record)))
    )
    rows = docs.select(F.explode(records).alias("_r")).select(*[F.col(f"_r.{n}") for n in names])
    return _conform(rows, schema)


# Documents of more bytes than this are read by ``read_json_array``.
LARGE_DOCUMENT = 256 << 20
# Bytes that a task of ``read_json_array`` reads, in one range or many.
TASK_BYTES = 32 << 20


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """S7 for documents of any size: every file under ``path`` is one array of records, or
    an object whose first member, ``data`` or ``transactions``, is one.

    The text is cut at each ``}``, so a file is split into byte ranges like any other. A piece
    alone does not tell whether it starts inside a string, nor how deep: so each piece is
    counted both ways, running sums are made inside each range, and the ranges' totals, one
    row each, give what every range starts with. A record ends where the depth is
    that of the array; its pieces are joined and parsed on their own. Records may hold
    nested values and any character; a file of another shape raises.

    A task reads many ranges, about ``TASK_BYTES`` together, so that short ranges do
    not each send a task's result to the driver."""
    tasks = max(spark.sparkContext.defaultParallelism, -(-written_bytes(spark, path) // TASK_BYTES))
    rows = spark.read.option("lineSep", "}").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"),
    ).coalesce(tasks).withColumn("at", F.monotonically_increasing_id())
    bare = F.regexp_replace("value", r"(?s)\\.", "")  # escapes never cross a piece: none ends in }
    count = lambda text, mark: F.length(text) - F.length(F.replace(text, F.lit(mark), F.lit("")))

    def depth(text: Column) -> Column:
        plain = F.regexp_replace(text, '(?s)"[^"]*("|$)', "")
        return count(plain, "{") + count(plain, "[") - count(plain, "]")

    pieces = rows.withColumns(
        {
            "quotes": count(bare, '"'),
            "out": depth(bare) - F.when(count(bare, '"') % 2 == 0, 1).otherwise(0),
            "in": depth(F.concat(F.lit('"'), bare)) - F.when(count(bare, '"') % 2 == 1, 1).otherwise(0),
        }
    ).repartition("file", "block")
    before = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    upto = Window.partitionBy("file", "block").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    ranges_before = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    so_far = lambda c, w: F.coalesce(F.sum(c).over(w), F.lit(0))

    # inside a range, for a range that starts outside (0) or inside (1) a string
    local = pieces.withColumn("odd", so_far("quotes", before) % 2)
    local = local.withColumns({"step0": F.when(F.col("odd") == 0, F.col("out")).otherwise(F.col("in")),
                               "step1": F.when(F.col("odd") == 1, F.col("out")).otherwise(F.col("in"))})
    in_order = Window.partitionBy("file", "block").orderBy("at")
    local = local.withColumns({"depth0": F.sum("step0").over(upto), "depth1": F.sum("step1").over(upto),
                               "head": (F.col("block") == 0) & (F.row_number().over(in_order) == 1)})
    totals = local.groupBy("file", "block").agg(*[F.sum(c).alias(c) for c in ("quotes", "step0", "step1")])
    starts = totals.withColumn("start", so_far("quotes", ranges_before) % 2)
    starts = starts.withColumn("step", F.when(F.col("start") == 0, F.col("step0")).otherwise(F.col("step1")))
    starts = starts.select("file", "block", "start", so_far("step", ranges_before).alias("above"))
    known = local.join(starts, ["file", "block"]).select(
        "file", "block", "at", "value", "head",
        (F.col("above") + F.when(F.col("start") == 0, F.col("depth0")).otherwise(F.col("depth1"))).alias("depth"),
        ((F.col("start") + F.col("odd") + F.col("quotes")) % 2 == 0).alias("outside"),
    )

    # the shape, from the first piece of each file; a file of one piece holds no record
    first = local.filter("block = 0 AND head").select("file", F.col("value").alias("opens"))
    opening = r"^[\s\uFEFF]*(\{\s*\"(data|transactions)\"\s*:\s*)?\["
    base = F.when(~F.col("opens").rlike(opening), F.raise_error(F.concat(F.lit("not an array of records: "), "file"))).otherwise(
        F.when(F.col("opens").rlike(r"^[\s\uFEFF]*\["), 1).otherwise(2)
    )
    known = known.join(first.select("file", base.cast("int").alias("base")), "file")
    known = known.withColumn("ends", F.when(F.col("outside") & (F.col("depth") == F.col("base")), 1).otherwise(0)).repartition("file", "block")
    ended = known.groupBy("file", "block").agg(F.sum("ends").alias("n"))
    ended = ended.select("file", "block", so_far("n", ranges_before).alias("done"))
    numbered = known.withColumn("here", so_far("ends", before)).join(ended, ["file", "block"])
    text = F.when(F.col("head"), F.regexp_replace("value", opening, "")).otherwise(F.col("value"))
    records = numbered.groupBy("file", (F.col("done") + F.col("here")).alias("record")).agg(
        F.sort_array(F.collect_list(F.struct("block", "at", text.alias("text")))).alias("parts"), F.max("ends").alias("whole")
    )
    joined = F.concat(F.regexp_replace(F.array_join(F.col("parts.text"), "}"), r"^[\s,]+", ""), F.lit("}"))
    strings = T.StructType([T.StructField(f.name, T.StringType()) for f in schema.fields])
    parsed = records.filter("whole = 1").select(F.from_json(joined, strings, {"mode": "PERMISSIVE"}).alias("_r"))
    return _conform(parsed.select("_r.*"), schema)


def _starts(text: Column, mark: str) -> Column:
    return F.substring(F.ltrim(F.regexp_replace(text, r"^\s+", "")), 1, 1) == F.lit(mark)


def _field_names(body: DataFrame) -> T.StructType:
    """The member names of all records, as text columns (one pass over the documents)."""
    value = F.col("value")
    maps = F.when(_starts(value, "["), F.from_json(value, "array<map<string,string>>")).otherwise(
        F.array(F.from_json(value, "map<string,string>"))
    )
    names = body.select(F.explode(maps).alias("m")).select(F.explode(F.map_keys("m")).alias("k")).distinct().orderBy("k")
    return T.StructType([T.StructField(r.k, T.StringType()) for r in names.collect()])


def _conform(df: DataFrame, schema: T.StructType | None) -> DataFrame:
    if schema is None:
        return df
    cols = set(df.columns)
    return df.select(
        *[
            (F.col(f"`{f.name}`").try_cast(f.dataType) if f.name in cols else F.lit(None).cast(f.dataType)).alias(f.name)
            for f in schema.fields
        ]
    )


def resolve_source(spark: SparkSession, candidates: Sequence[tuple[str, str]]) -> tuple[str | None, str]:
    """The first (path, label) of an ordered list that exists, can be read
    and has rows; (None, note) when none does, so the caller can fall back."""
    for path, label in candidates:
        if path_exists(spark, path) and _has_rows(spark, path):
            return path, label
    return None, "None of the sources exists."


# Where a precomputed output may sit under a root, in probe order.
OUTPUT_DIRS = ("sample_data", "delta/gold", "gold")
OUTPUT_FORMATS = ("csv", "parquet")


def find_optional_output(spark: SparkSession, root: str, stem: str) -> DataFrame | None:
    """The first ``<dir>/<stem>.<csv|parquet>`` under ``root`` (dirs in
    OUTPUT_DIRS order) that exists and has rows, read with its reader; None if
    there is none."""
    for d in OUTPUT_DIRS:
        for fmt in OUTPUT_FORMATS:
            path = f"{root.rstrip('/')}/{d}/{stem}.{fmt}"
            if path_exists(spark, path):
                found = read_table(spark, path, fmt=fmt, schema=None)
                if not found.isEmpty():
                    return found
    return None


def _has_rows(spark: SparkSession, path: str) -> bool:
    """Whether a CSV (or a folder of some kind) can be read and is not empty; only its start is read."""
    try:
        if suffix(path) in ("csv", "json", "jsonl", "ndjson", "parquet", "pq"):
            return not read_table(spark, path).isEmpty()
        return not spark.read.text(path, recursiveFileLookup=True).isEmpty()
    except (AnalysisException, ValueError):
        return False
