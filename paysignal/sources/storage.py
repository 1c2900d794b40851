"""Versioned parquet tables on shared storage, sinks and catalog registration.

Layout: ``<root>/<table>/v=<n>/`` (n zero-padded). A version is committed
when Spark's output committer has written its ``_SUCCESS`` marker; readers
take the highest committed version. Every rewrite goes to a new version
directory, so a job never overwrites the directory it is reading, a crashed
job leaves the previous version current, and an SCD2 step is one commit
(the reference's MERGE + append were two). Works on any Hadoop-compatible
file system (the root is typically under the cluster's shared folder).
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

VERSION_PREFIX = "v="
# A version that carries partitions of earlier ones over lists all its partition
# folders in this file, relative to the table's folder.
MANIFEST = "_manifest"
# The schema of a partitioned table, for versions without any file of rows.
SCHEMA = "_schema"


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def list_dir(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    if not fs.exists(p):
        return []
    return [s.getPath().getName() for s in fs.listStatus(p)]


def read_lines(spark: SparkSession, path: str) -> list[str]:
    fs, p = _fs(spark, path)
    stream = fs.open(p)
    try:
        text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()
    return [x for x in text.split("\n") if x]


def remove(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.delete(p, True)


def written_bytes(spark: SparkSession, path: str) -> int:
    """Bytes under ``path``."""
    fs, p = _fs(spark, path)
    return int(fs.getContentSummary(p).getLength()) if fs.exists(p) else 0


def write_lines(spark: SparkSession, path: str, lines: Sequence[str]) -> None:
    fs, p = _fs(spark, path)
    stream = fs.create(p, False)
    try:
        stream.write(bytearray("".join(f"{x}\n" for x in lines).encode()))
    finally:
        stream.close()


def clustered(df: DataFrame, cluster_by: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Range-partition and sort by the clustering columns so parquet
    row-group min/max statistics let later filters skip data."""
    cols = [F.col(c) for c in cluster_by]
    out = df.repartitionByRange(partitions, *cols) if partitions else df.repartitionByRange(*cols)
    return out.sortWithinPartitions(*cols)


def zordered(df: DataFrame, columns: Sequence[str], partitions: int | None = None, bits: int = 5) -> DataFrame:
    """S16 on several columns at once: rows in ranges along a Z-order curve, so that a
    filter on any one of the columns finds its rows in few files.

    Each column's values are ranked by 2^bits quantiles (of any orderable type, from
    Spark's own range sampling: one narrow shuffle a column and 2^bits values to the
    driver); the ranks' bits, interleaved, are the place on the curve. With f files and c
    columns a filter on one value reads about f^(1 - 1/c) files."""
    place = F.lit(0).cast("long")
    for k, c in enumerate(columns):
        ranges = df.select(F.col(c).alias("v")).filter(F.col("v").isNotNull()).repartitionByRange(1 << bits, "v")
        bounds = ranges.groupBy(F.spark_partition_id().alias("p")).agg(F.min("v").alias("v")).orderBy("v")
        values = [r.v for r in bounds.collect()]
        held = F.array(*[F.lit(v).cast(df.schema[c].dataType) for v in values[1:]]) if len(values) > 1 else F.array()
        rank = F.when(F.col(c).isNull(), 0).otherwise(F.size(F.filter(held, lambda b: b <= F.col(c)))) if len(values) > 1 else F.lit(0)  # noqa: B023
        for i in range(bits):
            place = place + F.shiftleft(F.shiftright(rank.cast("long"), i).bitwiseAND(F.lit(1)), i * len(columns) + k)
    keyed = df.withColumn("_z", place)
    out = keyed.repartitionByRange(partitions, "_z") if partitions else keyed.repartitionByRange("_z")
    return out.sortWithinPartitions("_z", *columns).drop("_z")


class TableStore:
    """Named, versioned parquet tables under ``root``."""

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")

    def table_path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def versions(self, name: str) -> list[int]:
        out = []
        for entry in list_dir(self.spark, self.table_path(name)):
            if entry.startswith(VERSION_PREFIX) and path_exists(self.spark, f"{self.table_path(name)}/{entry}/_SUCCESS"):
                out.append(int(entry[len(VERSION_PREFIX):]))
        return sorted(out)

    def current_version(self, name: str) -> int | None:
        v = self.versions(name)
        return v[-1] if v else None

    def exists(self, name: str) -> bool:
        return self.current_version(name) is not None

    def path(self, name: str, version: int | None = None) -> str:
        version = self.current_version(name) if version is None else version
        if version is None:
            raise FileNotFoundError(f"table {name!r} has no committed version under {self.root}")
        return f"{self.table_path(name)}/{VERSION_PREFIX}{version:08d}"

    def read(self, name: str, version: int | None = None) -> DataFrame:
        path = self.path(name, version)
        if path_exists(self.spark, f"{path}/{SCHEMA}") and self.is_empty(name, version):
            return self.spark.createDataFrame([], T.StructType.fromJson(json.loads(read_lines(self.spark, f"{path}/{SCHEMA}")[0])))
        if not path_exists(self.spark, f"{path}/{MANIFEST}"):
            return self.spark.read.parquet(path)
        column = VERSION_PREFIX.rstrip("=")
        folders = [f"{self.table_path(name)}/{x}" for x in read_lines(self.spark, f"{path}/{MANIFEST}")]
        return self.spark.read.option("basePath", self.table_path(name)).parquet(*folders).drop(column)

    def is_empty(self, name: str, version: int | None = None) -> bool:
        """The version holds no file of rows (a partitioned table without rows has none)."""
        path = self.path(name, version)
        if path_exists(self.spark, f"{path}/{MANIFEST}"):
            return not read_lines(self.spark, f"{path}/{MANIFEST}")
        return all(x.startswith(("_", ".")) and "=" not in x for x in list_dir(self.spark, path))

    def partitions(self, name: str, version: int | None = None) -> list[str]:
        """Partition folders of a version, relative to the table's folder."""
        path = self.path(name, version)
        if path_exists(self.spark, f"{path}/{MANIFEST}"):
            return read_lines(self.spark, f"{path}/{MANIFEST}")
        own = path.rsplit("/", 1)[-1]
        return [f"{own}/{x}" for x in list_dir(self.spark, path) if "=" in x]

    def write(
        self,
        name: str,
        df: DataFrame,
        partition_by: Sequence[str] = (),
        cluster_by: Sequence[str] | None = None,
        version: int | None = None,
        zorder_by: Sequence[str] | None = None,
        files: int | None = None,
    ) -> int:
        """Write ``df`` as the next version, or a given later one (S10, S11, S12
        snapshot swap, S16: clustered by columns in order, or along a Z-order curve in ``files`` files)."""
        version = max(version or 0, (self.current_version(name) or 0) + 1)
        existing = list_dir(self.spark, self.table_path(name))
        while f"{VERSION_PREFIX}{version:08d}" in existing:  # an uncommitted attempt: skip it
            version += 1
        if zorder_by:
            df = zordered(df, zorder_by, files)
        elif cluster_by:
            df = clustered(df, cluster_by)
        elif partition_by:  # a partition's rows in few files; AQE splits the large partitions
            df = df.hint("rebalance", *partition_by)
        writer = df.write.mode("errorifexists")
        if partition_by:
            writer = writer.partitionBy(*partition_by)
        writer.parquet(f"{self.table_path(name)}/{VERSION_PREFIX}{version:08d}")
        if partition_by:
            write_lines(self.spark, f"{self.table_path(name)}/{VERSION_PREFIX}{version:08d}/{SCHEMA}", [df.schema.json()])
        return version

    def replace_partitions(
        self, name: str, df: DataFrame, partition_by: str, replaced: Callable[[str], bool], base: int | None = None
    ) -> int:
        """The next version: ``df`` instead of the partitions whose value is
        ``replaced`` (those without new rows go), all others carried over by
        reference from version ``base`` (the current one). Rows of a partition that
        is not replaced are added to it, in a folder of their own. Readers see the old
        version until the new one's manifest and marker are in place."""
        if not self.exists(name):
            return self.write(name, df, [partition_by])
        carried = [x for x in self.partitions(name, base) if not replaced(x.rsplit("=", 1)[-1])]
        version = self.current_version(name) + 1
        existing = list_dir(self.spark, self.table_path(name))
        while f"{VERSION_PREFIX}{version:08d}" in existing:  # an uncommitted attempt: skip it
            version += 1
        own = f"{VERSION_PREFIX}{version:08d}"
        path = f"{self.table_path(name)}/{own}"
        (
            df.hint("rebalance", partition_by)
            .write.mode("errorifexists")
            .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")  # not committed yet
            .partitionBy(partition_by)
            .parquet(path)
        )
        new = [f"{own}/{x}" for x in list_dir(self.spark, path) if "=" in x]
        write_lines(self.spark, f"{path}/{SCHEMA}", [df.schema.json()])
        write_lines(self.spark, f"{path}/{MANIFEST}", sorted(carried + new))
        write_lines(self.spark, f"{path}/_SUCCESS", [])
        return version

    def register(self, name: str, database: str, table: str | None = None) -> str:
        """Database + external table at the current version's path."""
        table = table or name
        qualified = f"`{database}`.`{table}`"
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{database}` LOCATION '{self.root}/_catalog/{database}.db'")
        location = self.path(name)
        if self.spark.catalog.tableExists(f"{database}.{table}"):
            self.spark.sql(f"DROP TABLE {qualified}")
        if path_exists(self.spark, f"{location}/{MANIFEST}"):
            folders = self.partitions(name)
            column = folders[0].rsplit("/", 1)[-1].split("=", 1)[0]
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in self.read(name).schema.fields)
            self.spark.sql(f"CREATE TABLE {qualified} ({columns}) USING parquet PARTITIONED BY (`{column}`) LOCATION '{location}'")
            added = " ".join(
                f"PARTITION (`{column}`='{x.rsplit('=', 1)[-1]}') LOCATION '{self.table_path(name)}/{x}'" for x in folders
            )
            self.spark.sql(f"ALTER TABLE {qualified} ADD {added}")
            return f"{database}.{table}"
        self.spark.sql(f"CREATE TABLE {qualified} USING parquet LOCATION '{location}'")
        if any(c.isPartition for c in self.spark.catalog.listColumns(f"{database}.{table}")):
            self.spark.sql(f"ALTER TABLE {qualified} RECOVER PARTITIONS")
        return f"{database}.{table}"


def csv_export(df: DataFrame, path: str, columns: Sequence[str] | None = None) -> None:
    """Header + one line per row, UTF-8, microsecond timestamps."""
    out = df.select(*columns) if columns else df
    (
        out.write.mode("errorifexists")
        .option("header", True)
        .option("encoding", "UTF-8")
        .option("timestampFormat", "yyyy-MM-dd HH:mm:ss.SSSSSS")
        .csv(path)
    )
