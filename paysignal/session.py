"""Session helpers.

The library never creates hidden sessions; jobs and tests call
``get_spark``. Cluster settings (``spark.checkpoint.dir``, shuffle sizing)
come from the cluster; defaults here are only applied where unset.
"""

from __future__ import annotations

import os
import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.ui.enabled": "false",
    "spark.ui.showConsoleProgress": "false",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def get_spark(app: str = "paysignal", master: str | None = None, conf: dict | None = None) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **(conf or {})}.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession, sub: str) -> str:
    """A directory under the cluster's shared checkpoint folder.

    Reads ``spark.checkpoint.dir`` from the session. Only a local master may
    leave it unset (tests): a scratch folder is then created and registered
    for the session. On a cluster that is an error, as a machine-local path
    would be on every executor's own disk.
    """
    sc = spark.sparkContext
    base = sc.getCheckpointDir() or sc.getConf().get("spark.checkpoint.dir", None)
    if not base:
        if not sc.master.startswith("local[") and sc.master != "local":
            raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
        base = tempfile.mkdtemp(prefix="paysignal-ckpt-")
    if not sc.getCheckpointDir():
        sc.setCheckpointDir(base)
        base = sc.getCheckpointDir() or base
    path = os.path.join(base.rstrip("/"), sub) if "://" not in base else base.rstrip("/") + "/" + sub
    return path


def size_shuffles(spark: SparkSession, input_bytes: int, target_bytes: int = 256 << 20, max_partitions: int = 200_000) -> int:
    """Size ``spark.sql.shuffle.partitions`` so each shuffle partition of a
    job reading ``input_bytes`` holds about ``target_bytes`` (AQE coalesces
    smaller ones; it cannot split beyond this count except for skewed joins).
    A value set explicitly in the cluster configuration is left alone."""
    if spark.sparkContext.getConf().contains("spark.sql.shuffle.partitions"):
        return int(spark.conf.get("spark.sql.shuffle.partitions"))
    n = max(spark.sparkContext.defaultParallelism, min(max_partitions, -(-int(input_bytes) // int(target_bytes))))
    spark.conf.set("spark.sql.shuffle.partitions", str(n))
    return n


def bound_batches(spark: SparkSession, most_bytes: int = 4 << 20) -> int:
    """Bound the Arrow batches between an executor and its Python workers by
    ``most_bytes``: Spark's own limits are 10,000 rows and a size of many such
    batches, and both sides hold a batch of documents more than once. A value
    set explicitly in the cluster configuration is left alone."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    if not spark.sparkContext.getConf().contains(key):
        spark.conf.set(key, f"{most_bytes}b")
    return most_bytes
