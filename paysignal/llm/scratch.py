"""Tables written to the cluster's shared folder, to cut lineage.

A written table survives the loss of any executor; ``localCheckpoint`` would not.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from paysignal.session import shared_dir


class Scratch:
    """A folder of its own under ``spark.checkpoint.dir`` for one operator call."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = shared_dir(spark, f"llm-{name}-{uuid.uuid4().hex[:12]}")
        self._n = 0

    def path(self, name: str) -> str:
        self._n += 1
        return f"{self.root}/{self._n:03d}-{name}"

    def table(self, df: DataFrame, name: str) -> DataFrame:
        """Write ``df`` and read it back: its plan is then one scan."""
        path = self.path(name)
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
