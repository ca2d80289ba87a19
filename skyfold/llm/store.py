"""Tables kept in the shared checkpoint folder, to cut lineage."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from skyfold.session import work_dir


class Store:
    """A fresh folder under ``spark.checkpoint.dir`` for one run of one operator."""

    def __init__(self, spark: SparkSession, name: str) -> None:
        self.spark, self.dir, self.n = spark, work_dir(spark, f"{name}-{uuid.uuid4().hex}"), 0

    def path(self, name: str = "") -> str:
        self.n += 1
        return f"{self.dir}/{name or 'table'}-{self.n}"

    def keep(self, df: DataFrame) -> DataFrame:
        """Writes the frame and returns it as read from there; lost executors can't lose it."""
        path = self.path()
        df.write.parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)
