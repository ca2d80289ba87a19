"""Reading source tables (S1) and small inline relations (S6)."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
                 "lineitem", "events")


def read_table(spark: SparkSession, base_dir: str, name: str,
               schema: StructType | None = None) -> DataFrame:
    """Scan one Parquet table. Column pruning and filters reach the scan
    because callers select / filter before any action."""
    reader = spark.read
    if schema is not None:
        reader = reader.schema(schema)
    return reader.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def read_jdbc(spark: SparkSession, url: str, table: str, partition_column: str,
              lower: int, upper: int, num_partitions: int, **options: str) -> DataFrame:
    """Optional connector for an operational database: a partitioned parallel
    read (one range query per partition) instead of one cursor."""
    reader = (spark.read.format("jdbc").option("url", url).option("dbtable", table)
              .option("partitionColumn", partition_column)
              .option("lowerBound", str(lower)).option("upperBound", str(upper))
              .option("numPartitions", str(num_partitions)))
    for k, v in options.items():
        reader = reader.option(k, v)
    return reader.load()


def values(spark: SparkSession, rows: Iterable[tuple], schema: StructType | str) -> DataFrame:
    """Inline relation, like SQL ``VALUES (...)``. Only for fixed lookup rows."""
    return spark.createDataFrame(list(rows), schema)
