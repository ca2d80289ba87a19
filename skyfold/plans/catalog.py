"""Registered driver queries: name -> (job, output columns).

Each job takes (spark, folder of source tables) and returns a DataFrame.
The output column list fixes names, order and a comparison type per column
(i: bigint, n: nullable integer carried as double so NULLs look the same
on both sides, d: double, s: string, b: boolean, t: timestamp text, D: date
text) so the DuckDB oracle can state exactly the same shape.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

Job = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, tuple[Job, list[tuple[str, str]]]] = {}

_SPARK_CAST = {"i": "bigint", "n": "double", "d": "double", "s": "string", "b": "boolean"}


def shaped(df: DataFrame, cols: list[tuple[str, str]]) -> DataFrame:
    out = []
    for name, kind in cols:
        c = F.col(name)
        if kind == "t":
            c = F.date_format(c, "yyyy-MM-dd HH:mm:ss")
        elif kind == "D":
            c = F.date_format(c, "yyyy-MM-dd")
        else:
            c = c.cast(_SPARK_CAST[kind])
        out.append(c.alias(name))
    return df.select(*out)


def register(name: str, cols: str):
    """``cols``: 'name:kind name:kind ...'."""
    spec = [tuple(tok.split(":")) for tok in cols.split()]

    def deco(fn: Job) -> Job:
        def job(spark: SparkSession, sf_dir: str) -> DataFrame:
            return shaped(fn(spark, sf_dir), spec)
        job.__name__ = fn.__name__
        job.__doc__ = fn.__doc__
        QUERIES[name] = (job, spec)
        return job
    return deco


def columns(name: str) -> list[tuple[str, str]]:
    return QUERIES[name][1]
