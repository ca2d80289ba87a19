"""Hot-key-safe running aggregates over ordered rows.

A window partitioned by a key hands the whole key to one task. These
helpers split every key into buckets (a time bucket, or the partition of
a range-partitioned frame), compute inside (key, bucket) and carry the
totals of earlier buckets from a small table with one row per
(key, bucket) — so a key holding a third of all rows is spread over many
tasks, and the results are exact.
"""

from __future__ import annotations

from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.session import checkpoint_dir


def prefix_sum(df: DataFrame, keys: list[str], order: list[str], value: str | list[str], bucket: Column,
               out: str | list[str]) -> DataFrame:
    """Exclusive running sums of ``value`` column(s) per ``keys`` in ``order``.

    Computed as (sum of earlier buckets) + (running sum inside the bucket):
    the window over the raw rows is partitioned by (keys, bucket), the
    window over bucket totals by keys only — that table has one row per
    (key, bucket) and stays small. Several value columns share one pass."""
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    d = df.withColumn("_ps_bucket", bucket)
    w_in = Window.partitionBy(*keys, "_ps_bucket").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    for i, v in enumerate(values):
        d = d.withColumn(f"_ps_in{i}", F.coalesce(F.sum(v).over(w_in), F.lit(0)))
    tot = d.groupBy(*keys, "_ps_bucket").agg(*[F.sum(v).alias(f"_ps_bt{i}") for i, v in enumerate(values)])
    w_b = Window.partitionBy(*keys).orderBy("_ps_bucket").rowsBetween(Window.unboundedPreceding, -1)
    for i in range(len(values)):
        tot = tot.withColumn(f"_ps_before{i}", F.coalesce(F.sum(f"_ps_bt{i}").over(w_b), F.lit(0))).drop(f"_ps_bt{i}")
    d = d.join(tot, [*keys, "_ps_bucket"])
    for i, o in enumerate(outs):
        d = d.withColumn(o, F.col(f"_ps_before{i}") + F.col(f"_ps_in{i}"))
    return d.drop("_ps_bucket", *[f"_ps_{p}{i}" for i in range(len(values)) for p in ("in", "before")])


def large_keys(df: DataFrame, keys: list[str], most: int = 100_000) -> DataFrame | None:
    """The keys of more than ``most`` rows, or None: few, at most one for each ``most`` rows."""
    checkpoint_dir(df.sparkSession)
    large = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_lk_rows")).where(F.col("_lk_rows") > most).select(*keys).checkpoint()
    return None if large.isEmpty() else large


def prefix_sum_by_size(df: DataFrame, keys: list[str], order: list[str], value: str | list[str], bucket: Column,
                       out: str | list[str], large: DataFrame | None) -> DataFrame:
    """``prefix_sum`` that buckets the ``large`` keys only (see ``large_keys``); a plain window sums the
    others, which needs one shuffle and no table of buckets. Rows with a null key or bucket are left out;
    those of a null bucket, which have a null ``order``, still count as the earliest of their key."""
    values = [value] if isinstance(value, str) else list(value)
    outs = [out] if isinstance(out, str) else list(out)
    keyed = df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    before = Window.partitionBy(*keys).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = {o: F.coalesce(F.sum(v).over(before), F.lit(0)) for v, o in zip(values, outs)}
    if large is None:
        return keyed.withColumns(sums).where(bucket.isNotNull())
    large = F.broadcast(large)
    rest = keyed.join(large, keys, "left_anti").select(*df.columns).withColumns(sums).where(bucket.isNotNull())
    hot = prefix_sum(keyed.join(large, keys, "left_semi").select(*df.columns), keys, order, values, bucket, outs)
    return rest.unionByName(hot.select(*rest.columns))


def running_level(df: DataFrame, keys: list[str], order: list[str], values: list[str], bucket: Column) -> DataFrame:
    """For each of ``values`` its running sum per ``keys`` in ``order``, own row
    included (``<value>_level``), and the least level so far (``<value>_lowest``).

    A bucket is summed up by the pair (its total, the least level inside it,
    counted from zero); pairs of earlier buckets compose to what a bucket
    starts from, so no window ever holds more than one bucket of a key."""
    w_in = Window.partitionBy(*keys, "_rl_b").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    w_b = Window.partitionBy(*keys).orderBy("_rl_b").rowsBetween(Window.unboundedPreceding, -1)
    d = df.withColumn("_rl_b", bucket).withColumns({f"_rl_in_{v}": F.sum(v).over(w_in) for v in values})
    d = d.withColumns({f"_rl_low_{v}": F.min(f"_rl_in_{v}").over(w_in) for v in values})
    tot = d.groupBy(*keys, "_rl_b").agg(*[F.sum(v).alias(f"_rl_t_{v}") for v in values], *[F.min(f"_rl_in_{v}").alias(f"_rl_m_{v}") for v in values])
    tot = tot.withColumns({f"_rl_from_{v}": F.coalesce(F.sum(f"_rl_t_{v}").over(w_b), F.lit(0)) for v in values})
    tot = tot.withColumns({f"_rl_was_{v}": F.min(F.col(f"_rl_from_{v}") + F.col(f"_rl_m_{v}")).over(w_b) for v in values})
    d = d.join(tot.select(*keys, "_rl_b", *[f"_rl_{p}_{v}" for p in ("from", "was") for v in values]), [*keys, "_rl_b"])
    for v in values:
        start = F.col(f"_rl_from_{v}")
        d = d.withColumn(f"{v}_level", start + F.col(f"_rl_in_{v}")) \
             .withColumn(f"{v}_lowest", F.least(F.col(f"_rl_was_{v}"), start + F.col(f"_rl_low_{v}")))
    return d.drop("_rl_b", *[f"_rl_{p}_{v}" for p in ("in", "low", "from", "was") for v in values])


def prior_value(df: DataFrame, keys: list[str], order: list[str], value: str, bucket: Column,
                out: str) -> DataFrame:
    """``value`` of the previous row per ``keys`` in ``order`` (a lag),
    hot-key safe: lag inside (keys, bucket); the first row of a bucket takes
    the last value of the nearest earlier bucket, from a small table of one
    row per (key, bucket). ``value`` must be non-null on every row."""
    d = df.withColumn("_pv_b", bucket)
    w_in = Window.partitionBy(*keys, "_pv_b").orderBy(*order)
    d = d.withColumn("_pv_lag", F.lag(value).over(w_in)).withColumn("_pv_first", F.row_number().over(w_in) == 1)
    last = d.groupBy(*keys, "_pv_b").agg(F.max_by(value, F.struct(*order)).alias("_pv_last"))
    w_b = Window.partitionBy(*keys).orderBy("_pv_b")
    last = last.withColumn("_pv_prev", F.lag("_pv_last").over(w_b)).drop("_pv_last")
    d = d.join(last, [*keys, "_pv_b"])
    return (d.withColumn(out, F.when(F.col("_pv_first"), F.col("_pv_prev")).otherwise(F.col("_pv_lag")))
            .drop("_pv_b", "_pv_lag", "_pv_first", "_pv_prev"))


def number_rows(df: DataFrame, keys: list[str], order: list[str], out: str, most: int = 100_000) -> DataFrame:
    """``row_number()`` over (keys order by ``order``), 1-based, without
    giving a large key to one task: keys of up to ``most`` rows are numbered
    by a plain window, the rows of larger ones (found by a count, and few: at
    most one for each ``most`` rows) by ``_number_ranged``. Rows with a null
    key are left out."""
    checkpoint_dir(df.sparkSession)
    keyed = df.where(reduce(and_, [F.col(k).isNotNull() for k in keys]))
    large = (keyed.groupBy(*keys).agg(F.count(F.lit(1)).alias("_nr_rows")).where(F.col("_nr_rows") > most)
             .select(*keys).checkpoint())
    plain = F.row_number().over(Window.partitionBy(*keys).orderBy(*order)).cast("int")
    if large.isEmpty():
        return keyed.withColumn(out, plain)
    hot = keyed.join(large, keys, "left_semi").select(*df.columns)
    rest = keyed.join(large, keys, "left_anti").select(*df.columns)
    return rest.withColumn(out, plain).unionByName(_number_ranged(hot, keys, order, out))


def _number_ranged(df: DataFrame, keys: list[str], order: list[str], out: str) -> DataFrame:
    """``number_rows`` of large keys: range-partition by (keys, order), then a
    row's number is the rows of its key in earlier partitions plus its rank
    inside its own partition (``prefix_sum`` with the partition id as bucket).

    The ranged frame is checkpointed: range boundaries are sampled anew by
    each evaluation, and both sides of ``prefix_sum`` must see the same ones."""
    ranged = (df.repartitionByRange(*keys, *order)
              .withColumn("_nr_pid", F.spark_partition_id()).withColumn("_nr_one", F.lit(1)).checkpoint())
    numbered = prefix_sum(ranged, keys, order, "_nr_one", F.col("_nr_pid"), "_nr_before")
    return numbered.withColumn(out, (F.col("_nr_before") + 1).cast("int")).drop("_nr_pid", "_nr_one", "_nr_before")
