"""Operator 3, quality selection by importance resampling with hashed n-grams.

Words and word pairs are hashed into ``BUCKETS`` buckets. Two generative
models are counted, one of the raw corpus (all documents) and one of the
target (documents labelled of good quality); a document's importance is the
ratio of its probabilities under the two. The logarithm is taken per n-gram
and scaled to a text of ``SCALE`` n-grams, so that long texts aren't decided
by their length. Gumbel noise, a hash of the row, is added, and the k largest
are selected: a sample without replacement in proportion to importance. k is
``share`` of the rows, by default the share of good rows among labelled ones.

The exact k-th key is found without sorting: counts of 16 bits of the key at
a time, four small aggregations.

The raw model counts every document. The target model is fitted on a bounded
sample of labelled rows, the ``SAMPLE_ROWS`` of least hash.

Defined cases: null and empty texts have no n-gram and come last; equal keys
are ordered by doc_id (null last), rows equal in both stay or go together,
which is the one case that can exceed k; without labels nothing tells target
from raw and all ratios are 0; an empty table selects nothing.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm import bytekit as bk
from skyfold.llm.names import free_names
from skyfold.llm.store import Store

BUCKETS = 10_000
SCALE = 100.0
SAMPLE_ROWS = 20_000
SEED = 17


def _features(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the words and pairs of all rows, and the row of each."""
    low = bk.LOWER[buf]
    starts, ends, word_off = bk.row_runs(bk.NOT_SPACE[low], off)
    words = bk.span_hash(bk.prefix_hash(low), starts, ends)
    row = np.repeat(np.arange(len(off) - 1), np.diff(word_off))
    pair = bk.gram_starts(word_off, 2)
    h = np.concatenate([words, bk.gram_hash(words, 2)[pair]])
    return (h % np.uint64(BUCKETS)).astype(np.int64), np.concatenate([row, row[pair]])


def labelled(labels: DataFrame) -> DataFrame:
    """(doc_id, good) of all labelled documents."""
    return labels.where("doc_id is not null and quality is not null").groupBy("doc_id").agg((F.min("quality") > 0).alias("good"))


def good_rows(labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> DataFrame:
    """(doc_id, good) of at most ``sample_rows`` labelled documents."""
    return labelled(labels).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)


def log_ratio(docs: DataFrame, good: DataFrame) -> np.ndarray:
    """Per bucket, log P(target) - log P(raw)."""
    ids = good.where("good").select("doc_id").withColumn("good", F.lit(True))
    marked = docs.select("doc_id", "text").join(F.broadcast(ids), "doc_id", "left") \
                 .select("text", F.coalesce("good", F.lit(False)).alias("good"))      # bounded by SAMPLE_ROWS

    def run(batches):
        counts = np.zeros((2, BUCKETS), np.int64)
        for batch in batches:
            buf, off = bk.text_bytes(batch)
            target = batch.column(1).to_numpy(zero_copy_only=False).astype(bool)
            for i, j, part, part_off in bk.slices(buf, off):
                bucket, row = _features(part, part_off)
                counts[0] += np.bincount(bucket, minlength=BUCKETS)
                counts[1] += np.bincount(bucket[target[i:j][row]], minlength=BUCKETS)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(BUCKETS)), pa.array(counts[0]), pa.array(counts[1])], names=["bucket", "raw", "target"])

    got = bk.map_batches(marked, run, "bucket long, raw long, target long").groupBy("bucket") \
            .agg(F.sum("raw").alias("raw"), F.sum("target").alias("target")).toPandas()
    raw, target = np.ones(BUCKETS), np.ones(BUCKETS)
    raw[got["bucket"]] += got["raw"]
    target[got["bucket"]] += got["target"]
    if target.sum() == BUCKETS:
        return np.zeros(BUCKETS)
    return np.log(target / target.sum()) - np.log(raw / raw.sum())


def weigh(docs: DataFrame, ratio: np.ndarray) -> DataFrame:
    """``docs`` with ``_sk_weight`` as the last column: the log importance, null without n-grams;
    the name gets leading underscores where ``docs`` has such a column."""
    name = free_names(docs.columns, "_sk_weight")[0]
    shared = docs.sparkSession.sparkContext.broadcast(ratio)

    def run(batches):
        for batch in batches:
            buf, off = bk.text_bytes(batch)
            out = [np.zeros(0)]
            for _, _, part, part_off in bk.slices(buf, off):
                bucket, row = _features(part, part_off)
                n = np.bincount(row, minlength=len(part_off) - 1)
                total = np.bincount(row, shared.value[bucket], len(part_off) - 1)
                out.append(np.where(n > 0, SCALE * total / np.maximum(n, 1), np.nan))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out), from_pandas=True)], names=[*batch.schema.names, name])

    return bk.map_batches(docs, run, docs.withColumn(name, F.lit(None).cast("double")).schema)


def gumbel(*row: Column) -> Column:
    """Standard Gumbel noise from a hash of the row."""
    u = (F.shiftrightunsigned(F.xxhash64(F.lit(SEED), *row), 11) + F.lit(0.5)) / F.lit(2.0 ** 53)
    return -F.log(-F.log(u))


def largest(df: DataFrame, key: str, k: int) -> int | None:
    """The k-th largest value of a long column (None if there are fewer rows), 16 bits at a time."""
    total = df.count()
    if k <= 0 or k > total:
        return None
    flip = F.col(key).bitwiseXOR(F.lit(-(1 << 63)))         # unsigned order
    found = 0
    for shift in (48, 32, 16, 0):
        part = F.shiftrightunsigned(flip, shift).bitwiseAND(F.lit(0xFFFF))
        same = df if shift == 48 else df.where(F.shiftrightunsigned(flip, shift + 16) == F.lit(found))
        for value, n in same.groupBy(part.alias("part")).count().orderBy(F.desc("part")).collect():      # 65,536 at most
            if k <= n:
                found = (found << 16) | value
                break
            k -= n
    return found - (1 << 63)


def select_top(df: DataFrame, key: str, k: int) -> DataFrame:
    """``df`` with ``_sk_kept``: whether a row's double ``key`` is among the k largest, ties by doc_id."""
    ranked = df.withColumn("_sk_bits", _order_bits(F.col(key))).withColumn("_sk_tie", -F.coalesce(F.col("doc_id").cast("long"), F.lit((1 << 63) - 1)))
    cut = largest(ranked.select("_sk_bits"), "_sk_bits", k)
    if cut is None:
        return df.withColumn("_sk_kept", F.lit(k > 0))
    above = ranked.where(F.col("_sk_bits") > cut).count()
    tie = largest(ranked.where(F.col("_sk_bits") == cut).select("_sk_tie"), "_sk_tie", k - above)
    return ranked.withColumn("_sk_kept", (F.col("_sk_bits") > cut) | ((F.col("_sk_bits") == cut) & (F.col("_sk_tie") >= tie))).drop("_sk_bits", "_sk_tie")


def _order_bits(x: Column) -> Column:
    """A long in the order of the double, at a resolution of 1e-9; all keys are below 1e9 in size."""
    return F.round(F.greatest(F.least(x, F.lit(9e8)), F.lit(-9e8)) * F.lit(1e9)).cast("long")


def resample(store: Store, docs: DataFrame, labels: DataFrame, share: float | None = None) -> DataFrame:
    """One row per document: doc_id, log_weight, gumbel_key, kept."""
    good = store.keep(good_rows(labels))
    if share is None:
        share = labelled(labels).agg(F.avg(F.col("good").cast("double"))).first()[0] or 0.0
    weighed = weigh(docs.select("doc_id", "text"), log_ratio(docs, good))
    noisy = weighed.select("doc_id", F.col("_sk_weight").alias("log_weight"),
                           F.coalesce(F.col("_sk_weight") + gumbel(F.col("doc_id"), F.col("text")), F.lit(-9e8)).alias("gumbel_key"))
    noisy = store.keep(noisy)
    chosen = select_top(noisy, "gumbel_key", round(share * noisy.count()))
    return chosen.select("doc_id", "log_weight", "gumbel_key", (F.col("_sk_kept") & F.col("log_weight").isNotNull()).alias("kept"))
