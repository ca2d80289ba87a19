"""A cleaning pipeline over ``documents``: each stage works on all rows that the one before kept.

STAGES lists (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which ``run`` writes as Parquet and reads again as the
next stage's docs. All stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm import decontaminate, linededup, minhash, pieces, toxicity
from skyfold.llm.store import Store

#: Documents of at least this probability of being toxic go.
TOXIC = 0.5
#: Similar documents have this many consecutive words in a shingle.
SHINGLE = 5


def _text_changed(out: DataFrame, columns: list[str]) -> DataFrame:
    """The columns of documents, with n_chars counted anew."""
    if "n_chars" in columns:
        out = out.withColumn("n_chars", F.length("text").cast(out.schema["n_chars"].dataType))
    return out.select(*columns)


def toxic_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier takes for toxic go."""
    classifier = toxicity.fit(Store(spark, "toxicity"), docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = toxicity.scores(docs, classifier)
    return scored.where(F.col(scored.columns[-1]) < TOXIC).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Later copies of three-line passages go; a document that loses all its lines goes."""
    out = linededup.dedup_lines(docs)
    lines, removed = (F.col(c) for c in out.columns[-2:])
    return _text_changed(out.where((removed == 0) | (removed < lines)), docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of near-duplicates stays, of its least doc_id."""
    return minhash.keep_one(docs, SHINGLE)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Passages of benchmark items are cut out; documents that are mostly such passages go."""
    return _text_changed(decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet")), docs.columns)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of the whole text."""
    return pieces.encode(docs).drop("text")


STAGES = [("toxicity", toxic_filter), ("line_dedup", line_dedup), ("near_dedup", near_dedup), ("decontamination", decontamination), ("sentencepiece", sentencepiece)]

#: Learned scores, reachability and segmentation have no SQL form; tests hold run() against brute force.
ORACLE_SQL: str | None = None


def oracle_sql() -> dict[str, str]:
    return {"pipeline": ORACLE_SQL} if ORACLE_SQL else {}


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES:
        docs = store.keep(stage(spark, docs, sf_dir))
    return docs
