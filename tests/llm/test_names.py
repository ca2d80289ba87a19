"""Tables whose columns have the operators' own names, ids that repeat with other texts, null ids."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline as P
from skyfold.llm import decontaminate, importance, langid, linededup, toxicity
from skyfold.llm.store import Store
from tests.llm import fixtures as X

CLASHES = ["_sk_score", "_sk_lang", "_sk_weight", "_sk_runs", "_sk_lines", "_sk_removed", "_sk_id", "_sk_words", "_sk_spans", "_sk_items", "_sk_split", "_SK_T1", "n_chars"]


def _rows():
    rng = random.Random(12)
    texts = [X.prose(rng, 60) for _ in range(12)]
    shared = "\n".join(X.prose(rng, 8) for _ in range(4))
    rows = [(i, t) for i, t in enumerate(texts)] + [(3, texts[9] + " and more"), (3, X.prose(rng, 60)), (None, X.prose(rng, 60)), (None, None), (None, texts[2]), (5, ""), (60, shared), (60, "x\n" + shared)]
    return rows


@pytest.fixture(scope="module")
def docs(spark):
    plain = spark.createDataFrame(_rows(), "doc_id long, text string")
    return Store(spark, "names").keep(plain.select("doc_id", *[F.lit(k).alias(c) for k, c in enumerate(CLASHES)], "text"))


def _kept_as_given(out, docs):
    assert out.columns[:len(docs.columns)] == docs.columns
    got = out.select(*CLASHES[:-1]).distinct().collect()
    assert [tuple(r) for r in got] == [tuple(range(len(CLASHES) - 1))]


def test_added_columns_come_last_under_free_names(spark, docs):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    scored = toxicity.scores(docs, toxicity.fit(Store(spark, "t"), docs, none))
    assert scored.columns[-1] == "__sk_score"
    _kept_as_given(scored, docs)
    weighed = importance.weigh(docs, np.ones(importance.BUCKETS))
    assert weighed.columns[-1] == "__sk_weight"
    _kept_as_given(weighed, docs)
    pieces = langid.Pieces.load()
    lang = langid.identify(docs, langid.Model(["x"], pieces, pieces.start[:, None]))
    assert lang.columns[-2:] == ["__sk_lang", "__sk_score"]
    _kept_as_given(lang, docs)
    lines = linededup.dedup_lines(docs)
    assert lines.columns[-2:] == ["__sk_lines", "__sk_removed"]
    _kept_as_given(lines, docs)
    expected = sorted(X.cut_lines(_rows()), key=str)
    assert sorted(map(tuple, lines.select("doc_id", *lines.columns[-2:], "text").collect()), key=str) == expected
    clean = decontaminate.decontaminate(docs, spark.createDataFrame([("b", _rows()[0][1][:200])], "item_id string, text string"))
    assert clean.columns == docs.columns
    _kept_as_given(clean, docs)


def test_every_stage_keeps_columns_that_clash(spark, docs, tables):
    rows = docs
    for name, stage in P.STAGES[:-1]:
        rows = Store(spark, "stage").keep(stage(spark, rows, tables))
        _kept_as_given(rows, docs)
        assert rows.columns == docs.columns
    assert 0 < rows.count() <= docs.count()
    near = P.near_dedup(spark, docs, tables)
    # ids that repeat with other texts, and null ids: one row of each group of near-duplicates stays
    verdicts = list(zip(_rows(), X.near_groups(_rows(), P.SHINGLE)))
    stay = list({r for r, (_, n, _, k) in verdicts if k and n}) + [r for r, (_, n, _, k) in verdicts if k and not n]
    pair = [r for r in X.rows_of(near, "doc_id", "text") if r[0] == 60]      # two near copies under one id: one stays
    assert len(pair) == 1 and pair[0] in stay
    assert [r for r in X.rows_of(near, "doc_id", "text") if r[0] != 60] == sorted((r for r in stay if r[0] != 60), key=str)
