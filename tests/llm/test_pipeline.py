"""The pipeline, stage by stage, against brute force."""

import corpus_pipeline as P
from skyfold.llm.pieces import Encoder, Vocabulary
from skyfold.llm.store import Store
from tests.llm import fixtures as X


def _stage(spark, tables, name, docs):
    out = dict(P.STAGES)[name](spark, docs, tables)
    return Store(spark, "test").keep(out)


def test_stages_in_order():
    assert [n for n, _ in P.STAGES] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "sentencepiece"]


def test_stages_against_brute_force(spark, tables):
    docs = spark.read.parquet(f"{tables}/documents.parquet").where("doc_id != 7 or doc_id is null")
    kept = _stage(spark, tables, "toxicity", docs)
    assert kept.columns == docs.columns
    lines = _stage(spark, tables, "line_dedup", kept)
    assert lines.columns == docs.columns
    before = [tuple(r) for r in kept.select("doc_id", "text").collect()]
    expected = [(d, t) for d, n, gone, t in X.cut_lines(before) if gone == 0 or gone < n]
    assert X.rows_of(lines, "doc_id", "text") == sorted(expected, key=str)
    near = _stage(spark, tables, "near_dedup", lines)
    assert near.columns == docs.columns
    before = [tuple(r) for r in lines.select("doc_id", "text").collect()]
    # equal rows of one group are one row then, rows without words are in no group
    verdicts = list(zip(before, X.near_groups(before, P.SHINGLE)))
    stay = list({r for r, (_, n, _, k) in verdicts if k and n}) + [r for r, (_, n, _, k) in verdicts if k and not n]
    assert X.rows_of(near, "doc_id", "text") == sorted(stay, key=str)
    clean = _stage(spark, tables, "decontamination", near)
    assert clean.columns == docs.columns
    before = [tuple(r) for r in near.select("doc_id", "text").collect()]
    hits = X.contaminated(before, X.benchmark_rows())
    assert sorted(map(str, (d for d, n, hit, *_ in hits if not n or hit <= n / 2))) == sorted(str(r[0]) for r in clean.select("doc_id").collect())
    untouched = {d for d, _, hit, *_ in hits if not hit}
    after = clean.collect()
    assert {(r["doc_id"], r["text"]) for r in after if r["doc_id"] in untouched} == {r for r in before if r[0] in untouched}
    assert not [r for r in X.contaminated([(r["doc_id"], r["text"]) for r in after], [i for i in X.benchmark_rows() if i[1] and len(i[1].split()) > 20]) if r[2] > 9]
    assert all(r["n_chars"] == (None if r["text"] is None else len(r["text"])) for r in after)
    tokens = _stage(spark, tables, "sentencepiece", clean)
    coder = Encoder(Vocabulary.load())
    texts = sorted((str(r["doc_id"]), coder.encode(r["text"] or "").tolist()) for r in after)
    assert sorted((str(r["doc_id"]), r["token_ids"] or []) for r in tokens.collect()) == texts


def test_run_is_the_stages_in_a_row(spark, tables):
    out = P.run(spark, tables)
    assert out.count() > 60
    assert {"doc_id", "token_ids", "n_tokens", "round_trip"} <= set(out.columns)
