"""The registered queries over awkward tables, against brute force; and over empty tables."""

import pytest

import __spark_entry__ as E
from tests.llm import fixtures as X

DOCS = [(r[0], r[1]) for r in X.document_rows()]


def _run(spark, path, name, *columns):
    return X.rows_of(E.queries()[name](spark, path), *columns)


def _same(got, expected):
    expected = sorted(expected, key=str)
    assert got == expected


def test_all_operators_are_registered():
    names = E.queries()
    assert "pipeline" in names
    for n in range(1, 14):
        assert len([x for x in names if x.startswith(f"op{n}_")]) == 1


def test_decontamination(spark, tables):
    got = _run(spark, tables, "op4_decontamination", "doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated")
    _same(got, X.contaminated(DOCS, X.benchmark_rows()))
    assert sum(r[-1] for r in got) > 20


def test_minhash(spark, tables):
    got = _run(spark, tables, "op5_minhash", "doc_id", "n_shingles", "component_id", "kept")
    _same(got, X.near_groups(DOCS, 2))
    assert sum(not r[-1] for r in got) > 15


def test_line_dedup(spark, tables):
    # doc_id 7 comes with two texts here, whose order within the id is that of a hash
    docs = [d for d in DOCS if d[0] != 7]
    got = X.rows_of(_lines(spark, docs), "doc_id", "_sk_lines", "_sk_removed", "text")
    _same(got, X.cut_lines(docs))
    assert sum(r[2] > 0 for r in got) > 10
    assert len(_run(spark, tables, "op6_line_dedup", "doc_id", "n_lines", "n_removed", "text")) == len(DOCS)


def _lines(spark, docs):
    from skyfold.llm.linededup import dedup_lines
    return dedup_lines(spark.createDataFrame(docs, "doc_id long, text string"))


def test_repeats(spark, tables):
    got = _run(spark, tables, "op7_repeats", "doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")
    _same(got, X.without_repeats(DOCS))
    assert sum(r[2] > 0 for r in got) > 20


def test_warc(spark, tables):
    import hashlib
    pages = [(p, (h or "").encode()) for p, _, h in X.page_rows()]
    first = {}
    for p, b in pages:
        if len(b) >= 100 and p is not None:
            first[b] = min(p, first.get(b, p))
    expected = []
    for p, b in pages:
        revisit = b in first and p != first[b]
        expected.append((p, len(b), hashlib.sha256(b).hexdigest(), "revisit" if revisit else "response", first[b] if revisit else None))
    _same(_run(spark, tables, "op2_warc", "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"), expected)


def test_sentencepiece_round_trip(spark, tables):
    got = _run(spark, tables, "op1_sentencepiece", "doc_id", "n_tokens", "token_ids", "round_trip")
    assert len(got) == len(DOCS)
    assert all(r[3] for r in got)
    assert all(r[1] == len(r[2] or []) for r in got)


def test_quality_rules(spark, tables):
    got = _run(spark, tables, "op9_quality_rules", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    expected = []
    for doc_id, text in DOCS:
        c = X.base_counts(text)
        expected.append((doc_id, *c, c[0] < 10 or 100 * c[4] > 20 * c[0]))
    _same(got, expected)
    kept = _run(spark, tables, "op9_quality_rules", "base_failed", "kept")
    assert not [r for r in kept if r[0] and r[1]]
    assert sum(r[1] for r in kept) > 60


def test_language_id(spark, tables):
    got = _run(spark, tables, "op8_language_id", "doc_id", "held_out", "lang_pred", "score")
    assert len(got) == len(DOCS)
    by_id = {r[0]: r for r in X.document_rows()}
    prose = [r for r in got if r[1] and r[0] is not None and r[0] < 80 and r[0] != 7]
    assert sum(r[2] == by_id[r[0]][2] for r in prose) >= 0.9 * len(prose)
    assert all(0 <= r[3] <= 1 for r in got)
    text = {r[0]: r[1] for r in X.document_rows()}
    for r in got:
        if r[0] is not None and r[0] != 7:
            assert (r[2] == "und") == (not any(c.isalpha() for c in text[r[0]] or ""))


def test_toxicity_scores(spark, tables):
    import zlib
    got = _run(spark, tables, "op10_toxicity", "doc_id", "held_out", "score", "predicted")
    assert len(got) == len(DOCS)
    for doc_id, held, score, predicted in got:
        assert held == (doc_id is not None and zlib.crc32(str(doc_id).encode()) % 5 == 0)
        assert 0 <= score <= 1 and predicted == int(score >= 0.5)


def test_importance_selects_the_share(spark, tables):
    got = _run(spark, tables, "op3_importance", "doc_id", "log_weight", "gumbel_key", "kept")
    assert len(got) == len(DOCS)
    assert not [r for r in got if r[1] is None and r[3]]
    low = max((r[2] for r in got if not r[3] and r[1] is not None), default=-1e9)
    assert min(r[2] for r in got if r[3]) >= low


def test_conversation_trie(spark, tables):
    got = _run(spark, tables, "op11_conversation_trie", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    _same(got, X.prefix_nodes(X.conversation_rows()))
    assert max(r[1] for r in got) >= 150 and max(r[3] for r in got) > 100


def test_bpe(spark, tables):
    import hashlib
    from tokenizers import Tokenizer
    from skyfold.llm.bpe import default_path
    library = Tokenizer.from_file(default_path())
    expected = []
    for doc_id, text in DOCS:
        ids = library.encode(text or "", add_special_tokens=False).ids
        joined = " ".join(map(str, ids)), library.decode(ids, skip_special_tokens=False)
        expected.append((doc_id, len(ids), *(hashlib.sha256(x.encode()).hexdigest() for x in joined)))
    _same(_run(spark, tables, "op12_bpe", "doc_id", "n_tokens", "ids_sha256", "decoded_sha256"), expected)


def test_filter_audit(spark, tables):
    got = _run(spark, tables, "op13_filter_audit", "part", "filter_order", "step", "kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost", "shapley")
    _same(got, X.filter_audit([(r[0], r[1], r[2]) for r in X.document_rows()], X.label_rows()))
    assert len(got) == 600 * len({r[2] or "" for r in X.document_rows()})


@pytest.mark.parametrize("name", sorted(x for x in E.queries() if x.startswith("op")) + ["pipeline"])
def test_empty_tables(spark, empty_tables, name):
    assert E.queries()[name](spark, empty_tables).collect() == []
