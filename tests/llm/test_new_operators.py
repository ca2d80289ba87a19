"""Operators 11 to 13 beyond their queries: general interfaces, awkward inputs, clashing names."""

import random

import numpy as np
import pytest

from skyfold.llm import audit, bpe, trie
from skyfold.llm.store import Store
from tests.llm import fixtures as X


@pytest.fixture(scope="module")
def encoder():
    return bpe.Encoder(bpe.Vocabulary.load())


def test_bpe_equals_the_library_on_odd_texts(encoder):
    from tokenizers import Tokenizer
    library = Tokenizer.from_file(bpe.default_path())
    strings = bpe.Vocabulary.load().strings()
    rng = random.Random(1)
    signs = [*"abcdefgh ABCSΣσς'srtlldmve  \n\t0123!#|<>éèüÖßİıé日本語ǅﬁ́İ\x00Å²Ⅷ\u0378\ua7cb\U00010d50", "<|endoftext|>", "<|startoftext|>", "\u2028", "\x85", "👩\u200d👩"]
    for _ in range(4000):
        text = "".join(rng.choice(signs) for _ in range(rng.randrange(30)))
        theirs = library.encode(text, add_special_tokens=False).ids
        ours = np.frombuffer(encoder.encode(text), np.int32).tolist()
        assert ours == theirs, text
        assert " ".join(strings[i] for i in ours) == library.decode(theirs, skip_special_tokens=False)


def test_bpe_merges_least_rank_first_and_leftmost():
    ids = {s: i for i, s in enumerate([*bpe.byte_signs(), *(s + "</w>" for s in bpe.byte_signs()), "aa", "aab</w>", "ab</w>"])}
    encoder = bpe.Encoder(bpe.Vocabulary(ids, [("a", "a"), ("a", "b</w>"), ("aa", "b</w>")], {}))
    names = {i: s for s, i in ids.items()}
    assert [names[i] for i in encoder.merged("aaab")] == ["aa", "ab</w>"]
    assert [names[i] for i in encoder.merged("aab")] == ["aab</w>"]


def test_bpe_cache_turns_over(encoder, monkeypatch):
    monkeypatch.setattr(bpe, "CACHE_WORDS", 5)
    text = " ".join(f"word{i % 13}" for i in range(200))
    fresh = bpe.Encoder(bpe.Vocabulary.load())
    assert fresh.encode(text) == fresh.encode(text) == encoder.encode(text)
    assert len(fresh.young) <= 6


def test_bpe_keeps_other_columns_and_null_ids(spark):
    docs = spark.createDataFrame([(1, "Hi there", 9, "z"), (None, None, None, None)], "doc_id long, text string, n_tokens int, _sk_x string")
    rows = bpe.decode(bpe.encode(docs)).collect()
    assert rows[0]["_sk_x"] == "z" and rows[0]["decoded"] == "hi</w> there</w>" and rows[0]["n_tokens"] == 2
    assert rows[1]["token_ids"] == [] and rows[1]["decoded"] == ""
    lost = spark.createDataFrame([(None,), ([0],)], "token_ids array<int>")
    assert [r["decoded"] for r in bpe.decode(lost).collect()] == [None, "!"]


def test_packed_fields_do_not_overflow(spark):
    rows = spark.createDataFrame([("p", 31, True, True, 2 ** 61), ("p", 1, True, False, 2 ** 61), ("p", 0, False, True, 3), ("q", 31, False, False, 1)] + [("p", 4, True, True, 1)] * 50,
                                 "part string, mask int, good boolean, toxic boolean, n long")
    got = {(r["part"], r["filter_order"], r["step"]): r for r in audit.audit(rows).collect()}
    assert len(got) == 1200
    last = got["p", "BCDEA", 5]
    assert (last["kept"], last["removed"], last["redundant"], last["unique_fails"], last["good_lost"], last["toxic_lost"]) == (3, 2 ** 61, 2 ** 61, 2 ** 61, 2 ** 61, 0)
    assert got["p", "CABDE", 1]["removed"] == 2 ** 61 + 50 and got["q", "EDCBA", 1]["removed"] == 1


def test_packed_sums_over_many_parts(spark, monkeypatch):
    monkeypatch.setattr(audit, "HELD", 3)
    rows = spark.range(400).selectExpr("cast(id % 40 as string) part", "cast(id % 32 as int) mask", "id % 3 = 0 good", "id % 5 = 0 toxic", "id n")
    got = {r["part"]: r for r in audit.audit(rows).where("filter_order = 'ABCDE' and step = 1").collect()}
    for p in range(40):
        own = [i for i in range(400) if i % 40 == p]
        assert got[str(p)]["removed"] == sum(i for i in own if i % 32 & 1) and got[str(p)]["kept"] == sum(i for i in own if not i % 32 & 1)


def _members(rng, n):
    return {c: tuple(rng.choice("ab") for _ in range(rng.choice((0, 1, 3, 17, 40)))) for c in range(n)}


@pytest.mark.parametrize("block", [4096, 16])
def test_trie_of_random_sequences(spark, monkeypatch, block):
    monkeypatch.setattr(trie, "BLOCK", block)
    monkeypatch.setattr(trie, "STEPS", 2)
    monkeypatch.setattr(trie, "PIECE", 7)
    members = _members(random.Random(block), 60)
    rows = spark.createDataFrame([(c, k + 1, b"r", x.encode(), 2) for c, v in members.items() for k, x in enumerate(v)], "conv_id long, pos long, role binary, text binary, chars long")
    ids = spark.createDataFrame([(c,) for c in members], "conv_id long")
    got = X.rows_of(trie.trie(Store(spark, "trie"), ids, rows), "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    # the brute force reads plain turns, where every conversation keeps its own; it knows no turnless ones
    plain = [(c, k, "r", x * 2) for c, v in members.items() for k, x in enumerate(v)]
    root = min(members)
    expected = [r[:2] + (root if r[1] == 1 else r[2],) + r[3:] for r in X.prefix_nodes(plain, share=1, heads=1) if r[1]]
    assert [r for r in got if r[1]] == sorted(expected, key=str)
    assert [r[:4] for r in got if not r[1]] == [(root, 0, None, len(members))]


def test_two_fattest(spark):
    got = spark.range(1, 40).selectExpr("id r").crossJoin(spark.range(0, 40).selectExpr("id l")).where("l < r")
    for r in got.select("l", "r", trie.two_fattest(*(got[c] for c in "lr")).alias("f")).collect():
        assert r["f"] == max(range(r["l"] + 1, r["r"] + 1), key=lambda x: (x & -x))


def test_sentencepiece_decodes_a_column_of_ids(spark):
    from skyfold.llm import pieces
    texts = ["Plain words", "", None, "▁ odd ▁▁ spaces  and\ttabs\r\n", "日本語 é \x00", "a" * 3000]
    docs = spark.createDataFrame(list(enumerate(texts)), "k int, text string")
    rows = pieces.decode(pieces.encode(docs)).orderBy("k").collect()
    assert [r["decoded"] for r in rows] == texts and all(r["round_trip"] for r in rows)


def test_sentencepiece_cache_turns_over(monkeypatch):
    from skyfold.llm import pieces
    whole = pieces.Encoder(pieces.Vocabulary.load())
    monkeypatch.setattr(pieces, "CACHE_WORDS", 4)
    small = pieces.Encoder(whole_vocabulary := pieces.Vocabulary.load())
    text = " ".join(f"word{i % 11}" for i in range(100))
    assert small.encode(text).tolist() == whole.encode(text).tolist() and len(small.cache) <= 5
    assert whole_vocabulary.pieces and small.encode_bytes(text)[1]


def test_language_scores_do_not_depend_on_what_is_kept(monkeypatch):
    import pyarrow as pa
    from skyfold.llm import bytekit as bk
    from skyfold.llm import langid
    pieces = langid.Pieces.load()
    rng = np.random.default_rng(3)
    p = rng.random((pieces.count, 3)) * pieces.start[:, None]
    texts = [X.prose(random.Random(k), 80, ("en", "fr", "de")[k % 3]) for k in range(12)]
    slices = [bk.text_bytes(pa.RecordBatch.from_arrays([pa.array(texts[i:i + 3])], names=["text"])) for i in range(0, 12, 3)]
    fresh = [langid.Model(["x", "y", "z"], pieces, p).predict(*part) for part in slices]
    for cells in (1 << 20, 400):
        monkeypatch.setattr(langid, "MEMO_CELLS", cells)
        model = langid.Model(["x", "y", "z"], pieces, p)
        for _ in range(2):
            for part, (langs, scores) in zip(slices, fresh):
                got = model.predict(*part)
                assert got[0] == langs and np.array_equal(got[1], scores)


def test_one_row_of_each_group_stays(spark):
    """Repeated ids with other texts, equal rows, null ids, and columns named like the operator's."""
    from skyfold.llm.minhash import keep_one
    rng = random.Random(6)
    a, b, c = (X.prose(rng, 60) for _ in range(3))
    near = X.edited(rng, a, 0.01)
    rows = [(3, a, 1), (None, near, 2), (None, b, 3), (5, near, 4), (5, near, 5), (5, c, 6), (9, c, 7), (None, "", 8), (5, None, 9), (5, None, 10), (6, "alone", 11), (6, "alone", 11)]
    docs = spark.createDataFrame(rows, "doc_id int, text string, k_set int")
    out = sorted(tuple(r) for r in keep_one(docs, 2).select("k_set", "doc_id").collect())
    assert keep_one(docs, 2).columns == docs.columns
    assert out == [(1, 3), (3, None), (6, 5), (8, None), (9, 5), (10, 5), (11, 6)]
    assert keep_one(docs.limit(0), 2).collect() == []
