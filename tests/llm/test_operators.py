"""Operators by themselves: small cases and properties."""

import math
import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from skyfold.llm import bytekit, decontaminate, importance, langid, linededup, minhash, pieces, quality, toxicity, warc
from skyfold.llm.store import Store
from tests.llm import fixtures as X


# ---- hashing of words and substrings

def test_span_hash_is_a_function_of_the_bytes():
    rng = random.Random(1)
    raw = bytes(rng.choice(b"ab") for _ in range(3000))
    p = bytekit.prefix_hash(np.frombuffer(raw, np.uint8))
    s = np.array([rng.randrange(2900) for _ in range(2000)])
    e = s + np.array([rng.randrange(1, 12) for _ in s])
    by_hash, by_bytes = {}, {}
    for h, a, b in zip(bytekit.span_hash(p, s, e).tolist(), s, e):
        assert by_hash.setdefault(h, raw[a:b]) == raw[a:b]
        assert by_bytes.setdefault(raw[a:b], h) == h


def test_slices_cover_all_rows_once():
    off = np.array([0, 5, 5, 5000, 5001, 9000, 9000])
    got = [(i, j) for i, j, _, _ in bytekit.slices(np.zeros(9000, np.uint8), off, 1000)]
    assert [i for i, _ in got] == [0] + [j for _, j in got[:-1]] and got[-1][1] == 6


# ---- 1 SentencePiece

def _best_by_force(vocabulary, text):
    best = [0.0] + [-math.inf] * len(text)
    for i in range(1, len(text) + 1):
        for j in range(i):
            if text[j:i] in vocabulary.pieces:
                best[i] = max(best[i], best[j] + vocabulary.pieces[text[j:i]][1])
        if text[i - 1] not in vocabulary.pieces:
            best[i] = max(best[i], best[i - 1] + vocabulary.unknown)
    return best[-1]


def test_viterbi_finds_the_best_score():
    rng = random.Random(2)
    vocabulary = pieces.Vocabulary.load()
    coder = pieces.Encoder(vocabulary)
    score = {i: s for i, s in vocabulary.pieces.values()}
    bytes_ = set(vocabulary.byte_ids)
    for n in (1, 5, 20, 60):
        for lang in X.SYLLABLES:
            text = X.prose(rng, n, lang, 5) + rng.choice(["", " ", "\n\n", "  ☃日", "\t"])
            ids = coder.encode(text).tolist()
            known = sum(score[i] for i in ids if i not in bytes_)
            text_of = coder.decode(np.array(ids)).decode()
            assert text_of == text
            unknown = [c for c in " " + text if c not in vocabulary.pieces]
            byte_chars = bytes(vocabulary.byte_ids.index(i) for i in ids if i in bytes_).decode()
            assert set(byte_chars) <= set(unknown)
            assert known + vocabulary.unknown * len(byte_chars) == pytest.approx(_best_by_force(vocabulary, " " + text), rel=1e-12)


def test_viterbi_prefers_the_longer_piece_of_equal_scores():
    vocabulary = pieces.Vocabulary({"a": (300, -1.0), "b": (301, -1.0), "ab": (302, -2.0), " ": (303, -1.0)}, list(range(256)))
    assert pieces.Encoder(vocabulary).encode("ab").tolist() == [303, 302]


# ---- 2 WARC

def test_archives_are_plain_zstandard_frames_with_the_dictionary_first(spark, tmp_path):
    import glob
    import struct
    import zstandard
    records = warc.plan_records(spark.createDataFrame(X.page_rows(), "page_id long, url string, html string")).repartition(2)
    warc.write_warc(records, str(tmp_path / "w"))
    files = glob.glob(str(tmp_path / "w" / "part-*"))
    assert len(files) == 2
    for f in files:
        raw = open(f, "rb").read()
        magic, length = struct.unpack("<II", raw[:8])
        assert magic == warc.DICTIONARY_FRAME
        dictionary = zstandard.ZstdCompressionDict(raw[8:8 + length])
        whole = zstandard.ZstdDecompressor(dict_data=dictionary).stream_reader(raw, read_across_frames=True).read()
        assert whole.count(b"WARC/1.1\r\nWARC-Type: ") == len(list(warc.archive_records(memoryview(raw))))
    back = {(r["page_id"], r["record_type"]): r for r in warc.read_warc(spark, str(tmp_path / "w")).collect()}
    assert back[208, "response"]["payload"] == b"z" * 300_000
    assert back[200, "response"]["payload"] == b"" and back[200, "response"]["url"] is None
    assert "\r" not in back[100, "revisit"]["url"]


def test_dictionary_without_enough_records(spark):
    few = warc.payloads(spark.createDataFrame([(1, "u", "abc")], "page_id long, url string, html string"))
    assert warc.train_dictionary(few) == b"abc"
    assert warc.train_dictionary(few.where("page_id = 2")) == b""


# ---- 4 suffix automaton

def test_suffix_automaton_knows_every_substring():
    rng = random.Random(4)
    items = [[rng.randrange(3) for _ in range(rng.randrange(1, 25))] for _ in range(8)]
    a = decontaminate.SuffixAutomaton()
    for w in items:
        a.add(w)
    for k, w in enumerate(items):
        a.mark(w, k)
    for _ in range(600):
        sub = [rng.randrange(3) for _ in range(rng.randrange(1, 8))]
        state = 0
        for x in sub:
            state = a.next[state].get(x, -1) if state >= 0 else -1
        holds = {k for k, w in enumerate(items) if any(w[i:i + len(sub)] == sub for i in range(len(w)))}
        assert (state >= 0) == bool(holds)
        if holds:
            assert a.items[state] == holds


def test_blocks_of_items_give_the_same_hits(spark):
    docs = spark.createDataFrame([(r[0], r[1]) for r in X.document_rows()], "doc_id long, text string")
    items = spark.createDataFrame(X.benchmark_rows(), "item_id long, text string")
    rows = [sorted(map(str, decontaminate.find_hits(docs, items, block_words=n).collect())) for n in (50, 10 ** 6)]
    assert rows[0] == rows[1]


# ---- 5 MinHash

def test_circulant_signatures_estimate_jaccard():
    rng = np.random.default_rng(6)
    universe = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    for share in (0.5, 0.8, 0.95):
        n = int(2000 * share * 2 / (1 + share))
        a, b = np.unique(universe[:2000]), np.unique(universe[2000 - n:4000 - n])
        sig = minhash.signatures(np.concatenate([a, b]), np.array([0, len(a), len(a) + len(b)]))
        real = len(np.intersect1d(a, b)) / len(np.union1d(a, b))
        assert abs((sig[0] == sig[1]).mean() - real) < 0.12


def test_a_coordinate_is_the_least_shifted_table_entry():
    values = np.arange(1, 40, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    sig = minhash.signatures(values, np.array([0, 39]))[0]
    table = minhash._table()[:minhash.UNIVERSE]
    place = (bytekit.mix(values * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(44)).astype(np.int64) & (minhash.UNIVERSE - 1)
    assert sig.tolist() == [int(table[(place + k) % minhash.UNIVERSE].min()) for k in range(minhash.BANDS * minhash.ROWS)]


def test_components_of_long_chains(spark):
    links = [(i.to_bytes(4, "big"), (i + 1).to_bytes(4, "big")) for i in random.Random(1).sample(range(300), 300) if i % 50 != 49]
    got = minhash.components(Store(spark, "chain"), spark.createDataFrame(links, "a binary, b binary")).collect()
    assert {(int.from_bytes(r["node"], "big"), int.from_bytes(r["component"], "big")) for r in got} == {(i, i // 50 * 50) for i in range(300)}


def test_links_between_components_of_one_bucket_are_found(spark, monkeypatch):
    """With few pivots a round, every pair across components has its turn."""
    monkeypatch.setattr(minhash, "PIVOTS", 2)
    monkeypatch.setattr(minhash, "LARGE", 3)
    monkeypatch.setattr(minhash, "BLOCK", 300)
    docs = [(r[0], r[1]) for r in X.document_rows()]
    got = X.rows_of(minhash.duplicate_groups(spark.createDataFrame(docs, "doc_id long, text string"), 2), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(X.near_groups(docs, 2), key=str)


def test_members_that_a_component_gets_later_are_compared(spark, monkeypatch):
    """p is compared with the large component before x, its only link, joins that; then they meet in one bucket."""
    def node(text):
        values, _ = minhash.shingle_sets(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), 1)
        return xxhash.xxh3_128_digest(values.tobytes())

    def words(a, b, name):
        return [f"{name}{i}" for i in range(a, b)]

    core = words(0, 100, "w")
    c = [" ".join(core + extra) for extra in ([], ["one"], ["two"])]
    name = min(map(node, c))
    x = next(t for k in range(99) if node(t := " ".join(core[10:] + words(0, 10, f"x{k}-"))) > name)      # the component keeps its name
    p = " ".join(core[20:] + x.split()[-10:] + words(0, 10, "p"))
    e = " ".join(words(0, 50, "e"))
    d = min((" ".join(words(0, 50, f"d{k}-")) for k in range(999)), key=node)      # the first of its buckets, like none of them
    assert node(d) < min(map(node, [*c, x, p, e]))
    apart = F.pmod(F.xxhash64(F.col("node"), F.col("bucket"), F.lit(0)), F.lit(2)) != 0      # no pivot in turn 0
    late = spark.range(1000, 1200).withColumnRenamed("id", "bucket").crossJoin(spark.createDataFrame([(node(p),), (node(x),)], "node binary")) \
                .where(apart).groupBy("bucket").count().where("count = 2").first()["bucket"]
    buckets = {t: [1, 2, 3, late] for t in c} | {x: [3, late], p: [2, late], e: [late], d: [3, late]}
    plan = {}
    for i, (text, mine) in enumerate(buckets.items()):
        sig = minhash.signatures(*minhash.shingle_sets(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text)]), 1))[0]
        plan[sig.tobytes()] = mine + [10_000 + 100 * i + k for k in range(minhash.BANDS - len(mine))]
    monkeypatch.setattr(minhash, "band_keys", lambda sig: np.array([plan[r.tobytes()] for r in sig], np.int64).reshape(-1, minhash.BANDS))
    monkeypatch.setattr(minhash, "PIVOTS", 2)
    monkeypatch.setattr(minhash, "LARGE", 3)
    docs = list(enumerate(buckets))
    got = X.rows_of(minhash.duplicate_groups(spark.createDataFrame(docs, "doc_id long, text string"), 1), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(X.near_groups(docs, 1), key=str)


# ---- 6 line dedup

def test_line_dedup_plan_is_native(spark):
    df = linededup.dedup_lines(spark.createDataFrame([(1, "a\nb\nc")], "doc_id long, text string"))
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not [x for x in ("Python", "Pandas", "Arrow", "CartesianProduct", "NestedLoop") if x in plan.replace("ArrowEvalPython", "Python")]


def test_line_dedup_merges_overlapping_windows(spark):
    rows = [(1, "a\nb\nc\nd\ne"), (2, "x\na\nb\nc\nd\ny"), (3, "a\nb\nz"), (4, "c\nd\ne\nc\nd\ne")]
    got = {r["doc_id"]: (r["text"], r["_sk_removed"]) for r in linededup.dedup_lines(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: (rows[0][1], 0), 2: ("x\ny", 4), 3: ("a\nb\nz", 0), 4: ("", 6)}


# ---- 8 language id

def _by_all_segmentations(p, word):
    if not word:
        return 1.0
    return sum(p[word[:n]] * _by_all_segmentations(p, word[n:]) for n in range(1, len(word) + 1) if word[:n] in p)


def test_forward_algorithm_sums_all_segmentations():
    model = langid.Pieces.load()
    text = b"the theater then a xq \xc3\xa9t\xc3\xa9"
    buf = np.frombuffer(text, np.uint8)
    starts, ends, _, _ = langid.word_parts(buf, np.array([0, len(text)]))
    arcs = langid.find_arcs(model, buf, starts, ends)
    p = np.stack([model.start, np.roll(model.start, 5)], axis=1)
    got = langid.log_probability(arcs, p)
    ranked = sorted(pieces.Vocabulary.load().pieces.items(), key=lambda x: -x[1][1])
    names = [bytes([b]) for b in range(256)] + [t.encode() for t, _ in ranked if 1 < len(t.encode()) <= langid.WORD_BYTES + 1]
    for w, (s, e) in enumerate(zip(starts, ends)):
        for k in range(2):
            table = {n: q for n, q in zip(names, p[:, k]) if len(n) <= 9}
            assert got[w, k] == pytest.approx(math.log(_by_all_segmentations(table, b" " + text[s:e])), abs=1e-9)


def test_expected_counts_cover_the_text():
    model = langid.Pieces.load()
    text = b"many different words in one place"
    buf = np.frombuffer(text, np.uint8)
    starts, ends, _, _ = langid.word_parts(buf, np.array([0, len(text)]))
    arcs = langid.find_arcs(model, buf, starts, ends)
    length = np.zeros(model.count)
    length[arcs.piece] = arcs.last - arcs.first
    counts = langid.expected_counts(arcs, model.start[:, None], np.full((len(starts), 1), 3.0))
    assert (counts[:, 0] * length).sum() == pytest.approx(3 * (len(text) + 1))


# ---- 9 Kneser-Ney

def test_kneser_ney_probabilities_sum_to_one(spark):
    rows = [(i, X.prose(random.Random(i), 40), i % 2) for i in range(20)]
    counts = quality.count_grams(spark.createDataFrame(rows, "doc_id long, text string, lang int"))
    model = quality.Model(quality.entries(quality.kneser_ney(Store(spark, "kn"), counts)))
    for context in (b"the ", b"\0\0\0\0", b"n ht", b"zzzz", b"\0\0th"):
        head = sum(b << (8 * (4 - k)) for k, b in enumerate(context))
        for lang in (0, 1):
            grams = np.array([(lang << 40) | head | b for b in range(256)])
            assert np.exp(model.log_p(grams)).sum() == pytest.approx(1.0, abs=1e-5)


def test_grams_do_not_cross_rows():
    buf = np.frombuffer(b"abcab", np.uint8)
    grams, rows = quality._grams(buf, np.array([0, 3, 3, 5]), np.array([0, 0, 1]))
    assert rows.tolist() == [0, 0, 0, 2, 2]
    assert [int(g) for g in grams] == [97, 97 << 8 | 98, 97 << 16 | 98 << 8 | 99, 1 << 40 | 97, 1 << 40 | 97 << 8 | 98]


def test_counts_cover_all_documents(spark):
    rows = [(i, X.prose(random.Random(i), 30), 0) for i in range(30)]
    total = quality.count_grams(spark.createDataFrame(rows, "doc_id long, text string, lang int").repartition(5)).agg(F.sum("n")).first()[0]
    assert total == sum(len(t.encode()) for _, t, _ in rows)


@pytest.mark.parametrize("piece", [1 << 23, 9_000])
def test_bands_against_brute_force(spark, monkeypatch, piece):
    """Held-out bits, bands and verdicts, with the models in one piece and in several."""
    monkeypatch.setattr(quality, "PIECE", piece)
    collected = []
    to_arrow = type(spark.range(0)).toArrow
    monkeypatch.setattr(type(spark.range(0)), "toArrow", lambda df: collected.append((t := to_arrow(df)).num_rows) or t)
    rng = random.Random(5)
    rows = [(i, X.prose(rng, rng.randrange(20, 150), lang), lang) for i, lang in enumerate(["en"] * 90 + ["de"] * 50)]
    rows += [(200 + i, " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz", k=7)) for _ in range(80)), "en") for i in range(6)]
    rows += [(300 + i, X.prose(rng, 100, "de"), "en") for i in range(4)]
    rows += [(400 + i, " ".join("o" * k for k in rng.sample(range(5, 150), 40)), "de") for i in range(8)]
    rows += [(500, "alone in its language there is this one text and no other", "xx"), (501, "", "en"), (502, None, None), (None, rows[3][1], "en"), rows[4], rows[4]]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    fold = [r[0] for r in docs.select(F.pmod(F.xxhash64("text"), F.lit(2))).collect()]
    got = {(r["doc_id"], r["base_failed"]): (r["kept"], r["bits_per_byte"]) for r in quality.judge(Store(spark, "own"), docs).collect()}
    if piece < 10_000:
        assert len(collected) > 2 and max(collected) < 2 * piece
    bits = X.held_out_bits([(t, lang) for _, t, lang in rows], fold)
    kept = X.within_bands([(t, lang, b) for (_, t, lang), b in zip(rows, bits)], quality.SPREAD)
    assert len(got) == len({r[0] for r in rows})
    for (doc_id, text, lang), b, k in zip(rows, bits, kept):
        c = X.base_counts(text)
        failed = c[0] < 10 or 100 * c[4] > 20 * c[0]
        assert got[doc_id, failed][1] == pytest.approx(b, rel=1e-5, abs=1e-9)
        assert got[doc_id, failed][0] == (k and not failed), (doc_id, b)
    verdict = {d: v for (d, _), v in got.items()}
    assert all(not verdict[200 + i][0] and verdict[200 + i][1] > 4 for i in range(6))       # random letters
    assert not any(verdict[300 + i][0] for i in range(4))                                   # another language
    assert not any(verdict[400 + i][0] for i in range(8))                                   # too predictable
    assert sum(verdict[i][0] for i in range(140)) >= 126 and verdict[500][0]


# ---- 10 toxicity

def test_label_model_finds_accuracies_and_a_dependence():
    rng = np.random.default_rng(8)
    y = rng.random(6000) < 0.3
    a = np.where(y, rng.random(6000) < 0.8, rng.random(6000) < 0.05)
    b = np.where(rng.random(6000) < 0.95, a, ~a)                  # a copy of a
    c = np.where(y, rng.random(6000) < 0.6, rng.random(6000) < 0.1)
    d = rng.random(6000) < 0.4                                    # tells nothing
    noisy = np.where(rng.random(6000) < 0.9, y, ~y).astype(int)
    model, q = toxicity.fit_label_model(np.stack([a, b, c, d], axis=1), noisy)
    assert model.parent[1] == 0
    assert ((q > 0.5) == y).mean() > (noisy == y).mean()
    assert model.prior == pytest.approx(0.3, abs=0.05)


def test_toxic_stems_are_mined(spark):
    rng = random.Random(11)
    docs, labels = [], []
    for i in range(600):
        toxic = i % 4 == 0
        text = X.prose(rng, 40)
        if toxic:
            words = text.split(" ")
            for _ in range(3):
                words.insert(rng.randrange(len(words)), "grubb" + rng.choice(X.SYLLABLES["de"].split()) + rng.choice("xyz"))
            text = " ".join(words)
        docs.append((i, text))
        labels.append((i, int(toxic)))
    docs = spark.createDataFrame(docs, "doc_id long, text string")
    classifier = toxicity.fit(Store(spark, "tox"), docs, spark.createDataFrame(labels, "doc_id long, toxic int"))
    got = toxicity.scores(docs, classifier).where(toxicity.held_out(F.col("doc_id"))).collect()
    right = [(r["_sk_score"] >= 0.5) == (r["doc_id"] % 4 == 0) for r in got]
    assert len(right) > 80 and sum(right) >= 0.97 * len(right)


def test_without_labels_the_fixed_lexicons_decide(spark):
    docs = spark.createDataFrame([(1, "you are an idiot and a moron"), (2, "a fine day"), (3, None)], "doc_id long, text string")
    classifier = toxicity.fit(Store(spark, "tox"), docs, spark.createDataFrame([], "doc_id long, toxic int"))
    assert {r["doc_id"]: r["_sk_score"] >= 0.5 for r in toxicity.scores(docs, classifier).collect()} == {1: True, 2: False, 3: False}


# ---- 3 importance resampling

def test_select_top_is_exact(spark):
    rng = random.Random(12)
    rows = [(i, rng.choice([rng.gauss(0, 50), 3.0, -2.5])) for i in range(3000)]
    df = spark.createDataFrame(rows, "doc_id long, key double").repartition(4)
    for k in (0, 1, 700, 1500, 2999, 3000):
        got = {r["doc_id"] for r in importance.select_top(df, "key", k).where("_sk_kept").collect()}
        assert got == {i for i, _ in sorted(rows, key=lambda r: (-r[1], r[0]))[:k]}


def test_selection_follows_importance(spark):
    rng = random.Random(13)
    good = [(i, X.prose(rng, 60, "en")) for i in range(200)]
    junk = [(i, X.prose(rng, 60, "de")) for i in range(200, 400)]
    labels = spark.createDataFrame([(i, int(i < 200)) for i in range(0, 400, 2)], "doc_id long, quality int")
    out = importance.resample(Store(spark, "imp"), spark.createDataFrame(good + junk, "doc_id long, text string"), labels).collect()
    kept = [r["doc_id"] for r in out if r["kept"]]
    assert len(kept) == 200 and sum(i < 200 for i in kept) > 180


def test_the_share_is_that_of_all_labelled_rows(spark, monkeypatch):
    monkeypatch.setattr(importance.good_rows, "__defaults__", (21,))      # an odd sample has no share of a half
    docs = [(i, X.prose(random.Random(i), 30)) for i in range(100)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(100)], "doc_id long, quality int")
    out = importance.resample(Store(spark, "share"), spark.createDataFrame(docs, "doc_id long, text string"), labels)
    assert out.where("kept").count() == 50
