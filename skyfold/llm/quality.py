"""Operator 9, quality rules with perplexity bands of a modified Kneser-Ney model.

Base rules count words, symbols, repeated lines and repeated five-word
windows of a text. Texts that pass them are judged by n-gram models of the
corpus itself over the texts' bytes (``ORDER`` = 5, four start marks before a
text), so that a model's size depends on the language and not on the number of
documents.

No text is judged by a model that counted it: texts are dealt to two folds by a
hash of the text, so that exact copies share a fold, every language has a model of each fold, and
a text of one fold is scored by the model of the other, backing off to shorter
n-grams where it has not seen a longer one.

Counting: tasks count 5-grams of their rows, Spark sums them over all
documents; lower orders are continuation counts of distinct longer n-grams.
Discounts D1, D2, D3+ and interpolation weights follow modified Kneser-Ney and
are joined order by order in Spark, where the tables stay. Scoring takes them as
sorted arrays of keys (model, order and bytes packed in 64 bits: a hash without
collisions). The probability of a byte and all it may back off to depend on the
two bytes before it, whose mix deals the n-grams of order 3 and above to pieces
of about ``PIECE`` entries; n-grams of one and two bytes (65,792 a model at most) are in
every piece. One piece at a time goes through the driver to the tasks, which sum the bits
of its places in every text, and the sums of the pieces are added. A
corpus of more n-grams takes more passes, not more memory.

Bands: per language the quartiles of the held-out bits per byte over all texts that
pass the base rules, from a histogram of thousandths; a text is rejected outside
[q1 - SPREAD * iqr, q3 + SPREAD * iqr]. A mean over few bytes spreads more, so
the same fences are taken of (bits - median) * sqrt(bytes), in tenths within
+-CLIP, and a text is judged by the wider ones at its own length.

Defined cases: null or empty texts have no words and fail the base rules; a
null language is one of its own; a language without a text that passes has no
band; repeated rows are judged alike.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm import bytekit as bk
from skyfold.llm.store import Store

ORDER = 5
FOLDS = 2
#: Entries of one broadcast, 12 bytes each.
PIECE = 1 << 23
SPREAD, CLIP = 2.0, 1000.0
MIN_WORDS, MAX_REPEAT_PERCENT, WINDOW = 10, 20, 5
MAX_LANGUAGES = 1000
_FLUSH = 1 << 20
_SYMBOL = np.zeros(256, bool)
_SYMBOL[[ord(c) for c in "#*$%&|<>"]] = True
BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def _per_row(mask: np.ndarray, off: np.ndarray) -> np.ndarray:
    total = np.concatenate([[0], np.cumsum(mask)])
    return total[off[1:]] - total[off[:-1]]


def base_counts(buf: np.ndarray, off: np.ndarray) -> dict[str, np.ndarray]:
    rows = len(off) - 1
    solid = bk.NOT_SPACE[buf]
    prefix = bk.prefix_hash(buf)
    starts, ends, word_off = bk.row_runs(solid, off)
    out = {"n_words": np.diff(word_off), "word_chars": _per_row(solid & ((buf & 0xC0) != 0x80), off), "n_symbols": _per_row(_SYMBOL[buf], off)}

    # lines that hold a word, less the distinct ones among them
    cut = np.flatnonzero(buf == 10)
    line_start = np.unique(np.concatenate([off[:-1], cut + 1]))
    line_start = line_start[line_start < len(buf)]
    line_end = np.minimum(np.concatenate([line_start[1:], [len(buf)]]), len(buf)) if len(line_start) else line_start
    row = np.searchsorted(off, line_start, "right") - 1
    line_end = line_end - (buf[line_end - 1] == 10) if len(line_start) else line_end
    inside = np.concatenate([[0], np.cumsum(solid)])
    worded = inside[line_end] > inside[line_start]
    h, row = bk.span_hash(prefix, line_start[worded], line_end[worded]), row[worded]
    first = _first_of(row, h)
    out["n_dup_lines"] = np.bincount(row, minlength=rows) - np.bincount(row[first], minlength=rows)

    # words inside windows that come twice
    words = bk.span_hash(prefix, starts, ends)
    at = bk.gram_starts(word_off, WINDOW)
    of = np.searchsorted(word_off, at, "right") - 1
    key = bk.mix(bk.gram_hash(words, WINDOW)[at] ^ bk.mix(of.astype(np.uint64) + np.uint64(1)))
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    again = at[times[inverse] > 1]
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + WINDOW, -1)
    out["n_repeat_words"] = _per_row(np.cumsum(cover[:-1]) > 0, word_off)
    return out


def _first_of(row: np.ndarray, h: np.ndarray) -> np.ndarray:
    """One place of every distinct (row, hash)."""
    order = np.lexsort((h, row))
    r, x = row[order], h[order]
    return order[np.r_[True, (r[1:] != r[:-1]) | (x[1:] != x[:-1])]] if len(order) else order


def _grams(buf: np.ndarray, off: np.ndarray, lang: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The 5-gram that ends at each byte, as the language's number and five bytes, and the bytes' rows."""
    rows = np.repeat(np.arange(len(off) - 1), np.diff(off))
    place = np.arange(len(buf)) - off[:-1][rows]
    key = (lang[rows].astype(np.uint64) << np.uint64(40)) | buf
    for k in range(1, ORDER):
        back = np.zeros(len(buf), np.uint64)
        back[k:] = buf[:-k] if k < len(buf) else back[k:]
        key |= np.where(place >= k, back, np.uint64(0)) << np.uint64(8 * k)
    return key, rows


def _language() -> Column:
    return F.coalesce(F.col("lang").cast("string"), F.lit(""))


def languages(docs: DataFrame) -> list[str]:
    found = docs.select(_language().alias("l")).distinct().limit(MAX_LANGUAGES + 1).collect()
    if len(found) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return sorted(r[0] for r in found)


def _numbered(docs: DataFrame, langs: list[str]) -> DataFrame:
    """(doc_id, text, lang): FOLDS times the language's number plus the text's fold."""
    number = F.create_map(*[x for i, name in enumerate(langs) for x in (F.lit(name), F.lit(i))]) if langs else F.create_map(F.lit(""), F.lit(0))
    fold = F.pmod(F.xxhash64("text"), F.lit(FOLDS)).cast("int")
    return docs.select("doc_id", "text", (FOLDS * number[_language()] + fold).alias("lang"))


def other_fold(lang):
    """The model that scores texts of a numbered language and fold."""
    return lang ^ 1


def count_grams(docs: DataFrame) -> DataFrame:
    """(gram, n): 5-grams of all texts of (doc_id, text, lang number), with the language's number above the five bytes."""
    def run(batches):
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            buf, off = bk.text_bytes(batch)
            lang = batch.column(1).to_numpy(zero_copy_only=False)
            for i, j, part, part_off in bk.slices(buf, off):
                new, n = np.unique(_grams(part, part_off, lang[i:j])[0], return_counts=True)
                both, c = np.concatenate([keys, new]), np.concatenate([counts, n])
                order = np.argsort(both, kind="stable")
                both, c = both[order], c[order]
                first = np.flatnonzero(np.r_[True, both[1:] != both[:-1]]) if len(both) else np.zeros(0, np.int64)
                keys, counts = both[first], np.add.reduceat(c, first) if len(first) else c
                if len(keys) > _FLUSH:
                    yield _counted(keys, counts)
                    keys, counts = keys[:0], counts[:0]
        yield _counted(keys, counts)

    return bk.map_batches(docs.select("text", "lang"), run, "gram long, n long").groupBy("gram").agg(F.sum("n").alias("n"))


def _counted(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["gram", "n"])


def _discounts(n: dict[int, int]) -> list[float]:
    """D1, D2, D3+ from the numbers of n-grams that occur once to four times."""
    n1, n2, n3, n4 = (n.get(i, 0) for i in (1, 2, 3, 4))
    if not (n1 and n2 and n3):
        return [0.5, 1.0, 1.5]
    y = n1 / (n1 + 2 * n2)
    return [min(max(d, 0.05), i - 0.05) for i, d in ((1, 1 - 2 * y * n2 / n1), (2, 2 - 3 * y * n3 / n2), (3, 3 - 4 * y * n4 / n3))]


def kneser_ney(store: Store, counts: DataFrame) -> list[tuple[DataFrame, DataFrame]]:
    """For the orders 1 to ORDER: (lang, gram, p) of the seen n-grams and (lang, gram, weight) of their contexts."""
    tables = [store.keep(counts.select((F.shiftright("gram", 40)).cast("int").alias("lang"), F.col("gram").bitwiseAND(F.lit((1 << 40) - 1)).alias("gram"), "n"))]
    for k in range(ORDER - 1, 0, -1):
        shorter = F.col("gram").bitwiseAND(F.lit((1 << (8 * k)) - 1))
        tables.append(store.keep(tables[-1].groupBy("lang", shorter.alias("gram")).agg(F.count("*").alias("n"))))
    out: list[tuple[DataFrame, DataFrame]] = []
    for k, table in enumerate(reversed(tables), 1):
        small: dict[int, dict[int, int]] = {}
        for lang, n, times in table.where("n <= 4").groupBy("lang", "n").count().collect():
            small.setdefault(lang, {})[n] = times
        d = {lang: _discounts(n) for lang, n in small.items()}
        rows = [(lang, *d.get(lang, [0.5, 1.0, 1.5])) for lang in {r[0] for r in table.select("lang").distinct().collect()}]
        less = F.broadcast(store.spark.createDataFrame(rows, "lang int, d1 double, d2 double, d3 double"))      # one row a language
        c = table.join(less, "lang").withColumn("d", F.when(F.col("n") == 1, F.col("d1")).when(F.col("n") == 2, F.col("d2")).otherwise(F.col("d3"))) \
                 .withColumn("context", F.shiftright("gram", 8))
        contexts = c.groupBy("lang", "context").agg(F.sum("n").alias("total"), F.sum("d").alias("less")) \
                    .select("lang", "context", "total", (F.col("less") / F.col("total")).alias("weight"))
        contexts = store.keep(contexts)
        p = c.join(contexts, ["lang", "context"]).withColumn("own", (F.col("n") - F.col("d")) / F.col("total"))
        if k == 1:
            p = p.select("lang", "gram", (F.col("own") + F.col("weight") / 256).alias("p"))
        else:
            lower = out[-1][0].select("lang", F.col("gram").alias("shorter"), F.col("p").alias("below"))
            shorter = F.col("gram").bitwiseAND(F.lit((1 << (8 * (k - 1))) - 1))
            p = p.withColumn("shorter", shorter).join(lower, ["lang", "shorter"]).select("lang", "gram", (F.col("own") + F.col("weight") * F.col("below")).alias("p"))
        out.append((store.keep(p), contexts.select("lang", F.col("context").alias("gram"), "weight")))
    return out


_WEIGHT = 8
#: The mix that deals the pairs of bytes to pieces (models below 2^15).
MIX, SHIFT = 2654435761, 20


def _key(lang, order, gram):
    """Model, order (plus _WEIGHT for a context's weight) and bytes in 64 bits."""
    return (lang << 44) | (order << 40) | gram


def _shard(lang, gram):
    """A mix of the model and the last two bytes (``entries`` does the same in columns)."""
    return (lang * 65536 + gram % 65536) * MIX >> SHIFT


class HashArrays:
    """Sorted keys of n-grams with a value each."""

    def __init__(self, keys: np.ndarray, values: np.ndarray) -> None:
        order = np.argsort(keys)
        self.keys, self.values = keys[order], values[order].astype(np.float32)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The values; nan where there is none."""
        if not len(self.keys):
            return np.full(len(keys), np.nan, np.float32)
        at = np.minimum(np.searchsorted(self.keys, keys), len(self.keys) - 1)
        return np.where(self.keys[at] == keys, self.values[at], np.float32(np.nan))


class Model:
    """Log probabilities of n-grams of all orders and log weights of their contexts: the
    ``part``-th of ``parts`` pieces, which scores the places that it ``owns``, seen or not."""

    def __init__(self, entries: DataFrame, part: int = 0, parts: int = 1) -> None:
        mine = entries.where(F.col("shard").isNull() | (F.col("shard") % parts == part)).select("key", "v").toArrow()
        self.part, self.parts = part, parts
        self.table = HashArrays(mine.column("key").to_numpy(), mine.column("v").to_numpy())

    def owns(self, grams: np.ndarray) -> np.ndarray:
        return _shard(grams >> 40, grams >> 8) % self.parts == self.part

    def log_p(self, grams: np.ndarray) -> np.ndarray:
        """Natural log probability of the last byte of each 5-gram (as ``_grams`` makes them)."""
        lang, gram = grams >> 40, grams & ((1 << 40) - 1)
        out = np.zeros(len(grams))
        open_ = np.arange(len(grams))
        for k in range(ORDER, 0, -1):
            g = gram[open_] & ((1 << (8 * k)) - 1)
            found = self.table.find(_key(lang[open_], k, g))
            hit = ~np.isnan(found)
            out[open_[hit]] += found[hit]
            open_, g = open_[~hit], g[~hit]
            if not len(open_):
                return out
            weight = self.table.find(_key(lang[open_], k + _WEIGHT, g >> 8))
            out[open_] += np.where(np.isnan(weight), 0.0, weight)
        out[open_] += np.log(1 / 256)
        return out


def entries(orders: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(key, v, shard) of the n-grams and contexts of all orders; no shard for what every piece holds."""
    out = None
    for k, (p, weight) in enumerate(orders, 1):
        for table, value, order, before in ((p, "p", k, 8), (weight, "weight", k + _WEIGHT, 0)):
            lang, gram = F.col("lang").cast("long"), F.col("gram")
            key = F.shiftleft(lang, 44).bitwiseOR(F.lit(order << 40)).bitwiseOR(gram)
            two = F.shiftright(gram, before).bitwiseAND(F.lit(65535))
            shard = F.shiftright((lang * 65536 + two) * MIX, SHIFT) if k > 2 else F.lit(None).cast("long")
            part = table.select(key.alias("key"), F.log(value).cast("float").alias("v"), shard.alias("shard"))
            out = part if out is None else out.unionByName(part)
    return out


def _pieces(store: Store, orders: list[tuple[DataFrame, DataFrame]]) -> Iterator[tuple[int, Model]]:
    """The number of pieces and one piece after another of the models."""
    table = store.keep(entries(orders))
    n = max(1, -(-table.count() // PIECE))
    for i in range(n):
        yield n, Model(table, i, n)


def _bits(batch: pa.RecordBatch, i: int, j: int, part: np.ndarray, part_off: np.ndarray, model: Model) -> pa.Array:
    """Of each row, the sum of the bits of the places that ``model`` owns."""
    grams, rows = _grams(part, part_off, other_fold(batch.column(2).slice(i, j - i).to_numpy(zero_copy_only=False)))
    grams = grams.view(np.int64)
    if model.parts > 1:
        own = model.owns(grams)
        grams, rows = grams[own], rows[own]
    bits = model.log_p(grams) / -np.log(2)
    return pa.array(np.bincount(rows, bits, j - i))


def measure(store: Store, docs: DataFrame, orders: list[tuple[DataFrame, DataFrame]]) -> DataFrame:
    """(doc_id, lang, base counts, n_bytes, bits): held-out bits per byte.

    With one piece of the models the texts are read once; with more, once for the base counts and once a
    piece, and the sums are joined by language and 128-bit hash of the text."""
    names = ["doc_id", "lang", *BASE, "n_bytes"]
    kinds = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, lang int, " + ", ".join(f"{c} long" for c in BASE) + ", n_bytes long"
    texts = docs.select("doc_id", "text", "lang")

    def scan(base: bool, shared=None):
        def run(batches):
            for batch in batches:
                buf, off = bk.text_bytes(batch)
                for i, j, part, part_off in bk.slices(buf, off):
                    n = np.diff(part_off)
                    cols, header = [batch.column(2).slice(i, j - i)], ["lang"]
                    if base:
                        counts = base_counts(part, part_off)
                        cols = [batch.column(0).slice(i, j - i), *cols, *(pa.array(counts[c].astype(np.int64)) for c in BASE), pa.array(n)]
                        header = list(names)
                    if not (base and shared):
                        raw = part.tobytes()
                        cols.append(pa.array([xxhash.xxh3_128_digest(raw[s:e]) for s, e in zip(part_off[:-1].tolist(), part_off[1:].tolist())], pa.binary()))
                        header.append("text_key")
                    if shared:
                        cols.append(_bits(batch, i, j, part, part_off, shared.value))
                        header.append("sum")
                    yield pa.RecordBatch.from_arrays(cols, names=header)

        schema = [kinds if base else "lang int", *([] if base and shared else ["text_key binary"]), *(["sum double"] if shared else [])]
        return bk.map_batches(texts, run, ", ".join(schema))

    parts = None
    for n, model in _pieces(store, orders):
        shared = store.spark.sparkContext.broadcast(model)
        del model
        out = store.keep(scan(n == 1, shared) if n == 1 else scan(False, shared).dropDuplicates(["lang", "text_key"]))
        shared.destroy()
        parts = out if parts is None else parts.unionByName(out)
    if n > 1:
        total = parts.groupBy("lang", "text_key").agg(F.sum("sum").alias("sum"))
        parts = scan(True).join(total, ["lang", "text_key"])
    return parts.select(*names, (F.col("sum") / _size()).alias("bits"))


def _size() -> Column:
    return F.greatest(F.col("n_bytes"), F.lit(1))


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))


def _quartiles(good: DataFrame, value: Column, unit: float) -> dict[int, tuple[float, float, float]]:
    """Per language the quartiles of a value, from a histogram of its rounded units."""
    hist: dict[int, list[tuple[int, int]]] = {}
    for lang, at, n in good.groupBy("lang", F.round(value / unit).cast("long").alias("bin")).count().orderBy("lang", "bin").collect():
        hist.setdefault(lang, []).append((at, n))
    out = {}
    for lang, bins in hist.items():
        at, upto = np.array([b for b, _ in bins]), np.cumsum([n for _, n in bins])
        out[lang] = tuple(float(at[np.searchsorted(upto, q * upto[-1])] * unit) for q in (0.25, 0.5, 0.75))
    return out


def _fences(q1: float, q3: float) -> tuple[float, float]:
    return q1 - SPREAD * (q3 - q1), q3 + SPREAD * (q3 - q1)


def bands(store: Store, measured: DataFrame) -> DataFrame:
    """(lang, low, high, middle, low_root, high_root) from the texts that pass the base rules, one row a language."""
    good = measured.where(~base_failed()).select("lang", "bits", "n_bytes")
    whole = _quartiles(good, F.col("bits"), 0.001)
    middle = F.broadcast(store.spark.createDataFrame([(x, q[1]) for x, q in whole.items()], "lang int, middle double"))
    apart = (F.col("bits") - F.col("middle")) * F.sqrt(_size())
    rooted = _quartiles(good.join(middle, "lang"), F.greatest(F.least(apart, F.lit(CLIP)), F.lit(-CLIP)), 0.1)
    rows = [(x, *_fences(q[0], q[2]), q[1], *_fences(rooted[x][0], rooted[x][2])) for x, q in whole.items()]
    return store.spark.createDataFrame(rows, "lang int, low double, high double, middle double, low_root double, high_root double")


def judge(store: Store, docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, the base counts, base_failed, kept, bits_per_byte."""
    numbered = _numbered(docs, languages(docs))
    measured = store.keep(measure(store, numbered, kneser_ney(store, count_grams(numbered)))
                          .withColumn("lang", F.floor(F.col("lang") / FOLDS).cast("int")))
    root = F.sqrt(_size())
    inside = F.col("bits").between(F.least(F.col("low"), F.col("middle") + F.col("low_root") / root),
                                   F.greatest(F.col("high"), F.col("middle") + F.col("high_root") / root))
    return measured.join(F.broadcast(bands(store, measured)), "lang", "left").withColumn("base_failed", base_failed()).select(
        "doc_id", *BASE, "base_failed", (~F.col("base_failed") & F.coalesce(inside, F.lit(True))).alias("kept"), F.col("bits").alias("bits_per_byte"))
