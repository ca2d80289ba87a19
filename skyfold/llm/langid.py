"""Operator 8, language identification by segmentation-marginalised unigrams.

The pieces of a fixed public vocabulary (and the 256 single bytes) have one
probability per language. The probability of a word under a language is the
sum over all its segmentations into pieces, found by the forward algorithm;
a text's score is the sum of its words' logarithms, and the languages' scores
give posteriors. The probabilities are learned by expectation maximisation:
forward and backward sums give each piece's expected count, smoothed with the
pooled distribution of all languages.

Words are whitespace-separated, read with a leading space as the vocabulary
does; words longer than ``WORD_BYTES`` are read in parts. A slice's distinct
words are worked on at once, place by place, in numpy.

Training reads a bounded sample: about ``SAMPLE_PER_LANG`` documents of each
language, those of least hash. Prediction reads every whole text and nothing
but the text.

Defined cases: a text that is null or has no letter is ``und`` with score 0;
rows of null lang teach nothing; without training rows every text is ``und``;
equal scores go to the alphabetically first language; a null doc_id is not
held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm import bytekit as bk
from skyfold.llm.names import free_names
from skyfold.llm.pieces import MODEL, Vocabulary
from skyfold.llm.store import Store

SAMPLE_PER_LANG = 2500
ROUNDS = 3
WORD_BYTES = 32
MAX_LANGUAGES = 1000
PRIOR = 200.0
FOLDS = 3
_CHUNK_CELLS = 4 << 20
#: Scores that a worker keeps of words it has seen, in each of two generations.
MEMO_CELLS = 3 << 20
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 1, F.lit(False))


@dataclass
class Pieces:
    """Sorted hashes of the vocabulary's pieces as bytes; the first 256 columns are the single bytes."""

    hashes: np.ndarray
    column: np.ndarray
    count: int
    longest: int
    start: np.ndarray

    @classmethod
    def load(cls, model: str = MODEL) -> Pieces:
        vocabulary = Vocabulary.load(model)
        ranked = sorted(vocabulary.pieces.items(), key=lambda x: -x[1][1])
        texts = [bytes([b]) for b in range(256)] + [p.encode() for p, _ in ranked if 1 < len(p.encode()) <= WORD_BYTES + 1]
        off = np.cumsum([0, *map(len, texts)])
        h = bk.span_hash(bk.prefix_hash(np.frombuffer(b"".join(texts), np.uint8)), off[:-1], off[1:])
        order = np.argsort(h)
        # before training: the rank of a piece, and little for a single byte
        start = 1.0 / (np.arange(len(texts)) + 20.0)
        start[:256] = 1e-4
        return cls(h[order], order, len(texts), int(np.diff(off).max()), start / start.sum())


@dataclass
class Arcs:
    """Pieces found in words: word, first and last + 1 place in it, piece; sorted by last place."""

    word: np.ndarray
    first: np.ndarray
    last: np.ndarray
    piece: np.ndarray
    length: np.ndarray      # of every word


def word_parts(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words (long ones in parts), and the row of each."""
    starts, ends, word_off = bk.row_runs(bk.NOT_SPACE[buf], off)
    row = np.repeat(np.arange(len(off) - 1), np.diff(word_off))
    parts = -(-(ends - starts) // WORD_BYTES)
    if len(parts) and parts.max() > 1:
        k = np.arange(parts.sum()) - np.repeat(np.cumsum(parts) - parts, parts)
        starts, ends, row = np.repeat(starts, parts) + k * WORD_BYTES, np.repeat(ends, parts), np.repeat(row, parts)
        ends = np.minimum(ends, starts + WORD_BYTES)
    return starts, ends, bk.span_hash(bk.prefix_hash(buf), starts, ends), row


def find_arcs(pieces: Pieces, buf: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> Arcs:
    """All pieces in the words, each read with a space before it."""
    length = ends - starts + 1
    off = np.concatenate([[0], np.cumsum(length)])
    text = np.full(off[-1], 32, np.uint8)
    inner = np.arange(off[-1]) - np.repeat(off[:-1], length)
    text[inner > 0] = buf[(np.repeat(starts - 1, length) + inner)[inner > 0]]
    prefix = bk.prefix_hash(text)
    word = np.repeat(np.arange(len(length)), length)
    left = np.repeat(off[1:], length) - np.arange(off[-1])
    found = []
    at = np.arange(off[-1])
    for n in range(1, min(pieces.longest, WORD_BYTES + 1) + 1):
        at = at[left[at] >= n]
        if not len(at):
            break
        h = bk.span_hash(prefix, at, at + n)
        k = np.minimum(np.searchsorted(pieces.hashes, h), len(pieces.hashes) - 1)
        hit = pieces.hashes[k] == h
        found.append((at[hit], np.full(int(hit.sum()), n), pieces.column[k[hit]]))
    pos, n, piece = (np.concatenate(x) for x in zip(*found))
    first = inner[pos]
    order = np.lexsort((word[pos], first + n))
    return Arcs(word[pos][order], first[order], (first + n)[order], piece[order], length)


def _sums(arcs: Arcs, p: np.ndarray, backward: bool) -> np.ndarray:
    """[place, word, language]: the summed probability of all segmentations up to (or from) each place."""
    words, places = len(arcs.length), int(arcs.length.max()) + 1
    out = np.zeros((places, words, p.shape[1]))
    near, far = (arcs.last, arcs.first) if backward else (arcs.first, arcs.last)
    if backward:
        out[arcs.length, np.arange(words)] = 1.0
        order = np.lexsort((arcs.word, far))
    else:
        out[0] = 1.0
        order = np.arange(len(far))
    cuts = np.searchsorted(far[order], np.arange(places + 1))
    for e in (range(places - 2, -1, -1) if backward else range(1, places)):
        k = order[cuts[e]:cuts[e + 1]]
        if len(k):
            w = arcs.word[k]
            new = np.flatnonzero(np.r_[True, w[1:] != w[:-1]])
            out[e, w[new]] += np.add.reduceat(out[near[k], w] * p[arcs.piece[k]], new, axis=0)
    return out


def log_probability(arcs: Arcs, p: np.ndarray) -> np.ndarray:
    """[word, language]."""
    return np.log(np.maximum(_sums(arcs, p, False)[arcs.length, np.arange(len(arcs.length))], 1e-300))


def expected_counts(arcs: Arcs, p: np.ndarray, times: np.ndarray) -> np.ndarray:
    """[piece, language]: expected uses of each piece in words that occur ``times`` [word, language]."""
    a, b = _sums(arcs, p, False), _sums(arcs, p, True)
    total = a[arcs.length, np.arange(len(arcs.length))]
    weight = times / np.maximum(total, 1e-300)
    use = a[arcs.first, arcs.word] * p[arcs.piece] * b[arcs.last, arcs.word] * weight[arcs.word]
    return np.stack([np.bincount(arcs.piece, use[:, k], len(p)) for k in range(p.shape[1])], axis=1)


def _distinct(buf: np.ndarray, off: np.ndarray, languages: int):
    """A slice's distinct words: starts, ends, for every word of the slice its number and row, words of a chunk, hashes."""
    starts, ends, h, row = word_parts(buf, off)
    words, index, inverse = np.unique(h, return_index=True, return_inverse=True)
    return starts[index], ends[index], inverse, row, max(1, _CHUNK_CELLS // ((WORD_BYTES + 2) * languages)), words


def training_sample(docs: DataFrame, per_lang: int = SAMPLE_PER_LANG) -> DataFrame:
    """(lang, text): about ``per_lang`` documents of every language, those of least hash."""
    rows = docs.where(F.col("lang").isNotNull() & F.col("text").isNotNull() & ~held_out(F.col("doc_id"))) \
               .select(F.col("lang").cast("string").alias("lang"), "text", F.xxhash64("doc_id", "text").alias("h"))
    # one count a language: as literals, so that no language's texts meet in one task
    sizes = rows.groupBy("lang").count().limit(MAX_LANGUAGES + 1).collect()
    if len(sizes) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    if not sizes:
        return rows.select("lang", "text")
    share = F.create_map(*[F.lit(x) for lang, n in sizes for x in (lang, per_lang / n)])[F.col("lang")]
    return rows.where(F.col("h") / F.lit(2.0 ** 63) < 2 * share - 1).select("lang", "text")


class WordScores:
    """Scores of words by their hash, for words that come again in later slices: two generations of
    sorted hashes of at most ``limit`` words each. Scores don't depend on what is kept."""

    def __init__(self, languages: int) -> None:
        self.limit = max(1, MEMO_CELLS // (languages + 1))
        self.empty = np.zeros(0, np.uint64), np.zeros((0, languages))
        self.young, self.old = self.empty, self.empty

    def look_up(self, words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """[word, language] of sorted distinct ``words``, and which of them are known."""
        scores, known = np.zeros((len(words), self.empty[1].shape[1])), np.zeros(len(words), bool)
        for hashes, kept in (self.old, self.young):
            if len(hashes):
                at = np.minimum(np.searchsorted(hashes, words), len(hashes) - 1)
                hit = hashes[at] == words
                scores[hit] = kept[at[hit]]
                known |= hit
        return scores, known

    def keep(self, words: np.ndarray, scores: np.ndarray) -> None:
        """Adds the words of a slice, known or not: those in use stay young."""
        if len(self.young[0]) + len(words) > self.limit:
            self.old, self.young = self.young, self.empty
        hashes, first = np.unique(np.concatenate([words, self.young[0]]), return_index=True)
        self.young = hashes, np.concatenate([scores, self.young[1]])[first]


@dataclass
class Model:
    languages: list[str]
    pieces: Pieces
    p: np.ndarray            # [piece, language]
    memo: WordScores | None = None

    def predict(self, buf: np.ndarray, off: np.ndarray) -> tuple[list[str], np.ndarray]:
        rows = len(off) - 1
        total = np.zeros((rows, len(self.languages)))
        starts, ends, inverse, row, chunk, words = _distinct(buf, off, len(self.languages))
        if len(starts) and self.languages:
            self.memo = self.memo or WordScores(len(self.languages))
            scores, known = self.memo.look_up(words)
            fresh = np.flatnonzero(~known)
            for i in range(0, len(fresh), chunk):
                k = fresh[i:i + chunk]
                scores[k] = log_probability(find_arcs(self.pieces, buf, starts[k], ends[k]), self.p)
            self.memo.keep(words, scores)
            new = np.flatnonzero(np.r_[True, row[1:] != row[:-1]])
            total[row[new]] = np.add.reduceat(scores[inverse], new, axis=0)
        known = np.add.reduceat(np.r_[_LETTER[buf], False], np.minimum(off[:-1], len(buf))) > 0 if rows else np.zeros(0, bool)
        known &= np.diff(off) > 0
        for r in np.flatnonzero(~known & (np.diff(off) > 0)):      # no ASCII letter: perhaps another
            known[r] = any(c.isalpha() for c in buf[off[r]:off[r + 1]].tobytes().decode())
        if not self.languages:
            return ["und"] * rows, np.zeros(rows)
        best = total.argmax(axis=1)
        odds = np.exp(total - total.max(axis=1, keepdims=True))
        score = odds[np.arange(rows), best] / odds.sum(axis=1)
        return [self.languages[b] if k else "und" for b, k in zip(best, known)], np.where(known, score, 0.0)


def fit(store: Store, docs: DataFrame, model: str = MODEL, per_lang: int = SAMPLE_PER_LANG) -> Model:
    """Learns the languages' piece probabilities from the rows that are not held out."""
    pieces = Pieces.load(model)
    sample = store.keep(training_sample(docs, per_lang))
    languages = sorted(r[0] for r in sample.select("lang").distinct().collect())
    p = np.repeat(pieces.start[:, None], len(languages), axis=1)
    number = {x: i for i, x in enumerate(languages)}
    for _ in range(ROUNDS if languages else 0):
        shared = sample.sparkSession.sparkContext.broadcast((pieces, p))

        def run(batches, shared=shared):
            pieces, p = shared.value
            counts = np.zeros(p.shape)
            for batch in batches:
                buf, off = bk.text_bytes(batch)
                lang = np.array([number[x] for x in batch.column(0).to_pylist()], np.int64)
                for i, j, part, part_off in bk.slices(buf, off):
                    starts, ends, inverse, row, chunk, _ = _distinct(part, part_off, len(languages))
                    times = np.bincount(inverse * len(languages) + lang[i:j][row], minlength=len(starts) * len(languages)).reshape(len(starts), -1)
                    for k in range(0, len(starts), chunk):
                        counts += expected_counts(find_arcs(pieces, part, starts[k:k + chunk], ends[k:k + chunk]), p, times[k:k + chunk])
            piece, which = np.nonzero(counts)
            yield pa.RecordBatch.from_arrays([pa.array(piece), pa.array(which), pa.array(counts[piece, which])], names=["piece", "lang", "n"])

        # pieces times languages, whatever the number of rows
        got = bk.map_batches(sample, run, "piece long, lang long, n double").groupBy("piece", "lang").agg(F.sum("n").alias("n")).toPandas()
        counts = np.zeros(p.shape)
        counts[got["piece"], got["lang"]] = got["n"]
        pooled = counts.sum(axis=1) + pieces.start * PRIOR
        pooled /= pooled.sum()
        p = (counts + PRIOR * pooled[:, None]) / (counts.sum(axis=0) + PRIOR)
    return Model(languages, pieces, p)


def identify(docs: DataFrame, model: Model) -> DataFrame:
    """``docs`` with ``_sk_lang`` and ``_sk_score`` as the last columns; the names get leading
    underscores where ``docs`` has such columns."""
    names = free_names(docs.columns, "_sk_lang", "_sk_score")
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        for batch in batches:
            buf, off = bk.text_bytes(batch)
            langs, scores = [], [np.zeros(0)]
            for _, _, part, part_off in bk.slices(buf, off):
                lang, score = shared.value.predict(part, part_off)
                langs += lang
                scores.append(score)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(langs, pa.string()), pa.array(np.concatenate(scores))],
                                             names=[*batch.schema.names, *names])

    return bk.map_batches(docs, run, docs.withColumns({names[0]: F.lit(""), names[1]: F.lit(0.0)}).schema)
