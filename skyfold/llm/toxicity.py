"""Operator 10, toxicity by weak supervision.

1. Voters. Lexicon voters: fixed short lists of insults per language, and
   words and word beginnings mined from labelled rows, where they are far
   likelier in toxic texts. Pattern voters: shouting, rows of exclamation
   marks, insult next to a pronoun of the second person.
2. A generative label model estimates, without trusting any voter, how often
   each one fires under either label, and how voters depend on each other (a
   tree of the strongest conditional dependencies); rows' own labels enter as
   one more voter of unknown accuracy. Expectation maximisation gives
   posterior labels.
3. A linear classifier (ridge logistic regression) is trained on the posterior
   labels and scores every whole text.

The label model and the classifier are fitted on a bounded sample: the
``SAMPLE_ROWS`` labelled rows of least hash. Scoring reads all rows.

Defined cases: null or empty text has no vote and gets the score of such a
text; rows of one doc_id with several labels count as toxic if one says so;
without labelled rows of both kinds the fixed lexicons alone decide; a null
doc_id is never held out.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm import bytekit as bk
from skyfold.llm.names import free_names
from skyfold.llm.store import Store

SAMPLE_ROWS = 20_000
MINED, MIN_TOXIC, MIN_LOG_ODDS = 160, 5, 3.0
STEMS = (4, 5, 6)          # bytes of a word's beginning
FOLDS = 5
ROUNDS = 20
#: Common insults.
INSULTS = {
    "en": "idiot idiots moron morons stupid dumb trash scum loser losers pathetic worthless disgusting clown garbage imbecile filth jerk",
    "de": "idiot dummkopf trottel abschaum versager blödmann depp dreckskerl widerlich wertlos arschloch vollidiot",
    "fr": "idiot idiote imbécile crétin abruti ordure débile minable dégoûtant salaud connard raclure",
    "es": "idiota imbécil estúpido basura escoria perdedor patético asqueroso inútil payaso tonto gilipollas",
}
YOU = "you your youre du dich dein ihr tu toi ton vous votre tú eres usted vosotros"


def _hash_words(words: list[str]) -> np.ndarray:
    raw = [w.encode() for w in words]
    off = np.cumsum([0, *map(len, raw)])
    return np.unique(bk.span_hash(bk.prefix_hash(np.frombuffer(b"".join(raw), np.uint8)), off[:-1], off[1:]))


FIXED = [_hash_words(v.split()) for v in INSULTS.values()]
_ALL_INSULTS = np.unique(np.concatenate(FIXED))
_YOU = _hash_words(YOU.split())
PATTERNS = len(FIXED) + 4


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(FOLDS)) == 0, F.lit(False))


def _member(values: np.ndarray, of: np.ndarray) -> np.ndarray:
    if not len(of):
        return np.zeros(len(values), bool)
    return of[np.minimum(np.searchsorted(of, values), len(of) - 1)] == values


def _tokens(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Word hashes and offsets; hashes of words and of their beginnings with the word each belongs to."""
    low = bk.LOWER[buf]
    starts, ends, word_off = bk.row_runs(bk.ALNUM[low], off)
    prefix = bk.prefix_hash(low)
    words = bk.span_hash(prefix, starts, ends)
    feats, of = [words], [np.arange(len(words))]
    for n in STEMS:
        long = np.flatnonzero(ends - starts > n)
        # a beginning is not the word of the same letters
        feats.append(bk.mix(bk.span_hash(prefix, starts[long], starts[long] + n) + np.uint64(n)))
        of.append(long)
    return words, word_off, np.concatenate(feats), np.concatenate(of)


def _pattern_votes(buf: np.ndarray, off: np.ndarray, words: np.ndarray, word_off: np.ndarray) -> np.ndarray:
    """One column per fixed voter: the lexicons, insult near a second person, two insults, shouting, exclamations."""
    n = len(off) - 1
    row = np.repeat(np.arange(n), np.diff(word_off))

    def share(mask):
        return np.bincount(np.repeat(np.arange(n), np.diff(off))[mask], minlength=n)

    insult, you = _member(words, _ALL_INSULTS), _member(words, _YOU)
    near = np.zeros(len(words), bool)
    for k in (1, 2, 3):
        same = row[k:] == row[:-k]
        near[k:] |= insult[k:] & you[:-k] & same
        near[:-k] |= insult[:-k] & you[k:] & same
    upper = share((buf >= 65) & (buf <= 90))
    letters = upper + share((buf >= 97) & (buf <= 122))
    marks = share(buf == 33)
    cols = [np.bincount(row[_member(words, lex)], minlength=n) > 0 for lex in FIXED]
    cols += [np.bincount(row[near], minlength=n) > 0, np.bincount(row[insult], minlength=n) > 1,
             (letters > 20) & (2 * upper > letters), 20 * marks > np.maximum(np.diff(word_off), 20)]
    return np.stack(cols, axis=1)


def _mined_votes(feats: np.ndarray, of: np.ndarray, word_off: np.ndarray, mined: np.ndarray) -> np.ndarray:
    n, out = len(word_off) - 1, np.zeros((len(word_off) - 1, len(mined)), bool)
    if len(mined) and len(feats):
        at = np.minimum(np.searchsorted(mined, feats), len(mined) - 1)
        hit = np.flatnonzero(mined[at] == feats)
        rows = np.searchsorted(word_off, of[hit], "right") - 1
        out[np.minimum(rows, n - 1), at[hit]] = True
    return out


def votes(buf: np.ndarray, off: np.ndarray, mined: np.ndarray) -> np.ndarray:
    words, word_off, feats, of = _tokens(buf, off)
    return np.concatenate([_pattern_votes(buf, off, words, word_off), _mined_votes(feats, of, word_off, mined)], axis=1)


def _document_counts(train: DataFrame, among: np.ndarray | None) -> DataFrame:
    """(feature, n): in how many texts of ``train`` a word or beginning occurs; only those of ``among`` if given."""
    shared = train.sparkSession.sparkContext.broadcast(among)

    def run(batches):
        keys, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            buf, off = bk.text_bytes(batch)
            for _, _, part, part_off in bk.slices(buf, off):
                _, word_off, feats, of = _tokens(part, part_off)
                if shared.value is not None:
                    keep = _member(feats, shared.value)
                    feats, of = feats[keep], of[keep]
                row = np.searchsorted(word_off, of, "right") - 1
                order = np.lexsort((feats, row))
                f, r = feats[order], row[order]
                once = f[np.r_[True, (f[1:] != f[:-1]) | (r[1:] != r[:-1])]] if len(f) else f
                new, n = np.unique(once, return_counts=True)
                merged, inverse = np.unique(np.concatenate([keys, new]), return_inverse=True)
                keys, counts = merged, np.bincount(inverse, np.concatenate([counts, n]), len(merged)).astype(np.int64)
                if len(keys) > 1 << 19:
                    yield _counted(keys, counts)
                    keys, counts = keys[:0], counts[:0]
        yield _counted(keys, counts)

    return bk.map_batches(train.select("text"), run, "feature long, n long").groupBy("feature").agg(F.sum("n").alias("n"))


def _counted(keys: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], names=["feature", "n"])


def mine(train: DataFrame, n_toxic: int, n_clean: int) -> np.ndarray:
    """Up to MINED words and beginnings, the surest first, that are far likelier in toxic texts."""
    toxic = _document_counts(train.where("toxic = 1"), None).where(F.col("n") >= MIN_TOXIC)
    spread = lambda n, all_: F.log((n + 0.5) / (F.lit(float(all_)) - n + 0.5))
    # texts of both kinds are counted for those features alone that toxic texts hold often; the strongest are few
    top = toxic.orderBy(F.desc("n"), "feature").limit(20_000).toPandas()
    among = np.sort(top["feature"].to_numpy(np.int64).view(np.uint64))
    clean = _document_counts(train.where("toxic = 0"), among)
    both = train.sparkSession.createDataFrame(top.assign(feature=top["feature"].astype("int64"), n=top["n"].astype("int64")), "feature long, n long") \
                .join(clean.withColumnRenamed("n", "m"), "feature", "left").fillna(0, ["m"])
    odds = spread(F.col("n"), n_toxic) - spread(F.col("m"), n_clean)
    error = F.sqrt(1 / (F.col("n") + 0.5) + 1 / (F.col("m") + 0.5))
    best = both.withColumn("odds", odds).withColumn("z", F.col("odds") / error).where(F.col("odds") >= MIN_LOG_ODDS) \
               .orderBy(F.desc(F.col("n") * F.col("odds")), "feature").limit(MINED)
    return np.sort(best.select("feature").toPandas()["feature"].to_numpy(np.int64).view(np.uint64))


@dataclass
class LabelModel:
    """P(label) and, per voter, P(vote | label, vote of its parent in the tree of dependencies)."""

    prior: float
    parent: np.ndarray        # -1: none
    fires: np.ndarray         # [label, parent's vote, voter]

    def log_odds(self, v: np.ndarray) -> np.ndarray:
        up = np.where(self.parent >= 0, v[:, np.maximum(self.parent, 0)], 0)
        out = np.full(len(v), np.log(self.prior / (1 - self.prior)))
        voter = np.arange(v.shape[1])
        for sign, label in ((1, 1), (-1, 0)):
            p = self.fires[label][up, voter]
            out += sign * np.log(np.where(v, p, 1 - p)).sum(axis=1)
        return out


def _tree(v: np.ndarray, q: np.ndarray) -> np.ndarray:
    """Maximum spanning tree of the voters' mutual information given the label."""
    n = v.shape[1]
    info = np.zeros((n, n))
    for w in (q, 1 - q):
        total = w.sum() + 1e-9
        both = (v * w[:, None]).T @ v / total
        one = (v * w[:, None]).sum(axis=0) / total
        for a, pa_ in ((1, one), (0, 1 - one)):
            for b, pb in ((1, one), (0, 1 - one)):
                joint = {(1, 1): both, (1, 0): one[:, None] - both, (0, 1): one[None, :] - both, (0, 0): 1 - one[:, None] - one[None, :] + both}[a, b]
                joint = np.maximum(joint, 1e-12)
                info += total / len(v) * joint * np.log(joint / np.maximum(pa_[:, None] * pb[None, :], 1e-12))
    parent, best, near = np.full(n, -1), np.full(n, -np.inf), np.zeros(n, int)
    inside = np.zeros(n, bool)
    at = 0
    for _ in range(n - 1):
        inside[at] = True
        better = ~inside & (info[at] > best)
        best[better], near[better] = info[at][better], at
        at = int(np.argmax(np.where(inside, -np.inf, best)))
        parent[at] = near[at]
    return parent


def fit_label_model(v: np.ndarray, label: np.ndarray) -> tuple[LabelModel, np.ndarray]:
    """The model and the rows' posterior labels, by expectation maximisation from the given labels."""
    v = v.astype(np.float64)
    q = np.where(label == 1, 0.9, 0.1)
    for step in range(ROUNDS):
        if step in (0, ROUNDS // 2):
            parent = _tree(v, q)
        up = np.where(parent >= 0, v[:, np.maximum(parent, 0)], 0.0)
        fires = np.zeros((2, 2, v.shape[1]))
        for y, w in ((1, q), (0, 1 - q)):
            for u in (0, 1):
                wu = w[:, None] * (up == u)
                fires[y, u] = ((wu * v).sum(axis=0) + 0.5) / (wu.sum(axis=0) + 1.0)
        model = LabelModel(float(np.clip(q.mean(), 1e-4, 1 - 1e-4)), parent, fires)
        odds = model.log_odds(v.astype(int))
        # the row's own label as a voter, as accurate as the other voters find it
        others = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        right = np.clip(np.where(label == 1, others, 1 - others).mean(), 0.6, 0.98)
        odds = odds + np.where(label == 1, 1, -1) * np.log(right / (1 - right))
        q = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
    return model, q


def fit_linear(v: np.ndarray, q: np.ndarray, ridge: float = 0.3) -> np.ndarray:
    """Weights and, last, the bias of a logistic regression on soft labels (Newton's method)."""
    x = np.concatenate([v.astype(np.float64), np.ones((len(v), 1))], axis=1)
    w, penalty = np.zeros(x.shape[1]), np.full(x.shape[1], ridge)
    penalty[-1] = 1e-3
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - q) + penalty * w
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + np.diag(penalty), gradient)
        w -= step
        if np.abs(step).max() < 1e-6:
            break
    return w


def _fixed_weights() -> np.ndarray:
    return np.array([5.0] * len(FIXED) + [1.0, 1.0, 0.0, 0.0, -2.5])


@dataclass
class Classifier:
    mined: np.ndarray
    weights: np.ndarray

    def score(self, buf: np.ndarray, off: np.ndarray) -> np.ndarray:
        return 1 / (1 + np.exp(-np.clip(votes(buf, off, self.mined) @ self.weights[:-1] + self.weights[-1], -30, 30)))


def training_sample(docs: DataFrame, labels: DataFrame, sample_rows: int) -> DataFrame:
    """(text, toxic) of the ``sample_rows`` labelled documents of least hash that are not held out."""
    known = labels.where(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id"))) \
                  .groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_rows)
    # the sample's ids are few by construction, so they go to every task
    return docs.select("doc_id", "text").join(F.broadcast(known), "doc_id") \
               .select("text", F.when(F.col("toxic") > 0, 1).otherwise(0).alias("toxic"))


def fit(store: Store, docs: DataFrame, labels: DataFrame, sample_rows: int = SAMPLE_ROWS) -> Classifier:
    """Mines the lexicons, fits the label model and trains the classifier on its posterior labels."""
    sample = store.keep(training_sample(docs, labels, sample_rows))
    sizes = {r[0]: r[1] for r in sample.groupBy("toxic").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Classifier(np.zeros(0, np.uint64), _fixed_weights())
    mined = mine(sample, sizes[1], sizes[0])
    shared = sample.sparkSession.sparkContext.broadcast(mined)

    def run(batches):
        for batch in batches:
            buf, off = bk.text_bytes(batch)
            for i, j, part, part_off in bk.slices(buf, off):
                v = np.packbits(votes(part, part_off, shared.value), axis=1)
                yield pa.RecordBatch.from_arrays([pa.array([r.tobytes() for r in v], pa.binary()), batch.column(1).slice(i, j - i)], names=["v", "toxic"])

    # one short row of votes for each row of the bounded sample
    got = bk.map_batches(sample.select("text", "toxic"), run, "v binary, toxic int").toPandas().sort_values(["v", "toxic"])
    v = np.unpackbits(np.stack([np.frombuffer(x, np.uint8) for x in got["v"]]), axis=1)[:, :PATTERNS + len(mined)].astype(bool)
    _, posterior = fit_label_model(v, got["toxic"].to_numpy())
    return Classifier(mined, fit_linear(v, posterior))


def scores(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """``docs`` with ``_sk_score`` as the last column, the probability that a text is toxic; the
    name gets leading underscores where ``docs`` has such a column."""
    name = free_names(docs.columns, "_sk_score")[0]
    shared = docs.sparkSession.sparkContext.broadcast(classifier)

    def run(batches):
        for batch in batches:
            buf, off = bk.text_bytes(batch)
            out = [shared.value.score(part, part_off) for _, _, part, part_off in bk.slices(buf, off)]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(np.concatenate(out) if out else np.zeros(0))], names=[*batch.schema.names, name])

    return bk.map_batches(docs, run, docs.withColumn(name, F.lit(0.0)).schema)
