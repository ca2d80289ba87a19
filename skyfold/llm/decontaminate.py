"""Operator 4, benchmark decontamination: a generalised suffix automaton of the test items.

The normalised words of all items (one block of items at a time, each block
of a bounded number of words) make one suffix automaton, which is broadcast.
Every document's words are streamed through it; the automaton's state holds
the longest match that ends at a word. A match of ``window`` words, or of a
whole item that is shorter, marks its words as hit. Documents whose hit share
exceeds ``max_coverage`` go, of the others the hit spans are cut out.

Before the automaton runs, a vectorised look at the words' 3-grams finds the
stretches where every 3-gram occurs in some item: a match lies inside one
such stretch, so the automaton reads those alone, with the same result.

Defined cases: a null or empty text has no words and is not hit; an item
without words has no window; items of one id count once, a null id counts
for hits but is not listed; an empty benchmark hits nothing; repeated rows
are judged alike; other columns are passed on untouched.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from skyfold.llm import bytekit as bk
from skyfold.llm.names import shielded

WINDOW = 10
BLOCK_WORDS = 1_000_000


class SuffixAutomaton:
    """Generalised suffix automaton over sequences of word ids."""

    def __init__(self) -> None:
        self.next: list[dict[int, int]] = [{}]
        self.link = [-1]
        self.length = [0]
        self.items: list[set] = [set()]

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.length.append(length)
        self.items.append(set())
        return len(self.link) - 1

    def _split(self, p: int, q: int, w: int) -> int:
        """A copy of q for the shorter substrings that reach it from p."""
        copy = self._state(self.length[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def extend(self, last: int, w: int) -> int:
        q = self.next[last].get(w)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, w)
        new, p = self._state(self.length[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][w]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, w)
        return new

    def add(self, words: list[int]) -> None:
        state = 0
        for w in words:
            state = self.extend(state, w)

    def mark(self, words: list[int], name: object) -> None:
        """Writes the item's name at every state that one of its substrings reaches."""
        state = 0
        for w in words:
            state = self.next[state][w]
            s = state
            while s > 0 and name not in self.items[s]:
                self.items[s].add(name)
                s = self.link[s]


class Matcher:
    """The automaton of one block of items, ready to stream documents through."""

    def __init__(self, items: list[tuple[str | None, str]], window: int) -> None:
        words = []
        vocabulary: dict[int, int] = {}
        for name, text in items:
            h = _words(np.frombuffer(text.encode(), np.uint8), np.array([0, len(text.encode())]))[2]
            if len(h):
                words.append((name, [vocabulary.setdefault(x, len(vocabulary)) for x in h.tolist()]))
        keys = np.array(list(vocabulary), np.uint64)
        order = np.argsort(keys)
        self.hashes, self.ids = keys[order], order.astype(np.int64)
        self.window = window
        self.least = min((min(window, len(w)) for _, w in words), default=0)
        self.gram = min(3, self.least)
        grams = [bk.gram_hash(np.array(w, np.uint64), self.gram) for _, w in words]
        self.grams = np.unique(np.concatenate(grams)) if grams else np.zeros(0, np.uint64)
        a = self.automaton = SuffixAutomaton()
        for _, w in words:
            a.add(w)
        short: dict[int, list[tuple[int, object]]] = {}
        for name, w in words:
            a.mark(w, name)
            if len(w) < window:
                state = 0
                for x in w:
                    state = a.next[state][x]
                short.setdefault(state, []).append((len(w), name))
        # of every state: the state of its substrings' last `window` words, and the short items that end there
        n = len(a.link)
        self.base, self.short = list(range(n)), [()] * n
        for s in sorted(range(1, n), key=a.length.__getitem__):
            up = a.link[s]
            if up > 0 and a.length[up] >= window:
                self.base[s] = self.base[up]
            self.short[s] = (*self.short[up], *short.get(s, ())) if up >= 0 else ()

    def scan(self, ids: list[int], at: int, spans: list[tuple[int, int]], found: set) -> None:
        """Streams one stretch of words that begins at word ``at`` of its document."""
        a, state, length = self.automaton, 0, 0
        for i, w in enumerate(ids, at + 1):
            while state and w not in a.next[state]:
                state = a.link[state]
                length = a.length[state]
            if w in a.next[state]:
                state, length = a.next[state][w], length + 1
            if length >= self.window:
                spans.append((i - self.window, i))
                found |= a.items[self.base[state]]
            for m, name in self.short[state]:
                if m <= length:
                    spans.append((i - m, i))
                    found.add(name)

    def hits(self, words: np.ndarray, off: np.ndarray) -> dict[int, tuple[list[tuple[int, int]], set]]:
        """Of each row with a hit: its hit spans, merged, and the names of the items."""
        if not len(self.hashes) or not len(words):
            return {}
        at = np.minimum(np.searchsorted(self.hashes, words), len(self.hashes) - 1)
        ids = np.where(self.hashes[at] == words, self.ids[at], -1)
        starts = bk.gram_starts(off, self.gram)
        known = ids >= 0
        for k in range(1, self.gram):
            known[:-k] &= ids[k:] >= 0
        starts = starts[known[starts]]
        h = bk.gram_hash(ids.astype(np.uint64), self.gram)[starts]
        at = np.minimum(np.searchsorted(self.grams, h), len(self.grams) - 1)
        starts = starts[self.grams[at] == h]
        if not len(starts):
            return {}
        row = np.searchsorted(off, starts, "right") - 1
        new = np.flatnonzero(np.r_[True, (np.diff(starts) != 1) | (np.diff(row) != 0)])
        out: dict[int, tuple[list[tuple[int, int]], set]] = {}
        for first, last in zip(new, np.r_[new[1:], len(starts)] - 1):
            s, e, r = int(starts[first]), int(starts[last]) + self.gram, int(row[first])
            if e - s >= self.least:
                spans, found = out.setdefault(r, ([], set()))
                self.scan(ids[s:e].tolist(), s - int(off[r]), spans, found)
        return {r: (merged(spans), found) for r, (spans, found) in out.items() if spans}


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(out[-1][1], e))
        else:
            out.append((s, e))
    return out


def _words(buf: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of the words, and the offsets of the rows' words."""
    low = bk.LOWER[buf]
    starts, ends, word_off = bk.row_runs(bk.ALNUM[low], off)
    return starts, ends, bk.span_hash(bk.prefix_hash(low), starts, ends), word_off


def _blocks(benchmark: DataFrame, block_words: int) -> list[DataFrame]:
    """The items in parts of about ``block_words`` words, by a hash of the item."""
    items = benchmark.select(F.col("item_id").cast("string").alias("item_id"), "text").where("text is not null")
    size = items.agg(F.sum(F.length("text"))).first()[0] or 0
    n = max(1, math.ceil(size / 5 / block_words))
    return [items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(n)) == i) for i in range(n)] if size else []


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``docs`` with ``_sk_words`` (number of words), ``_sk_spans`` (hit words, as flat pairs
    [first, last + 1)) and ``_sk_items`` (ids of the items found), which replace columns of these names."""
    sc = docs.sparkSession.sparkContext
    out = docs.withColumns({"_sk_words": F.lit(0).cast("long"), "_sk_spans": F.array().cast("array<long>"),
                            "_sk_items": F.array().cast("array<string>")})
    for block in _blocks(benchmark, block_words) or [None]:
        rows = [tuple(r) for r in block.collect()] if block is not None else []
        shared = sc.broadcast(rows)

        def scan(batches, shared=shared):
            matcher = Matcher(shared.value, window)
            for batch in batches:
                buf, off = bk.text_bytes(batch)
                n = np.zeros(batch.num_rows, np.int64)
                spans, items = (batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("_sk_spans", "_sk_items"))
                for i, _, part, part_off in bk.slices(buf, off):
                    _, _, words, word_off = _words(part, part_off)
                    n[i:i + len(word_off) - 1] = np.diff(word_off)
                    for r, (new, found) in matcher.hits(words, word_off).items():
                        old = spans[i + r]
                        spans[i + r] = [x for s in merged([*zip(old[::2], old[1::2]), *new]) for x in s]
                        items[i + r] = sorted({*items[i + r], *(x for x in found if x is not None)})
                cols = [{"_sk_words": pa.array(n), "_sk_spans": pa.array(spans, pa.list_(pa.int64())),
                         "_sk_items": pa.array(items, pa.list_(pa.string()))}.get(f.name, c) for f, c in zip(batch.schema, batch.columns)]
                yield pa.RecordBatch.from_arrays(cols, names=batch.schema.names)

        out = bk.map_batches(out, scan, out.schema)
    return out


def _n_hit() -> Column:
    """Words in the (disjoint) hit spans."""
    ends = F.transform("_sk_spans", lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(ends, F.lit(0).cast("long"), lambda a, x: a + x)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW, max_coverage: float = 0.5) -> DataFrame:
    """The documents without hit spans; those whose hit share of words exceeds ``max_coverage`` go.
    Columns are those of ``docs``, whatever their names."""
    inner = shielded(docs)
    found = find_hits(inner, benchmark, window)
    found = found.where((F.col("_sk_words") == 0) | (_n_hit() <= max_coverage * F.col("_sk_words")))

    def cut(batches):
        for batch in batches:
            at = batch.schema.get_field_index("text")
            spans = batch.column(batch.schema.get_field_index("_sk_spans")).to_pylist()
            if any(spans):
                text = batch.column(at).to_pylist()
                for r, flat in enumerate(spans):
                    if flat:
                        raw = text[r].encode()
                        starts, ends, _, _ = _words(np.frombuffer(raw, np.uint8), np.array([0, len(raw)]))
                        keep, end = [], 0
                        for s, e in zip(flat[::2], flat[1::2]):
                            keep.append(raw[end:int(starts[s])])
                            end = int(ends[e - 1])
                        text[r] = b"".join([*keep, raw[end:]]).decode()
                batch = batch.set_column(at, batch.schema.field(at), pa.array(text, batch.schema.field(at).type))
            yield batch

    return bk.map_batches(found, cut, found.schema).select(*inner.columns).toDF(*docs.columns)


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """One row per document: doc_id, n_words, n_hit, n_items, items_sha256, contaminated."""
    found = find_hits(docs.select("doc_id", "text"), benchmark, window)
    return found.select(
        "doc_id", F.col("_sk_words").alias("n_words"), _n_hit().alias("n_hit"), F.size("_sk_items").cast("long").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("_sk_items"), ","), 256).alias("items_sha256"), (F.size("_sk_spans") > 0).alias("contaminated"))
