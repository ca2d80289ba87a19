"""Operator 7, removal of long repeated strings by sorted suffix tuples.

A byte is removed if a string of ``LENGTH`` (400) bytes that covers it also
starts anywhere else in the corpus. As in induced sorting, only some suffixes
are sorted themselves, the rest is induced from them:

1. Sampled suffixes. Every start p of a 400-byte string belongs to the sampled
   suffix a >= p whose 16 bytes hash least in the next ``SPAN`` (352) bytes, so equal
   strings have their sampled suffix at the same distance. A suffix becomes one
   tuple: its name (hash of the bytes that all its strings share, a common prefix of
   49), its place, and the range [lo, hi] of starts that belong to it.
2. Names are brought together by Spark's external sort and shuffle, which spill to
   disk and never hold a shard in memory; tuples of a name that occurs once are done.
3. A tuple whose whole stretch [lo, hi + 400) occurs again is settled: all its
   strings repeat. One tuple of each such stretch goes on as a partner.
4. Induction. Tuples at the border of a repeat are brought together by name with
   their stretch, and the strings before the sampled suffix are compared one start at a time.
   A name with more than ``GROUP`` open tuples doesn't go to one task: its
   strings are counted by a shuffle of their own.
5. Spans are merged per document and cut out.

Hashes of whole stretches have 128 bits. The order within the sort is that of
hashes, not of the alphabet: repeats need equal prefixes together, nothing more.

Defined cases: null text is empty; texts under 400 bytes lose nothing; rows
that repeat a doc_id and text are occurrences of their own; a null doc_id is
a document like any other; an empty table gives no row.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from skyfold.llm import bytekit as bk
from skyfold.llm.decontaminate import merged
from skyfold.llm.store import Store

LENGTH, SPAN, GRAM = 400, 352, 16
GROUP = 8192
_PLACE = np.uint64((1 << 32) - 1)
_KEY = ["k1", "k2", "k3"]
_ROWS_AT_ONCE = 2000


def _keyed(docs: DataFrame) -> DataFrame:
    """Texts under a key of their doc_id and text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.xxhash64("doc_id", text).alias("k1"), F.coalesce(F.col("doc_id").cast("long"), F.xxhash64(F.lit(1), text)).alias("k2"),
                       F.col("doc_id").isNull().alias("k3"), text.alias("text"))


def sampled(buf: np.ndarray, off: np.ndarray):
    """(row, lo, hi, a) of the sampled suffixes, as places in ``buf``."""
    n = len(buf)
    none = np.zeros(0, np.int64)
    if n < LENGTH:
        return none, none, none, none
    at = np.arange(n - GRAM + 1)
    prefix = bk.prefix_hash(buf)
    least = (bk.span_hash(prefix, at, at + GRAM) & ~_PLACE) | at.astype(np.uint64)
    width = 1
    while 2 * width <= SPAN:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    rest = SPAN - width
    least = np.minimum(least[:-rest], least[rest:]) if rest else least
    row = np.repeat(np.arange(len(off) - 1), np.diff(off))
    p = np.flatnonzero(off[1:][row] - np.arange(n) >= LENGTH)
    if not len(p):
        return none, none, none, none
    a = (least[p] & _PLACE).astype(np.int64)
    first = np.flatnonzero(np.r_[True, (np.diff(a) != 0) | (np.diff(p) != 1)])
    last = np.r_[first[1:], len(p)] - 1
    return row[p[first]], p[first], p[last], a[first]


def _names(batches):
    for batch in batches:
        buf, off = bk.text_bytes(batch)
        for _, _, part, part_off in bk.slices(buf, off):
            _, _, _, a = sampled(part, part_off)
            name = bk.span_hash(bk.prefix_hash(part), a, a + LENGTH - SPAN + 1)
            yield pa.RecordBatch.from_arrays([pa.array(name.view(np.int64))], names=["name"])


def _tuples(batches):
    for batch in batches:
        buf, off = bk.text_bytes(batch)
        for i, _, part, part_off in bk.slices(buf, off):
            row, lo, hi, a = sampled(part, part_off)
            prefix, other = bk.prefix_hash(part), bk.prefix_hash(part, 1)
            cols = [batch.column(batch.schema.get_field_index(k)).take(pa.array(i + row)) for k in _KEY]
            start = part_off[:-1][row]
            cols += [pa.array(x) for x in (bk.span_hash(prefix, a, a + LENGTH - SPAN + 1).view(np.int64), bk.span_hash(prefix, lo, hi + LENGTH).view(np.int64),
                                           bk.span_hash(other, lo, hi + LENGTH).view(np.int64), lo - start, (hi - lo).astype(np.int16))]
            yield pa.RecordBatch.from_arrays(cols, names=[*_KEY, "name", "e1", "e2", "lo", "more"])


_KEY_SCHEMA = "k1 long, k2 long, k3 boolean"


def _stretches(batches):
    """Rows (key, text, parts) to (key, name, lo, open, large, stretch)."""
    for batch in batches:
        buf, off = bk.text_bytes(batch)
        raw = buf.tobytes()
        parts = batch.column(batch.schema.get_field_index("parts")).to_pylist()
        row, got = [], [[], [], [], [], []]
        for r, found in enumerate(parts):
            for x in found:
                s = int(off[r]) + x["lo"]
                row.append(r)
                for c, v in zip(got, (x["name"], x["lo"], x["open"], x["large"], raw[s:s + x["more"] + LENGTH])):
                    c.append(v)
                if len(row) >= _ROWS_AT_ONCE:
                    yield _stretch_batch(batch, row, got)
                    row, got = [], [[], [], [], [], []]
        yield _stretch_batch(batch, row, got)


def _stretch_batch(batch, row, got):
    keys = [batch.column(batch.schema.get_field_index(k)).take(pa.array(row, pa.int64())) for k in _KEY]
    kinds = [pa.int64(), pa.int64(), pa.bool_(), pa.bool_(), pa.binary()]
    return pa.RecordBatch.from_arrays([*keys, *(pa.array(c, t) for c, t in zip(got, kinds))], names=[*_KEY, "name", "lo", "open", "large", "stretch"])


def _strings(batch, name="stretch"):
    """Hashes of all 400-byte strings of a batch of stretches, and the row and offset of each."""
    buf, off = bk.text_bytes(batch, name)
    count = np.diff(off) - LENGTH + 1
    row = np.repeat(np.arange(len(count)), count)
    at = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
    start = off[:-1][row] + at
    return buf, bk.span_hash(bk.prefix_hash(buf), start, start + LENGTH), row, at, start


def _compare(batches):
    """Batches sorted by name to spans (key, from, to) of open tuples; whole names are looked at together."""
    held: list[pa.RecordBatch] = []

    def spans(table: pa.Table):
        for batch in table.combine_chunks().to_batches():
            _, h, row, at, _ = _strings(batch)
            _, inverse, times = np.unique(h, return_inverse=True, return_counts=True)
            again = (times[inverse] > 1) & batch.column(batch.schema.get_field_index("open")).to_numpy(zero_copy_only=False)[row]
            row, at = row[again], at[again]
            if len(row):
                first = np.flatnonzero(np.r_[True, (np.diff(row) != 0) | (np.diff(at) != 1)])
                last = np.r_[first[1:], len(row)] - 1
                lo = batch.column(batch.schema.get_field_index("lo")).to_numpy()[row[first]]
                keys = [batch.column(batch.schema.get_field_index(k)).take(pa.array(row[first])) for k in _KEY]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(lo + at[first]), pa.array(lo + at[last] + LENGTH)], names=[*_KEY, "from", "to"])

    rows = 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= _ROWS_AT_ONCE:
            table = pa.Table.from_batches(held)
            names = table.column("name").to_numpy()
            cut = int(np.searchsorted(names, names[-1]))       # the last name may go on
            for i, j in _whole_names(names[:cut]):
                yield from spans(table.slice(i, j - i))
            held = table.slice(cut).to_batches()
            rows = len(names) - cut
    if held:
        table = pa.Table.from_batches(held)
        for i, j in _whole_names(table.column("name").to_numpy()):
            yield from spans(table.slice(i, j - i))


def _whole_names(names: np.ndarray):
    """Runs of whole names of about _ROWS_AT_ONCE rows."""
    i = 0
    while i < len(names):
        j = min(len(names), i + _ROWS_AT_ONCE)
        j = int(np.searchsorted(names, names[j - 1], "right"))
        yield i, j
        i = j


def _single_strings(batches):
    """Rows of large names to one row per string: (key, h1, h2, at, open)."""
    for batch in batches:
        for k in range(0, batch.num_rows, 200):
            part = batch.slice(k, 200)
            buf, h, row, at, start = _strings(part)
            other = bk.span_hash(bk.prefix_hash(buf, 1), start, start + LENGTH)
            lo = part.column(part.schema.get_field_index("lo")).to_numpy()
            cols = [part.column(part.schema.get_field_index(c)).take(pa.array(row)) for c in (*_KEY, "open")]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(h.view(np.int64)), pa.array(other.view(np.int64)), pa.array(lo[row] + at)], names=[*_KEY, "open", "h1", "h2", "at"])


def repeated_spans(store: Store, keyed: DataFrame) -> DataFrame:
    """(key, from, to): stretches of repeated strings, which may overlap."""
    names = bk.map_batches(keyed.select("text"), _names, "name long").groupBy("name").count().where("count > 1").select("name")
    tuples = bk.map_batches(keyed, _tuples, _KEY_SCHEMA + ", name long, e1 long, e2 long, lo long, more short")
    tuples = store.keep(tuples.join(names, "name", "left_semi"))
    place = F.struct(*_KEY, "lo")
    twice = tuples.groupBy("e1", "e2").agg(F.count("*").alias("n"), F.min(place).alias("least")).where("n > 1").drop("n")
    marked = store.keep(tuples.join(twice, ["e1", "e2"], "left").select(
        *_KEY, "name", "lo", "more", F.col("least").isNull().alias("open"), F.coalesce(place == F.col("least"), F.lit(True)).alias("partner")))
    settled = marked.where("not open").select(*_KEY, F.col("lo").alias("from"), (F.col("lo") + F.col("more") + LENGTH).alias("to"))
    groups = marked.where("partner").groupBy("name").agg(F.count("*").alias("n"), F.max("open").alias("any_open")).where("any_open and n > 1")
    active = marked.where("partner").join(groups.select("name", (F.col("n") > GROUP).alias("large")), "name")
    parts = active.groupBy(*_KEY).agg(F.collect_list(F.struct("name", "lo", "more", "open", "large")).alias("parts"))
    stretches = bk.map_batches(keyed.join(parts, _KEY).select(*_KEY, "text", "parts"), _stretches,
                               _KEY_SCHEMA + ", name long, lo long, open boolean, large boolean, stretch binary")
    stretches = store.keep(stretches)
    near = stretches.where("not large").repartition("name").sortWithinPartitions("name")
    spans = _KEY_SCHEMA + ", from long, to long"
    small = bk.map_batches(near, _compare, spans)
    strings = bk.map_batches(stretches.where("large"), _single_strings, _KEY_SCHEMA + ", open boolean, h1 long, h2 long, at long")
    again = strings.groupBy("h1", "h2").count().where("count > 1")
    large = strings.where("open").join(again, ["h1", "h2"], "left_semi").select(*_KEY, F.col("at").alias("from"), (F.col("at") + LENGTH).alias("to"))
    return settled.unionByName(small).unionByName(large)


def _cut(batches):
    """Rows (key, text, spans) to the result, with the kept bytes."""
    for batch in batches:
        buf, off = bk.text_bytes(batch)
        spans = batch.column(batch.schema.get_field_index("spans")).to_pylist()
        removed, runs, digest = [], [], []
        for r, found in enumerate(spans):
            raw, end, keep = buf[off[r]:off[r + 1]].tobytes(), 0, []
            cut = merged([(x["from"], x["to"]) for x in found or ()])
            for s, e in cut:
                keep.append(raw[end:s])
                end = e
            kept = b"".join([*keep, raw[end:]])
            removed.append(len(raw) - len(kept))
            runs.append(len(cut))
            digest.append(hashlib.sha256(kept).hexdigest())
        keys = [batch.column(batch.schema.get_field_index(k)) for k in _KEY]
        yield pa.RecordBatch.from_arrays([*keys, pa.array(np.diff(off)), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digest, pa.string())],
                                         names=[*_KEY, "n_bytes", "n_removed", "n_spans", "kept_sha256"])


def remove_repeats(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256."""
    store = Store(docs.sparkSession, "repeats")
    keyed = _keyed(docs)
    spans = repeated_spans(store, keyed).groupBy(*_KEY).agg(F.collect_list(F.struct("from", "to")).alias("spans"))
    out = bk.map_batches(keyed.join(spans, _KEY, "left").select(*_KEY, "text", "spans"), _cut,
                         _KEY_SCHEMA + ", n_bytes long, n_removed long, n_spans long, kept_sha256 string")
    return out.select(F.when(~F.col("k3"), F.col("k2")).alias("doc_id"), "n_bytes", "n_removed", "n_spans", "kept_sha256")
