"""Operator 13, filter interaction audit by wide packed counters.

Filters may run in any order, and what one removes another no longer sees.
Which filters a document fails is a mask of one bit a filter; the mask (with
two bits more for the labels) fixes what happens to the document at every step
of every order. Each mask maps to one big integer with a 64-bit field for each
order, step and figure, set to one where the document counts. Adding these
integers adds all fields at once: a task adds its rows' integers per part,
partial integers are added again by part, and the fields of the last sum are
unpacked. A field holds at most the number of rows, so no field overflows into
the next one below 2**64 rows (or the sums that callers pass as ``n``).

The five filters of ``failures``: A fewer than 200 words, B fewer distinct
than half of the words, C more than 3 % capitals, D any of ``#$%&*|``, E the
text of a smaller doc_id. For E, rows are grouped by their text's digest with
doc_id first, so that a text that a third of the rows share is counted by many
tasks; what is left of a group is one row per label and part.

Defined cases: null text is empty, null lang is part ``''``; no doc_id is
smaller than null, which never fails E and makes no other fail; rows that
repeat one doc_id and text don't fail E for each other; several label rows of an id count as 1 where any is 1; labels
without a document count nowhere; an empty table has no part and no row. Other
columns are not read.
"""

from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm import bytekit as bk

FILTERS = "ABCDE"
FIGURES = ("kept", "removed", "redundant", "unique_fails", "good_lost", "toxic_lost")
MIN_WORDS, MIN_DISTINCT, MAX_CAPITALS = 200, 50, 3
FIELD = 8       # bytes
#: Partial integers of one part are first added in so many groups.
GROUPS = 16
#: Parts whose integers a task holds at once (29 kB each).
HELD = 2048
_SIGNS = np.zeros(256, bool)
_SIGNS[list(b"#$%&*|")] = True


def orders(filters: str = FILTERS) -> list[str]:
    return ["".join(p) for p in itertools.permutations(filters)]


def outcome(mask: int, good: bool, toxic: bool, filters: str = FILTERS) -> int:
    """The big integer of one document: a field for each order, step and figure, lowest first."""
    fields = []
    for order in orders(filters):
        gone = False
        for f in order:
            fails = bool(mask >> filters.index(f) & 1)
            here = fails and not gone
            fields += [not (gone or fails), here, fails and gone, mask == 1 << filters.index(f), here and good, here and toxic]
            gone = gone or fails
    return int.from_bytes(np.array(fields, "<u8").tobytes(), "little")


def _fails(batches):
    """Batches (doc_id, part, text) to (doc_id, part, mask of A to D, digest)."""
    for batch in batches:
        buf, off = bk.text_bytes(batch)
        for i, j, part, part_off in bk.slices(buf, off):
            starts, ends, word_off = bk.row_runs(bk.NOT_SPACE[part], part_off)
            words = np.diff(word_off)
            rows = np.repeat(np.arange(j - i), words)
            names = bk.span_hash(bk.prefix_hash(part), starts, ends)
            order = np.lexsort((names, rows))
            names, rows = names[order], rows[order]
            first = np.ones(len(rows), bool)
            first[1:] = (names[1:] != names[:-1]) | (rows[1:] != rows[:-1])
            distinct = np.bincount(rows[first], minlength=j - i)
            count = lambda at: np.diff(np.concatenate([[0], np.cumsum(at)])[part_off])
            capitals, points, signs = count((part >= 65) & (part <= 90)), count((part & 0xC0) != 0x80), count(_SIGNS[part])
            mask = (words < MIN_WORDS) + 2 * (100 * distinct < MIN_DISTINCT * words) + 4 * (100 * capitals > MAX_CAPITALS * points) + 8 * (signs > 0)
            raw = memoryview(part)
            digest = [hashlib.sha256(raw[s:e]).digest()[:16] for s, e in zip(part_off[:-1].tolist(), part_off[1:].tolist())]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(i, j - i), batch.column(1).slice(i, j - i), pa.array(mask.astype(np.int32)), pa.array(digest, pa.binary())],
                                             names=["doc_id", "part", "mask", "digest"])


def failures(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(part, mask, good, toxic, n): how many documents of a part fail which filters; rows of equal keys may repeat."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("lang").cast("string"), F.lit("")).alias("part"), "text")
    rows = bk.map_batches(rows, _fails, "doc_id long, part string, mask int, digest binary")
    marks = labels.where("doc_id is not null").groupBy(F.col("doc_id").cast("long").alias("doc_id")) \
                  .agg(F.max(F.coalesce(F.col("quality") == 1, F.lit(False))).alias("good"), F.max(F.coalesce(F.col("toxic") == 1, F.lit(False))).alias("toxic"))
    rows = rows.join(marks, "doc_id", "left").select("doc_id", "part", "mask", "digest", F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"))
    # a text's rows are first added by doc_id too, which spreads a common text over the tasks
    key = ["digest", "part", "mask", "good", "toxic"]
    rows = rows.groupBy("doc_id", *key).agg(F.count("*").alias("n"))
    some = rows.groupBy(*key).agg(F.sum("n").alias("n"), F.min("doc_id").alias("least"), F.min_by("n", "doc_id").alias("n_least"),
                                  F.sum(F.when(F.col("doc_id").isNull(), F.col("n")).otherwise(0)).alias("n_null"))
    # a window holds one row per label and part
    first = F.min("least").over(Window.partitionBy("digest"))
    passing = F.col("n_null") + F.when(F.col("least") == first, F.col("n_least")).otherwise(0)
    some = some.select(*key[1:], "n", passing.alias("passing"))
    both = F.explode(F.array(F.struct(F.col("mask").alias("mask"), F.col("passing").alias("n")), F.struct((F.col("mask") + 16).alias("mask"), (F.col("n") - F.col("passing")).alias("n"))))
    return some.select("part", "good", "toxic", both.alias("x")).select("part", "x.mask", "good", "toxic", "x.n").where("n > 0")


def _flush(sums: dict) -> pa.RecordBatch:
    packed = [v.to_bytes((v.bit_length() + 7) // 8, "little") for v in sums.values()]
    return pa.RecordBatch.from_arrays([pa.array(list(sums), pa.string()), pa.array(packed, pa.binary())], names=["part", "packed"])


def _pack(filters: str):
    """Batches (part, mask, good, toxic, n) to a task's sums (part, packed)."""
    def run(batches):
        integer: dict[int, int] = {}
        sums: dict[str, int] = {}
        bits = len(filters)
        for batch in batches:
            cols = {name: batch.column(k) for k, name in enumerate(batch.schema.names)}
            parts = cols["part"].dictionary_encode()
            mask, n = cols["mask"].to_numpy(), cols["n"].to_numpy()
            state = mask + (cols["good"].to_numpy(zero_copy_only=False).astype(np.int64) << bits) + (cols["toxic"].to_numpy(zero_copy_only=False).astype(np.int64) << (bits + 1))
            keys, at = np.unique(parts.indices.to_numpy().astype(np.int64) << (bits + 2) | state, return_inverse=True)
            times = np.zeros(len(keys), np.int64)
            np.add.at(times, at, n)
            names = parts.dictionary.to_pylist()
            for k, t in zip(keys.tolist(), times.tolist()):
                s = k & ((1 << (bits + 2)) - 1)
                if s not in integer:
                    integer[s] = outcome(s & ((1 << bits) - 1), bool(s >> bits & 1), bool(s >> (bits + 1)), filters)
                name = names[k >> (bits + 2)]
                sums[name] = sums.get(name, 0) + t * integer[s]      # as many equal integers as documents
                if len(sums) > HELD:
                    yield _flush(sums)
                    sums = {}
        if sums:
            yield _flush(sums)
    return run


def _add(batches):
    """Rows (part, packed) sorted by part to one sum of each part."""
    name, total = None, 0
    for batch in batches:
        for p, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            if p != name and name is not None:
                yield _flush({name: total})
                total = 0
            name, total = p, total + int.from_bytes(v, "little")
    if name is not None:
        yield _flush({name: total})


def _unpack(filters: str):
    def run(batches):
        names = orders(filters)
        k, shape = len(filters), (len(names), len(filters), len(FIGURES))
        place = np.array([[filters.index(f) for f in order] for order in names])
        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                fields = np.frombuffer(packed.ljust(int(np.prod(shape)) * FIELD, b"\0"), "<u8").astype(np.int64).reshape(shape)
                shapley = np.zeros(k, np.int64)
                np.add.at(shapley, place, fields[:, :, FIGURES.index("removed")])
                n = len(names) * k
                cols = [pa.array([part] * n, pa.string()), pa.array([o for o in names for _ in range(k)], pa.string()), pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), len(names)))]
                cols += [pa.array(fields[:, :, f].ravel()) for f in range(len(FIGURES))] + [pa.array(shapley[place].ravel())]
                yield pa.RecordBatch.from_arrays(cols, names=["part", "filter_order", "step", *FIGURES, "shapley"])
    return run


def audit(masks: DataFrame, filters: str = FILTERS) -> DataFrame:
    """All orders of ``filters`` over rows (part, mask, good, toxic, n): bit k of ``mask`` says that
    the k-th filter fails n documents. One row per part, order and step."""
    packed = "part string, packed binary"
    sums = bk.map_batches(masks.select("part", "mask", "good", "toxic", "n"), _pack(filters), packed)
    sums = sums.withColumn("g", F.pmod(F.xxhash64("packed"), F.lit(GROUPS))).repartition("part", "g").sortWithinPartitions("part", "g").select("part", "packed")
    sums = bk.map_batches(sums, _add, packed)
    sums = bk.map_batches(sums.repartition("part").sortWithinPartitions("part"), _add, packed)
    return bk.map_batches(sums, _unpack(filters), "part string, filter_order string, step int, " + ", ".join(f"{c} long" for c in (*FIGURES, "shapley")))
