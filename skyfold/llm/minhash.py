"""Operator 5, near-duplicates by circulant MinHash with exact verification.

A document's set holds its distinct word shingles. One permutation (a 64-bit
bijective mixer, reduced to ``UNIVERSE`` positions) scatters the shingles, a
second one, a fixed permutation table, is read at circularly shifted places:
coordinate k of the signature is the least ``table[(position + k) mod UNIVERSE]``.
``BANDS`` bands of ``ROWS`` coordinates propose candidates (a pair at 0.8 is
missed with probability (1 - 0.8**6)**48 = 5e-7), which must agree in most of
the coordinates' lowest bits too (a pair at 0.8 fails with 2e-8); every link
is confirmed on the full sets.

Work on groups: documents with one set form a class, classes that share a
band are first compared with the least class of that bucket, and links make
components. Pairs inside one component need no check, so a large group of
near copies never emits its pairs. In buckets that still hold several
components, every pair across them has a member outside the bucket's largest
one. In rounds, about ``PIVOTS`` of those outsiders a bucket are compared with all
members of other components, and leave the bucket, until one component is
left: with a large component as a whole, block by block inside tasks (later
only with the members it has got since), with the members of others as single
pairs.

Defined cases: a document without words or text has an empty set, is its own
component and is kept; fewer words than the shingle make one shingle of the
whole sequence; rows of one set link whatever their ids are; a null doc_id
never is a component's id unless all its members' are null; rows that repeat
a doc_id get the same verdict if their sets are linked.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from skyfold.llm import bytekit as bk
from skyfold.llm.store import Store

UNIVERSE = 1 << 20
BANDS, ROWS = 48, 6
PERCENT = 80
#: Lowest bits of the coordinates, in longs; sets at 0.8 differ in a tenth of them (28.8, deviation 5.1).
BITS = ("b0", "b1", "b2", "b3", "b4")
MAX_BITS = 60
PIVOTS = 256
#: Components of at least this many nodes are compared as a whole, in blocks of about so many shingles.
LARGE, BLOCK = 64, 1_000_000
#: Bits of the bitmap of nodes that share a bucket (4 MB).
SIEVE = 1 << 25
_CHUNK = 1 << 14
_CACHE: dict[str, np.ndarray] = {}


def _table() -> np.ndarray:
    """The second permutation, with its first coordinates repeated at the end (the circle)."""
    if "table" not in _CACHE:
        p = np.random.Generator(np.random.PCG64(7)).permutation(UNIVERSE).astype(np.int32)
        _CACHE["table"] = np.concatenate([p, p[:BANDS * ROWS]])
    return _CACHE["table"]


def shingle_sets(buf: np.ndarray, off: np.ndarray, shingle: int) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of every row, one after another, and the rows' offsets."""
    low = bk.LOWER[buf]
    starts, ends, word_off = bk.row_runs(bk.NOT_SPACE[low], off)
    words = bk.span_hash(bk.prefix_hash(low), starts, ends)
    grams = bk.gram_hash(words, shingle)
    sets = []
    for s, e in zip(word_off[:-1].tolist(), word_off[1:].tolist()):
        if e - s >= shingle:
            sets.append(np.unique(grams[s:e - shingle + 1]))
        else:
            sets.append(bk.gram_hash(words[s:e], e - s) if e > s else words[:0])
    return np.concatenate(sets) if sets else words[:0], np.concatenate([[0], np.cumsum([len(x) for x in sets], dtype=np.int64)])


def signatures(values: np.ndarray, off: np.ndarray) -> np.ndarray:
    """One row of BANDS * ROWS coordinates per (non-empty) set."""
    k = BANDS * ROWS
    view = np.lib.stride_tricks.sliding_window_view(_table(), k)
    place = (bk.mix(values * np.uint64(0xC2B2AE3D27D4EB4F)) >> np.uint64(44)).astype(np.int64) & (UNIVERSE - 1)
    out = np.empty((len(off) - 1, k), np.int32)
    i, n = 0, len(off) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(off, off[i] + _CHUNK, "right")) - 1)
        if j == i + 1:      # one set, perhaps a large one: in pieces
            least = np.full(k, np.iinfo(np.int32).max, np.int32)
            for s in range(int(off[i]), int(off[j]), _CHUNK):
                np.minimum(least, view[place[s:min(s + _CHUNK, int(off[j]))]].min(axis=0), out=least)
            out[i] = least
        else:
            out[i:j] = np.minimum.reduceat(view[place[off[i]:off[j]]], off[i:j] - off[i], axis=0)
        i = j
    return out


def band_keys(sig: np.ndarray) -> np.ndarray:
    rows = sig.reshape(len(sig), BANDS, ROWS).astype(np.uint64)
    h = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), rows.shape[:2]).copy()
    for r in range(ROWS):
        h = bk.mix(h * np.uint64(0x9E3779B97F4A7C15) + rows[:, :, r])
    return h.view(np.int64)


def low_bits(sig: np.ndarray) -> np.ndarray:
    """Lowest bits of the coordinates, one row of len(BITS) longs a set."""
    packed = np.packbits((sig & 1).astype(np.uint8), axis=1)
    return np.pad(packed, ((0, 0), (0, 8 * len(BITS) - packed.shape[1]))).view(np.int64)


def _names(values: np.ndarray, set_off: np.ndarray) -> list[bytes | None]:
    """The 128-bit hash of each set, null for an empty one."""
    return [xxhash.xxh3_128_digest(values[s:e].tobytes()) if e > s else None for s, e in zip(set_off[:-1].tolist(), set_off[1:].tolist())]


def _sketch(shingle: int, bands: bool):
    """Batches (doc_id, text) to (doc_id, node, n_shingles[, BITS, bands] or [, text]); node: 128-bit hash of the set."""
    def run(batches):
        for batch in batches:
            buf, off = bk.text_bytes(batch)
            for i, j, part, part_off in bk.slices(buf, off):
                values, set_off = shingle_sets(part, part_off, shingle)
                size = np.diff(set_off)
                node = _names(values, set_off)
                cols = [batch.column(0).slice(i, j - i), pa.array(node, pa.binary()), pa.array(size)]
                if bands:
                    full = np.flatnonzero(size)
                    sig = signatures(values, np.concatenate([set_off[:-1][full], set_off[-1:]])) if len(full) else np.zeros((0, BANDS * ROWS), np.int32)
                    bits = np.zeros((len(size), len(BITS)), np.int64)
                    bits[full] = low_bits(sig)
                    cols += [pa.array(bits[:, k]) for k in range(len(BITS))]
                    ends = np.concatenate([[0], np.cumsum(size > 0) * BANDS]).astype(np.int32)
                    cols.append(pa.ListArray.from_arrays(pa.array(ends), pa.array(band_keys(sig).ravel())))
                else:
                    cols.append(batch.column(1).slice(i, j - i))
                yield pa.RecordBatch.from_arrays(cols, names=["doc_id", "node", "n_shingles", *((*BITS, "bands") if bands else ("text",))])
    return run


def _confirm(shingle: int):
    """Batches (a, b, text_a, text_b) to the pairs (a, b) whose sets are similar enough."""
    def sets(batch, name):
        """The set of each row's text; texts that come again are read once."""
        coded = batch.column(batch.schema.get_field_index(name)).dictionary_encode()
        texts = pa.RecordBatch.from_arrays([coded.dictionary], names=["text"])
        buf, off = bk.text_bytes(texts)
        each = []
        for _, _, part, part_off in bk.slices(buf, off):
            values, set_off = shingle_sets(part, part_off, shingle)
            each += [values[s:e] for s, e in zip(set_off[:-1].tolist(), set_off[1:].tolist())]
        return [each[k] for k in coded.indices.to_pylist()]

    def run(batches):
        for batch in batches:
            keep = []
            for x, y in zip(sets(batch, "text_a"), sets(batch, "text_b")):
                both = len(np.intersect1d(x, y, assume_unique=True)) if 100 * min(len(x), len(y)) >= PERCENT * max(len(x), len(y)) else 0
                keep.append(100 * both >= PERCENT * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))
    return run


def components(store: Store, links: DataFrame) -> DataFrame:
    """(node, component) of every node of ``links`` (a, b); the component is its least node.

    Each round hooks every root to the least root it touches, then jumps to the new roots; the
    tables between rounds are written to the shared folder."""
    both = links.select("a", "b").union(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    label = both.groupBy(F.col("a").alias("node")).agg(F.min("b").alias("m")).select("node", F.least("node", "m").alias("component"))
    label = _jump_all(store, store.keep(label))
    while True:
        ends = links.join(label.select(F.col("node").alias("a"), F.col("component").alias("ca")), "a") \
                    .join(label.select(F.col("node").alias("b"), F.col("component").alias("cb")), "b").where("ca != cb")
        apart = store.keep(ends.select(F.greatest("ca", "cb").alias("component"), F.least("ca", "cb").alias("low"))
                           .groupBy("component").agg(F.min("low").alias("low")))
        if apart.isEmpty():
            return label
        hooked = label.join(apart, "component", "left").select("node", F.coalesce("low", "component").alias("component"))
        label = _jump_all(store, store.keep(hooked))


def _jump_all(store: Store, label: DataFrame) -> DataFrame:
    while True:
        up = label.select(F.col("node").alias("component"), F.col("component").alias("up"))
        jumped = store.keep(label.join(up, "component", "left").select("node", F.coalesce("up", "component").alias("new"), F.col("component").alias("was")))
        label = jumped.select("node", F.col("new").alias("component"))
        if jumped.where("new != was").isEmpty():
            return label


def _links(store: Store, pairs: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """The pairs (a, b) of nodes that are similar enough, on the full sets."""
    with_text = pairs.join(texts.select(F.col("node").alias("a"), F.col("text").alias("text_a")), "a") \
                     .join(texts.select(F.col("node").alias("b"), F.col("text").alias("text_b")), "b")
    return store.keep(bk.map_batches(with_text.select("a", "b", "text_a", "text_b"), _confirm(shingle), "a binary, b binary"))


def _may_link(x: str, y: str) -> Column:
    """Whether the sets of two structs can be similar enough, by their sizes and lowest bits."""
    size = [F.col(f"{s}.n_shingles") for s in (x, y)]
    differ = sum((F.bit_count(F.col(f"{x}.{b}").bitwiseXOR(F.col(f"{y}.{b}"))) for b in BITS), F.lit(0))
    return (100 * F.least(*size) >= PERCENT * F.greatest(*size)) & (differ <= MAX_BITS)


def _groups(batches, *keys: str):
    """The rows of each run of equal keys, from batches sorted by them."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        table = pa.Table.from_batches(held)
        cols = [table.column(k).to_pylist() for k in keys]
        cuts = [0] + [i for i in range(1, len(table)) if any(c[i] != c[i - 1] for c in cols)]
        for i, j in zip(cuts, cuts[1:]):
            yield table.slice(i, j - i)
        held = table.slice(cuts[-1]).to_batches() if len(table) else []
    if held:
        yield pa.Table.from_batches(held)


def _block_links(shingle: int):
    """Blocks of (component, seen, i, j, outside, node, text) to one link (a, b) of each outsider that has any."""
    def run(batches):
        for table in _groups(batches, "component", "seen", "i", "j"):
            batch = table.combine_chunks().to_batches()[0]
            buf, off = bk.text_bytes(batch)
            parts = [(part, part_off) for _, _, part, part_off in bk.slices(buf, off)]
            sets = [values[s:e] for part, part_off in parts for values, o in [shingle_sets(part, part_off, shingle)] for s, e in zip(o[:-1].tolist(), o[1:].tolist())]
            nodes = batch.column(batch.schema.get_field_index("node")).to_pylist()
            outside = batch.column(batch.schema.get_field_index("outside")).to_pylist()
            inner = [k for k, x in enumerate(outside) if not x]
            if not inner:
                continue
            size = np.array([len(sets[k]) for k in inner])
            owner = np.repeat(np.arange(len(inner)), size)
            values = np.concatenate([sets[k] for k in inner])
            order = np.argsort(values, kind="stable")
            values, owner = values[order], owner[order]
            found = [[], []]
            for k, x in enumerate(outside):
                if x:
                    lo, hi = np.searchsorted(values, sets[k]), np.searchsorted(values, sets[k], "right")
                    n = hi - lo
                    at = np.repeat(lo - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
                    both = np.bincount(owner[at], minlength=len(inner))
                    near = np.flatnonzero(100 * both >= PERCENT * (len(sets[k]) + size - both))
                    if len(near):
                        found[0].append(nodes[k])
                        found[1].append(nodes[inner[near[0]]])
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in found], names=["a", "b"])
    return run


def _component_links(store: Store, targets: DataFrame, label: DataFrame, texts: DataFrame, shingle: int) -> DataFrame:
    """Links of nodes with whole components, for ``targets`` (node, component, seen): with the members since turn ``seen``."""
    size = texts.select("node", "n_shingles")
    inner = label.join(targets.select("component", "seen").distinct(), "component").where("since >= seen").join(size, "node")
    outer = targets.join(size, "node")
    of = ["component", "seen"]
    blocks = inner.groupBy(*of).agg(F.ceil(F.sum("n_shingles") / BLOCK).alias("ni")) \
                  .join(outer.groupBy(*of).agg(F.ceil(F.sum("n_shingles") / BLOCK).alias("nj")), of)
    i, j = F.pmod(F.xxhash64("node"), F.col("ni")), F.pmod(F.xxhash64("node"), F.col("nj"))
    all_of = lambda n: F.explode(F.sequence(F.lit(0).cast("long"), F.col(n) - 1))
    inner = inner.join(blocks, of).select(*of, i.alias("i"), all_of("nj").alias("j"), F.lit(False).alias("outside"), "node")
    outer = outer.join(blocks, of).select(*of, all_of("ni").alias("i"), j.alias("j"), F.lit(True).alias("outside"), "node")
    rows = inner.unionByName(outer).join(texts.select("node", "text"), "node").select(*of, "i", "j", "outside", "node", "text")
    rows = rows.repartition(*of, "i", "j").sortWithinPartitions(*of, "i", "j")
    return store.keep(bk.map_batches(rows, _block_links(shingle), "a binary, b binary"))


def _texts(docs: DataFrame, near: DataFrame, shingle: int) -> DataFrame:
    """(node, n_shingles, text) of the nodes ``near``, one text each. A bitmap of SIEVE bits, whatever the
    number of nodes, leaves out most other texts before the join that decides."""
    place = F.conv(F.hex(F.substring("node", 1, 4)), 16, 10).cast("long") % SIEVE
    words = near.select(place.alias("place")).selectExpr("shiftright(place, 6) word", "shiftleft(1L, cast(place & 63 as int)) bit") \
                .groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    sieve = np.zeros(SIEVE // 64, np.int64)
    sieve[words.column("word").to_numpy()] = words.column("bits").to_numpy()
    sieve = near.sparkSession.sparkContext.broadcast(sieve)
    sketch = _sketch(shingle, False)

    def sift(batches):
        bits = sieve.value
        for batch in sketch(batches):
            batch = batch.filter(batch.column(1).is_valid()).select(["node", "n_shingles", "text"])
            at = np.frombuffer(b"".join(batch.column(0).to_pylist()), ">u4")[::4].astype(np.int64) % SIEVE
            yield batch.filter(pa.array((bits[at >> 6] >> (at & 63) & 1).astype(bool)))

    some = bk.map_batches(docs, sift, "node binary, n_shingles long, text string")
    return some.join(near, "node", "left_semi").groupBy("node").agg(F.first("n_shingles").alias("n_shingles"), F.first("text").alias("text"))


def duplicate_groups(docs: DataFrame, shingle: int = 2) -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id, kept."""
    return _verdicts(Store(docs.sparkSession, "minhash"), docs, shingle).select("doc_id", "n_shingles", "component_id", "kept")


def keep_one(docs: DataFrame, shingle: int = 2) -> DataFrame:
    """``docs`` with one row of each group: a row of its least doc_id (of several texts of this id that of
    the least set hash, of equal rows one). Rows without words are in no group and stay. Verdicts meet
    rows by doc_id and set, so that rows of one id are told apart."""
    store = Store(docs.sparkSession, "minhash-keep")
    verdicts = _verdicts(store, docs, shingle).where("kept and node is not null")
    best = verdicts.groupBy("component", "doc_id", "node").agg(F.count("*").alias("n")) \
                   .groupBy("component").agg(F.min(F.struct("node", "doc_id", "n")).alias("x"))
    best = store.keep(best.select(F.col("x.node").alias("k_node"), F.col("x.doc_id").alias("k_id"), F.col("x.n").alias("k_n")))
    names = [f"c{k}" for k in range(len(docs.columns))]      # whatever the columns are called
    at = names[docs.columns.index("text")]
    rows = docs.toDF(*names)
    schema = StructType([*rows.schema.fields, StructField("k_set", BinaryType())])

    def add_set(batches):
        for batch in batches:
            buf, off = bk.text_bytes(batch, at)
            nodes = []
            for _, _, part, part_off in bk.slices(buf, off):
                values, set_off = shingle_sets(part, part_off, shingle)
                nodes += _names(values, set_off)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(nodes, pa.binary())], names=[*names, "k_set"])

    rows = bk.map_batches(rows, add_set, schema)
    doc_id = F.col(names[docs.columns.index("doc_id")]).cast("long")
    out = rows.join(best, (F.col("k_set") == F.col("k_node")) & doc_id.eqNullSafe(F.col("k_id")), "left").where("k_set is null or k_n is not null")
    if not best.where("k_n > 1").isEmpty():
        out = store.keep(out)
        out = out.where("k_n is null or k_n = 1").unionByName(out.where("k_n > 1").dropDuplicates(["k_set"]))
    return out.select(*names).toDF(*docs.columns)


def _verdicts(store: Store, docs: DataFrame, shingle: int) -> DataFrame:
    """(doc_id, node, component, n_shingles, component_id, kept) of every row."""
    docs = docs.select("doc_id", "text")
    schema = "doc_id long, node binary, n_shingles long, "
    docs = docs.withColumn("doc_id", F.col("doc_id").cast("long"))
    bits = ", ".join(f"{b} long" for b in BITS)
    sketch = store.keep(bk.map_batches(docs, _sketch(shingle, True), f"{schema}{bits}, bands array<long>"))
    nodes = store.keep(sketch.where("node is not null").groupBy("node").agg(
        F.min("doc_id").alias("least"), F.first(F.struct("n_shingles", *BITS)).alias("set"), F.first("bands").alias("bands")))
    x = nodes.select("node", F.struct("node", "set.n_shingles", *(f"set.{b}" for b in BITS)).alias("x"))
    # buckets of one node go first, by counts alone; only then do the others' nodes travel
    entries = nodes.select("node", F.explode("bands").alias("bucket"))
    shared = entries.groupBy("bucket").agg(F.count("*").alias("n")).where("n > 1").select("bucket")
    members = store.keep(entries.join(shared, "bucket", "left_semi").select("bucket", "node"))
    near = store.keep(members.select("node").distinct())
    texts = store.keep(_texts(docs, near, shingle))
    first = members.groupBy("bucket").agg(F.min("node").alias("a"))
    pairs = members.join(first, "bucket").where("node != a").select("a", F.col("node").alias("b")).distinct()
    done = store.keep(pairs.join(x.select(F.col("node").alias("a"), F.col("x").alias("p")), "a").join(x.select(F.col("node").alias("b"), "x"), "b")
                      .where(_may_link("x", "p")).select("a", "b"))
    links = _links(store, done, texts, shingle)
    # a component keeps its name while it grows, so members bear the turn that brought them under it
    label = components(store, links).withColumn("since", F.lit(-1))
    # the sets' bits are carried only in buckets that still hold several components
    named = members.join(label.select("node", "component"), "node", "left").withColumn("component", F.coalesce("component", "node"))
    several = named.groupBy("bucket", "component").agg(F.count("*").alias("n")).groupBy("bucket").agg(F.count("*").alias("parts")).where("parts > 1").select("bucket")
    active = store.keep(members.join(several, "bucket", "left_semi").join(x, "node").select("bucket", "node", "x"))
    compared = store.keep(label.select("node", "component", F.col("since").alias("turn")).where("false"))
    turn = 0
    while True:
        # pairs still to be checked lie in buckets with members of several components
        now = active.join(label.drop("since"), "node", "left").withColumn("component", F.coalesce("component", "node"))
        sizes = now.groupBy("bucket", "component").agg(F.count("*").alias("n"))
        mixed = sizes.groupBy("bucket").agg(F.max(F.struct("n", "component")).alias("major"), F.sum("n").alias("all"), F.count("*").alias("parts")) \
                     .where("parts > 1").select("bucket", F.col("major.component").alias("major"), (F.col("all") - F.col("major.n")).alias("outside"))
        now = now.join(mixed, "bucket")
        now = store.keep(now.join(now.groupBy("node").agg(F.collect_list("bucket").alias("places")), "node"))
        if now.isEmpty():
            break
        chosen = F.pmod(F.xxhash64("node", "bucket", F.lit(turn)), F.ceil(F.col("outside") / PIVOTS)) == 0
        pivots = now.where((F.col("component") != F.col("major")) & chosen)
        large = store.keep(label.groupBy("component").count().where(F.col("count") >= LARGE).select("component"))
        targets = pivots.select("node", F.col("major").alias("component")).distinct().join(large, "component", "left_semi")
        seen = compared.groupBy("node", "component").agg(F.max("turn").alias("seen"))
        targets = store.keep(targets.join(seen, ["node", "component"], "left").withColumn("seen", F.coalesce("seen", F.lit(-1))))
        more = _component_links(store, targets, label, texts, shingle)
        other = pivots.select("bucket", F.col("x").alias("p"), F.col("component").alias("pc"), F.col("places").alias("pp"))
        rest = now.join(large.withColumnRenamed("component", "big"), F.col("major") == F.col("big"), "left") \
                  .where(F.col("big").isNull() | (F.col("component") != F.col("major")))
        # a pair that meets in several of these buckets is taken in the least: there one of the two is
        # a pivot now, or stays and will be
        once = F.array_min(F.array_intersect("places", "pp")) == F.col("bucket")
        pairs = rest.join(other, "bucket").where((F.col("component") != F.col("pc")) & _may_link("x", "p") & once) \
                    .select(F.least("node", "p.node").alias("a"), F.greatest("node", "p.node").alias("b")).distinct()
        pairs = store.keep(pairs.join(done, ["a", "b"], "left_anti"))
        more = store.keep(more.unionByName(_links(store, pairs, texts, shingle)))
        done, compared = done.unionByName(pairs), compared.unionByName(targets.select("node", "component", F.lit(turn).alias("turn")))
        if not more.isEmpty():
            links = links.unionByName(more)
            was = label.withColumnRenamed("component", "was")
            label = store.keep(components(store, links).join(was, "node", "left").select(
                "node", "component", F.when(F.col("component") == F.col("was"), F.col("since")).otherwise(turn).alias("since")))
        active = store.keep(now.join(pivots.select("bucket", "node"), ["bucket", "node"], "left_anti").select("bucket", "node", "x"))
        turn += 1
    least = nodes.select("node", "least").join(label, "node", "left").withColumn("component", F.coalesce("component", "node"))
    ids = least.groupBy("component").agg(F.min("least").alias("component_id"))
    by_node = least.join(ids, "component").select("node", "component", "component_id")
    out = sketch.select("doc_id", "node", "n_shingles").join(by_node, "node", "left")
    own = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "node", "component", "n_shingles", own.alias("component_id"), F.col("doc_id").eqNullSafe(own).alias("kept"))
