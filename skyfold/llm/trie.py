"""Operator 11, conversation prefix trie (a z-fast trie kept in Spark tables).

Members are sequences of turns; a trie node is a distinct sequence of first
turns. A prefix is known by 128 bits: the exclusive or of hashes of (position,
role, text). The compacted trie is a set of paths: a leader conversation owns
the stretch from where it left the trie (``start``) to its end, and cuts on a
stretch are the compacted nodes (branches and ends). The node between the cuts
``lo`` and ``hi`` is hashed by its handle, the prefix of the two-fattest depth
in (lo, hi], the one with most trailing zero bits.

Conversations are inserted in batches. Each finds its exit node by a fat binary
search: it looks up its own prefix at the two-fattest depth of the interval
left, goes on below the node found or else above that depth, so that the
logarithm of the longest length of lookups (joins on the handle) is enough.
Along the exit edge it is compared with the leader. Of all conversations that
leave at one place with one next turn, one drawn by hash becomes a leader and
is hung there, the others search on from that place in the next batch; the
draw meets a heavy branch likely, so batches are about the logarithm of the
number of conversations. Equal conversations are one member with a count.

At last edges are expanded to a row per depth, and sums over subtrees run up
the paths, batch by batch from the last. No step gives a place or a group of
copies whole to one task: joins meet unique keys on one side, and end lists are
hashed from pre-sorted pieces. Conversations of more than BLOCK turns are cut:
what follows hangs from the prefix at the cut like a sequence of its own.

Defined cases: null role or text is empty; rows without conv_id belong to no
conversation; turns are ordered with null first, ties by the MD5 of role, then
of text, and repeated rows are turns of their own; ``c % share`` keeps the sign
of c; an empty table has no node, not even the root. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm import bytekit as bk
from skyfold.llm.store import Store
from skyfold.operators.ranking import prefix_sum

#: Turns of one conversation that a row or a window holds at once; longer ones are cut into stretches.
BLOCK = 1 << 16
#: Ids of an end list that are sorted at once.
PIECE = 4096
#: Lookups of the search in one plan.
STEPS = 6


def turns(store: Store, conversations: DataFrame) -> DataFrame:
    """(conv_id, pos, role, text, chars): numbered turns, role and text as digests."""
    text = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(""))
    rows = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", F.unhex(F.md5(text("role"))).alias("role"), F.unhex(F.md5(text("text"))).alias("text"),
        F.length(text("text")).cast("long").alias("chars"))
    order = ["turn", "role", "text"]
    ranged = store.keep(rows.repartitionByRange("conv_id", *order).withColumn("part", F.spark_partition_id()).withColumn("one", F.lit(1).cast("long")))
    return prefix_sum(ranged, ["conv_id"], order, "one", F.col("part"), "before").select("conv_id", (F.col("before") + 1).alias("pos"), "role", "text", "chars")


def shared_heads(numbered: DataFrame, share: int = 100, heads: int = 6) -> DataFrame:
    """(conv_id, pos, role, text, chars): of every conversation c the first h turns of c - c % share
    (h: crc32 of c modulo ``heads``), then its own turns after its first h."""
    own = numbered.withColumn("base", F.col("conv_id") - F.col("conv_id") % share) \
                  .withColumn("h", F.crc32(F.col("conv_id").cast("string").cast("binary")) % heads)
    ids = own.select("conv_id", "base", "h").distinct()
    first = numbered.where((F.col("conv_id") % share == 0) & (F.col("pos") < heads)).withColumnRenamed("conv_id", "base")
    taken = ids.join(first, "base").where("pos <= h").select("conv_id", "pos", "role", "text", "chars")
    have = first.groupBy("base").agg(F.max("pos").alias("have"))
    rest = own.where("pos > h").join(have, "base", "left") \
              .select("conv_id", (F.least("h", F.coalesce("have", F.lit(0))) + F.col("pos") - F.col("h")).alias("pos"), "role", "text", "chars")
    return taken.unionByName(rest)


def prefixes(rows: DataFrame) -> DataFrame:
    """(conv_id, pos, p, q, p0, q0, chars, upto): p and q are the 128 bits of the first ``pos`` turns, p0
    and q0 those of one turn less, ``upto`` the code points. Windows hold BLOCK turns at most, then
    one row per block."""
    lane = lambda seed: F.xxhash64(F.lit(seed), "pos", "role", "text")
    rows = rows.select("conv_id", F.col("pos").cast("long").alias("pos"), F.col("chars").cast("long").alias("chars"), lane(1).alias("x"), lane(2).alias("y"),
                       F.floor((F.col("pos") - 1) / BLOCK).alias("blk"))
    inner = Window.partitionBy("conv_id", "blk").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    outer = Window.partitionBy("conv_id").orderBy("blk").rowsBetween(Window.unboundedPreceding, -1)
    sums = {"x": F.bit_xor, "y": F.bit_xor, "chars": F.sum}
    total = rows.groupBy("conv_id", "blk").agg(*[fn(c).alias(c) for c, fn in sums.items()])
    total = total.select("conv_id", "blk", *[F.coalesce(fn(c).over(outer), F.lit(0)).alias(f"{c}_before") for c, fn in sums.items()])
    rows = rows.withColumns({f"{c}_in": fn(c).over(inner) for c, fn in sums.items()}).join(total, ["conv_id", "blk"])
    p, q = (F.col(f"{c}_in").bitwiseXOR(F.col(f"{c}_before")) for c in "xy")
    return rows.select("conv_id", "pos", p.alias("p"), q.alias("q"), p.bitwiseXOR(F.col("x")).alias("p0"), q.bitwiseXOR(F.col("y")).alias("q0"),
                       "chars", (F.col("chars_in") + F.col("chars_before")).alias("upto"))


def segments(path: DataFrame) -> DataFrame:
    """(g, base, p0, q0, end, p, q, steps): conversations cut into stretches (base, end] of BLOCK turns at
    most, equal ones once; p0, q0 and p, q are the prefixes at both ends, ``steps`` (p, q, chars, upto) all between."""
    cut = path.groupBy("conv_id", (F.floor((F.col("pos") - 1) / BLOCK) * BLOCK).alias("base")).agg(
        F.min(F.struct("pos", "p0", "q0")).alias("first"), F.max(F.struct("pos", "p", "q")).alias("last"), F.sort_array(F.collect_list(F.struct("pos", "p", "q", "chars", "upto"))).alias("steps"))
    cut = cut.select("conv_id", "base", "first.p0", "first.q0", F.col("last.pos").alias("end"), "last.p", "last.q", "steps")
    once = cut.groupBy("end", "p", "q").agg(F.min_by(F.struct("conv_id", "base", "p0", "q0", "steps"), "conv_id").alias("s"))
    return once.select(F.struct(F.col("s.conv_id").alias("conv_id"), F.col("s.base").alias("base")).alias("g"), "s.base", "s.p0", "s.q0", "end", "p", "q", "s.steps")


def two_fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] with most trailing zero bits."""
    zeros = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return high - high % F.pow(F.lit(2), zeros).cast("long")


def _step(pos: Column) -> Column:
    return F.get(F.col("steps"), (pos - F.col("base") - 1).cast("int"))


def _search(found: DataFrame, nodes: DataFrame, lookups: int) -> DataFrame:
    """Fat binary search: ``found`` (.., base, steps, l, r, low) moves to the deepest node whose handle is a
    prefix of the stretch, ``low`` being the depth of that node's parent."""
    nodes = nodes.select("fat", "p", "q", "lo", "hi")
    own = [c for c in found.columns if c not in ("l", "r", "low")]
    for _ in range(lookups):
        found = found.withColumn("fat", F.when(F.col("l") < F.col("r"), two_fattest(F.col("l"), F.col("r"))))
        found = found.withColumns({"p": _step(F.col("fat"))["p"], "q": _step(F.col("fat"))["q"]}).join(nodes, ["fat", "p", "q"], "left")
        miss = F.col("hi").isNull() & F.col("fat").isNotNull()
        found = found.select(*own, F.coalesce("hi", "l").alias("l"), F.when(miss, F.col("fat") - 1).otherwise(F.col("r")).alias("r"), F.coalesce("lo", "low").alias("low"))
    return found


def _exits(found: DataFrame, edges: DataFrame) -> DataFrame:
    """``found`` with the place where each stretch leaves the trie: leader ``up`` (null at the root) and depth ``m``."""
    # from the parent of the node found on, the deepest prefix shared with a leader
    rest = F.slice("steps", (F.col("low") - F.col("base") + 1).cast("int"), F.size("steps"))
    walk = found.select("g", F.explode(rest).alias("s")).select("g", "s.pos", "s.p", "s.q")
    met = walk.join(edges.select(F.col("g").alias("up"), "pos", "p", "q"), ["pos", "p", "q"])
    met = met.groupBy("g").agg(F.max(F.struct("pos", "up")).alias("x"))
    found = found.join(met, "g", "left")
    return found.select("g", "base", "p0", "q0", "end", "steps", F.coalesce("x.pos", "low").alias("m"), F.col("x.up").alias("up"))


def _nodes(leaders: DataFrame, cuts: DataFrame) -> DataFrame:
    """Compacted nodes: the prefix (p, q) at the handle ``fat`` of each stretch (lo, hi] between cuts."""
    on = cuts.join(leaders.select("g", "base", "start", "steps"), "g")
    on = on.withColumn("lo", F.coalesce(F.lag("hi").over(Window.partitionBy("g").orderBy("hi")), "start"))
    on = on.withColumn("fat", two_fattest(F.col("lo"), F.col("hi")))
    return on.select("lo", "hi", "fat", _step(F.col("fat"))["p"].alias("p"), _step(F.col("fat"))["q"].alias("q"))


def insert_all(store: Store, segs: DataFrame) -> tuple[DataFrame, int]:
    """Inserts the stretches ``segs`` in batches. Returns a row for each depth of the leaders' own stretches
    (g, pos, p, q, chars, upto, base, p0, q0, start, up, end, turn), and the number of batches."""
    todo, turn = segs.select("g", "base", "p0", "q0", "end", "steps", F.col("base").alias("l")), 0
    leaders, cuts, edges = [], [], []
    union = lambda parts: reduce(DataFrame.unionByName, parts)
    while True:
        if not turn:            # the empty trie: everything leaves at the root
            out = todo.select("g", "base", "p0", "q0", "end", "steps", F.col("base").alias("m"), F.lit(None).cast(segs.schema["g"].dataType).alias("up"))
        else:
            nodes = store.keep(_nodes(union(leaders), union(cuts).distinct()))
            # the place where it left before is a node by now, and the search goes on below it
            found, left = todo.withColumns({"r": F.col("end"), "low": F.col("l")}), BLOCK.bit_length()
            if turn == 1:
                longest = (segs.agg(F.max("end")).first()[0] or 0).bit_length()
            left = min(left, longest)
            while left > STEPS:
                found, left = store.keep(_search(found, nodes, STEPS)), left - STEPS
            out = _exits(_search(found, nodes, left), union(edges))
        # the next turn of its own names the branch
        out = store.keep(out.withColumns({"b": _step(F.col("m") + 1)["p"], "c": _step(F.col("m") + 1)["q"]}))
        rest = out.where("m < end")
        drawn = rest.groupBy("b", "c").agg(F.min_by(F.struct("g", "base", "p0", "q0", "end", "steps", "m", "up"), F.xxhash64(F.lit(turn), "g")).alias("x"))
        new = store.keep(drawn.select("x.*").withColumnRenamed("m", "start").withColumn("turn", F.lit(turn)))
        after = F.slice("steps", (F.col("start") - F.col("base") + 1).cast("int"), F.size("steps"))
        edge = new.select("g", "base", "p0", "q0", "start", "up", "end", "turn", F.explode(after).alias("s"))
        edges.append(store.keep(edge.select("g", "s.*", "base", "p0", "q0", "start", "up", "end", "turn")))
        leaders.append(new)
        inside = out.where("m = end").select(F.col("up").alias("g"), F.col("m").alias("hi"))
        cuts += [new.select("g", F.col("end").alias("hi")), new.where("up is not null").select(F.col("up").alias("g"), F.col("start").alias("hi")), inside]
        todo = store.keep(rest.join(new.select("g"), "g", "left_anti").select("g", "base", "p0", "q0", "end", "steps", F.col("m").alias("l")))
        turn += 1
        if todo.isEmpty():
            return union(edges), turn


def _end_hashes(batches):
    """Rows (len, p, q, piece) sorted by place and piece to the SHA-256 of each place's pieces, comma-joined."""
    place, sha = None, None

    def row():
        return pa.RecordBatch.from_arrays([*(pa.array([x], pa.int64()) for x in place), pa.array([sha.hexdigest()])], names=["pos", "p", "q", "ends_sha256"])

    for batch in batches:
        for *key, piece in zip(*(batch.column(k).to_pylist() for k in range(4))):
            if key != place:
                if place is not None:
                    yield row()
                place, sha = key, hashlib.sha256(piece.encode())
            else:
                sha.update(b"," + piece.encode())
    if place is not None:
        yield row()


def end_hashes(convs: DataFrame) -> DataFrame:
    """(pos, p, q, ends_sha256) of each place (len, p, q) at which conversations end; ids are sorted
    in pieces of neighbouring ids, and one stream hashes a place's pieces."""
    pieces = convs.groupBy("len", "p", "q", F.floor(F.col("conv_id") / PIECE).alias("piece")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    rows = pieces.select("len", "p", "q", "piece", F.array_join(F.col("ids").cast("array<string>"), ",").alias("ids"))
    rows = rows.repartition("len", "p", "q").sortWithinPartitions("len", "p", "q", "piece").select("len", "p", "q", "ids")
    return bk.map_batches(rows, _end_hashes, "pos long, p long, q long, ends_sha256 string")


def trie(store: Store, ids: DataFrame, rows: DataFrame) -> DataFrame:
    """All nodes of the trie of the sequences ``rows`` (conv_id, pos, role, text, chars); ``ids``
    (conv_id) are the members, those without rows too. One row per node: conv_id, depth,
    parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256."""
    path = store.keep(prefixes(rows))
    zero, none = F.lit(0).cast("long"), lambda c: F.coalesce(c, F.lit(0).cast("long"))
    ends = path.groupBy("conv_id").agg(F.max(F.struct("pos", "p", "q")).alias("x"))
    convs = store.keep(ids.join(ends, "conv_id", "left").select("conv_id", none("x.pos").alias("len"), none("x.p").alias("p"), none("x.q").alias("q")))
    segs = store.keep(segments(path))
    edges, batches = insert_all(store, segs)

    # a row per depth, with the members that end there; stretches that begin at a cut of BLOCK turns hang from the prefix there
    at = convs.groupBy(F.col("len").alias("pos"), "p", "q").agg(F.count("*").alias("n_end"), F.min("conv_id").alias("least_end"))
    steps = store.keep(edges.join(at, ["pos", "p", "q"], "left"))
    bases = [r[0] for r in segs.select("base").distinct().orderBy(F.desc("base")).collect()]
    if len(bases) > 1:
        under = steps.select(F.col("g").alias("found"), F.col("pos").alias("start"), F.col("p").alias("p0"), F.col("q").alias("q0"))
        hung = (F.col("up").isNull()) & (F.col("start") > 0)
        tied = steps.where(hung).join(under, ["start", "p0", "q0"]).withColumn("up", F.col("found")).select(*steps.columns)
        steps = store.keep(steps.where(~hung).unionByName(tied))

    # sums run up each stretch and on to the one it hangs from
    levels, below = [], None
    up = Window.partitionBy("g").orderBy(F.col("pos").desc()).rowsBetween(Window.unboundedPreceding, 0)
    for base, turn in [(b, t) for b in bases for t in reversed(range(batches))]:
        level = steps.where((F.col("turn") == turn) & (F.col("base") == base))
        if below is not None:
            level = level.join(below.where("g is not null"), ["g", "pos"], "left")
        else:
            level = level.withColumns({c: F.lit(None).cast("long") for c in ("b_n", "b_least", "b_leaves", "b_saved", "b_count")})
        level = level.withColumns({"own_n": none("n_end") + none("b_n"), "n_children": none("b_count") + (F.col("pos") < F.col("end")).cast("long")})
        total = lambda c: F.sum(c).over(up)
        # the sum of (n_convs - 1) * chars from here to the end, by the members that end at each depth
        level = level.withColumns({"n_convs": total("own_n"), "least": F.min(F.least("least_end", "b_least")).over(up), "n_leaves": total(none("b_leaves") + (F.col("n_children") == 0).cast("long")),
                                   "saved_tokens": total(F.col("own_n") * F.col("upto")) - total("own_n") * (F.col("upto") - F.col("chars")) + total(none("b_saved") - F.col("chars"))})
        level = store.keep(level.select("g", "pos", "p", "q", "start", "up", "least", "n_convs", "n_children", "n_leaves", "saved_tokens"))
        levels.append(level)
        below = reduce(DataFrame.unionByName, levels).where("pos = start + 1").groupBy(F.col("up").alias("g"), F.col("start").alias("pos")).agg(
            F.sum("n_convs").alias("b_n"), F.min("least").alias("b_least"), F.sum("n_leaves").alias("b_leaves"), F.sum("saved_tokens").alias("b_saved"), F.count("*").alias("b_count"))

    # the root, and every node's parent
    own = convs.agg(F.min("conv_id").alias("least"), F.count("*").alias("n_convs"))
    kept = ["g", "pos", "p", "q", "up_pos", "least", "n_convs", "n_children", "n_leaves", "saved_tokens"]
    kind = segs.schema["g"].dataType
    if levels:
        hung = below.where("g is null").select(F.col("b_leaves").alias("n_leaves"), F.col("b_saved").alias("saved_tokens"), F.col("b_count").alias("n_children"))
        own = own.unionByName(hung, allowMissingColumns=True).agg(F.min("least").alias("least"), *[F.sum(c).alias(c) for c in ("n_convs", "n_leaves", "saved_tokens", "n_children")])
    else:
        own = own.withColumns({c: F.lit(None).cast("long") for c in ("n_leaves", "saved_tokens", "n_children")})
    nodes = own.where("n_convs > 0").select(F.lit(None).cast(kind).alias("g"), zero.alias("pos"), zero.alias("p"), zero.alias("q"), F.lit(-1).cast("long").alias("up_pos"), "least", "n_convs",
                                            none("n_children").alias("n_children"), F.coalesce("n_leaves", F.lit(1)).alias("n_leaves"), none("saved_tokens").alias("saved_tokens"))
    nodes = nodes.withColumn("up_g", F.col("g"))
    if levels:
        below_own = F.col("pos") > F.col("start") + 1
        done = reduce(DataFrame.unionByName, levels)
        nodes = nodes.unionByName(done.select(*(c for c in kept if c != "up_pos"), F.when(below_own, F.col("g")).otherwise(F.col("up")).alias("up_g"), (F.col("pos") - 1).alias("up_pos")))
    nodes = store.keep(nodes)
    key = lambda g, pos: F.struct(F.col(f"{g}.conv_id"), F.col(f"{g}.base"), F.col(pos))
    parents = nodes.select(key("g", "pos").alias("place"), F.col("least").alias("parent_conv_id"))
    nodes = nodes.withColumn("place", key("up_g", "up_pos")).join(parents, "place", "left").join(end_hashes(convs), ["pos", "p", "q"], "left")
    return nodes.select(F.col("least").alias("conv_id"), F.col("pos").alias("depth"), "parent_conv_id", "n_convs", "n_children", "n_leaves",
                        "saved_tokens", F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"))
