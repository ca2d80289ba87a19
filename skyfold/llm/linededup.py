"""Operator 6, line dedup by overlapping three-line windows (built-in functions only).

Every three consecutive lines of a document make a window, kept as two 64-bit
hashes. A window that occurs more than once in the corpus stays where it
comes first, in the order (doc_id, place); at every later place its lines go.
Windows overlap, so the covered places are merged into runs before cutting.

Only hashes are exploded and shuffled by window; a hot window is aggregated
map-side, and its join is split by adaptive execution. Runs are made inside
one document.

Defined cases: documents of fewer than three lines (or null text) have no
window and stay as they are; windows of three blank lines are not counted;
a document that loses all its lines keeps an empty text; a null doc_id comes
last; rows that repeat one doc_id and text are one document, so each keeps what
that document keeps.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from skyfold.llm.names import free_names, shielded

LINES = 3
_KEY = ["_sk_null", "_sk_id", "_sk_t1", "_sk_t2"]


def _keyed(docs: DataFrame) -> DataFrame:
    """The document's identity and place in the order, as four columns without nulls."""
    return docs.withColumns({
        "_sk_null": F.col("doc_id").isNull(), "_sk_id": F.coalesce(F.col("doc_id").cast("long"), F.lit(0)),
        "_sk_t1": F.xxhash64("text"), "_sk_t2": F.xxhash64(F.lit(1), "text")})


def _lines() -> Column:
    return F.split("text", "\n", -1)


def windows(keyed: DataFrame, lines: int = LINES) -> DataFrame:
    """(document key, at, w1, w2): the two hashes of the window that begins at line ``at`` (0-based)."""
    hashed = keyed.select(*_KEY, F.transform(_lines(), lambda x: F.struct(
        F.xxhash64(x).alias("a"), F.xxhash64(F.lit(1), x).alias("b"), (F.trim(x) == "").alias("blank"))).alias("h"))

    def window(x: Column, i: Column) -> Column:
        rest = [F.get("h", i + k) for k in range(1, lines)]
        blank = x["blank"]
        for r in rest:
            blank = blank & r["blank"]
        return F.struct(F.xxhash64(x["a"], *[r["a"] for r in rest]).alias("w1"),
                        F.xxhash64(x["b"], *[r["b"] for r in rest]).alias("w2"), blank.alias("blank"))

    starts = F.slice("h", F.lit(1), F.greatest(F.size("h") - (lines - 1), F.lit(0)))
    return hashed.where(F.size("h") >= lines).select(*_KEY, F.posexplode(F.transform(starts, window)).alias("at", "w")) \
                 .where("not w.blank").select(*_KEY, "at", "w.w1", "w.w2")


def later_windows(keyed: DataFrame, lines: int = LINES) -> DataFrame:
    """The windows that occur earlier, in this document or in another."""
    all_windows = windows(keyed, lines)
    place = F.struct(*_KEY, "at")
    repeated = all_windows.groupBy("w1", "w2").agg(F.min(place).alias("first"), F.max(place).alias("last")).where("first != last")
    return all_windows.join(repeated.select("w1", "w2", "first"), ["w1", "w2"]).where(place != F.col("first")).select(*_KEY, "at")


def covered_runs(later: DataFrame, lines: int = LINES) -> DataFrame:
    """(document key, runs): the merged runs [from, to) of covered lines, in order."""
    by_doc = Window.partitionBy(*_KEY).orderBy("at")
    new = F.col("at") > F.coalesce(F.lag("at").over(by_doc) + lines, F.lit(-1))
    runs = later.withColumn("new", new.cast("int")).withColumn("run", F.sum("new").over(by_doc)) \
                .groupBy(*_KEY, "run").agg(F.min("at").alias("from"), (F.max("at") + lines).alias("to"))
    return runs.groupBy(*_KEY).agg(F.sort_array(F.collect_list(F.struct("from", "to"))).alias("_sk_runs"))


def dedup_lines(docs: DataFrame, lines: int = LINES) -> DataFrame:
    """``docs`` with the text cut, and as the last columns ``_sk_lines`` (number of lines before) and
    ``_sk_removed``; the names get leading underscores where ``docs`` has such columns."""
    inner = shielded(docs)
    keyed = _keyed(inner)
    runs = covered_runs(later_windows(keyed.select(*_KEY, "text"), lines), lines)
    out = keyed.join(runs, _KEY, "left").withColumn("_sk_split", _lines())
    end = F.struct(F.size("_sk_split").alias("from"), F.size("_sk_split").alias("to"))
    gaps = F.concat("_sk_runs", F.array(end))

    def before(run: Column, i: Column) -> Column:
        """The lines between the previous run and this one."""
        done = F.when(i == 0, F.lit(0)).otherwise(F.get("_sk_runs", i - 1)["to"])
        return F.slice("_sk_split", done + 1, run["from"] - done)

    kept = F.array_join(F.flatten(F.transform(gaps, before)), "\n")
    removed = F.aggregate("_sk_runs", F.lit(0), lambda a, r: a + r["to"] - r["from"])
    return out.withColumns({
        "text": F.when(F.col("_sk_runs").isNull(), F.col("text")).otherwise(kept),
        "_sk_lines": F.coalesce(F.size("_sk_split"), F.lit(0)).cast("long"),
        "_sk_removed": F.coalesce(removed, F.lit(0)).cast("long")}).select(*inner.columns, "_sk_lines", "_sk_removed") \
        .toDF(*docs.columns, *free_names(docs.columns, "_sk_lines", "_sk_removed"))
