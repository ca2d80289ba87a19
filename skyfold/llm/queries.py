"""Driver queries of the operators: opN_<name> over its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from skyfold.llm import audit, bpe, decontaminate, importance, langid, linededup, minhash, pieces, quality, repeats, toxicity, trie, warc
from skyfold.llm.store import Store

Job = Callable[[SparkSession, str], DataFrame]


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pieces.encode(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = Store(spark, "warc").path("archives")
    warc.write_warc(warc.plan_records(_table(spark, sf_dir, "pages")), path)
    return warc.read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op3_importance(spark: SparkSession, sf_dir: str) -> DataFrame:
    return importance.resample(Store(spark, "importance"), _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op4_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op5_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.duplicate_groups(_table(spark, sf_dir, "documents"), shingle=2)


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = linededup.dedup_lines(_table(spark, sf_dir, "documents").select("doc_id", "text"))
    return out.select("doc_id", F.col("_sk_lines").alias("n_lines"), F.col("_sk_removed").alias("n_removed"), "text")


def op7_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(_table(spark, sf_dir, "documents"))


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    out = langid.identify(docs.select("doc_id", "text"), langid.fit(Store(spark, "langid"), docs))
    return out.select("doc_id", langid.held_out(F.col("doc_id")).alias("held_out"), F.col("_sk_lang").alias("lang_pred"), F.col("_sk_score").alias("score"))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.judge(Store(spark, "quality"), _table(spark, sf_dir, "documents"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    classifier = toxicity.fit(Store(spark, "toxicity"), docs, _table(spark, sf_dir, "labels"))
    out = toxicity.scores(docs.select("doc_id", "text"), classifier)
    return out.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), F.col("_sk_score").alias("score"),
                      (F.col("_sk_score") >= 0.5).cast("int").alias("predicted"))


def op11_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    store = Store(spark, "trie")
    turns = store.keep(trie.turns(store, _table(spark, sf_dir, "conversations")))
    return trie.trie(store, turns.select("conv_id").distinct(), trie.shared_heads(turns))


def op12_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = bpe.decode(bpe.encode(_table(spark, sf_dir, "documents").select("doc_id", "text").withColumn("text", F.coalesce("text", F.lit("")))).drop("text"))
    ids = F.array_join(F.col("token_ids").cast("array<string>"), " ")
    return out.select("doc_id", "n_tokens", F.sha2(ids, 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.audit(audit.failures(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")))


QUERIES: dict[str, Job] = {f.__name__: f for f in (
    op1_sentencepiece, op2_warc, op3_importance, op4_decontamination, op5_minhash, op6_line_dedup, op7_repeats, op8_language_id, op9_quality_rules, op10_toxicity,
    op11_conversation_trie, op12_bpe, op13_filter_audit)}

ORACLE_SQL: dict[str, str] = {
    "op2_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
q AS (SELECT page_id, strlen(payload)::BIGINT AS payload_bytes, sha256(payload) AS payload_digest FROM p),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM q WHERE payload_bytes >= 100 GROUP BY 1)
SELECT q.page_id, q.payload_bytes, q.payload_digest,
       CASE WHEN f.first_id < q.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < q.page_id THEN f.first_id END AS refers_to
FROM q LEFT JOIN f USING (payload_digest)""",
    "op4_decontamination": r"""
WITH b AS (SELECT CAST(item_id AS VARCHAR) AS item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                  '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark WHERE text IS NOT NULL),
d AS (SELECT doc_id, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
             '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents),
f AS (SELECT item_id, w, unnest(range(1, len(w) - 8)) AS p FROM b WHERE len(w) >= 10),
k AS (SELECT DISTINCT item_id, 10 AS n, array_to_string(w[p:p + 9], ' ') AS words FROM f
      UNION SELECT item_id, len(w), array_to_string(w, ' ') FROM b WHERE len(w) BETWEEN 1 AND 9),
s AS (SELECT DISTINCT n FROM k),
g AS (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS p FROM d, s WHERE len(w) >= n),
h AS (SELECT doc_id, item_id, p, n FROM (SELECT doc_id, p, n, array_to_string(w[p:p + n - 1], ' ') AS words FROM g) x JOIN k USING (n, words)),
c AS (SELECT doc_id, count(DISTINCT word) AS n_hit FROM (SELECT doc_id, unnest(range(p, p + n)) AS word FROM h) y GROUP BY doc_id),
i AS (SELECT doc_id, list_sort(list(DISTINCT item_id)) AS items FROM h GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN c USING (doc_id) LEFT JOIN i USING (doc_id)""",
    "op6_line_dedup": """
WITH d AS (SELECT doc_id, text, string_split(text, chr(10)) AS l FROM documents),
w AS (SELECT doc_id, unnest(range(len(l) - 2)) AS p, l FROM d WHERE len(l) >= 3),
v AS (SELECT doc_id, p, l[p + 1] AS a, l[p + 2] AS b, l[p + 3] AS c FROM w),
r AS (SELECT *, row_number() OVER (PARTITION BY a, b, c ORDER BY doc_id, p) AS n FROM v
      WHERE trim(a, ' ') <> '' OR trim(b, ' ') <> '' OR trim(c, ' ') <> ''),
x AS (SELECT doc_id, list_distinct(flatten(list([p, p + 1, p + 2]))) AS gone FROM r WHERE n > 1 GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(l), 0)::BIGINT AS n_lines, coalesce(len(gone), 0)::BIGINT AS n_removed,
       CASE WHEN gone IS NULL THEN text
            ELSE array_to_string(list_filter(l, lambda y, i: NOT list_contains(gone, i - 1)), chr(10)) END AS text
FROM d LEFT JOIN x USING (doc_id)""",
    "op11_conversation_trie": """
WITH i AS (SELECT conv_id, md5(coalesce(role, '')) AS r, md5(coalesce(text, '')) AS t, length(coalesce(text, '')) AS chars,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(coalesce(role, '')), md5(coalesce(text, ''))) AS pos
           FROM conversations WHERE conv_id IS NOT NULL),
z AS (SELECT DISTINCT conv_id, conv_id - conv_id % 100 AS base, conv_id::VARCHAR AS s FROM i),
c AS (SELECT conv_id, base, xor(4294967295, list_reduce(list_transform(range(1, length(s) + 1), lambda k: ascii(s[k])::BIGINT), lambda a, b:
             list_reduce([xor(a, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda u, v: xor(u >> 1, (u & 1) * 3988292384)), 4294967295)) % 6 AS h FROM z),
f AS (SELECT conv_id AS base, max(pos) AS have FROM i WHERE conv_id % 100 = 0 AND pos < 6 GROUP BY 1),
n AS (SELECT c.conv_id, i.pos, r, t, chars FROM c JOIN i ON i.conv_id = base AND i.pos <= h
      UNION ALL
      SELECT c.conv_id, least(h, coalesce(have, 0)) + i.pos - h, r, t, chars FROM c JOIN i USING (conv_id) LEFT JOIN f USING (base) WHERE i.pos > h),
p AS (SELECT conv_id, pos, chars, string_agg(r || t, '') OVER (PARTITION BY conv_id ORDER BY pos) AS k, max(pos) OVER (PARTITION BY conv_id) AS len FROM n
      UNION ALL SELECT conv_id, 0, 0, '', coalesce((SELECT max(pos) FROM n WHERE n.conv_id = c.conv_id), 0) FROM c),
a AS (SELECT k, pos AS depth, min(conv_id) AS conv_id, count(*) AS n_convs, any_value(chars) AS chars, list(conv_id ORDER BY conv_id) FILTER (len = pos) AS ends FROM p GROUP BY ALL),
b AS (SELECT k, depth, conv_id, n_convs, (n_convs - 1) * (CASE WHEN depth = 0 THEN 0 ELSE chars END) AS own, ends FROM
      (SELECT k, depth, min(conv_id) AS conv_id, sum(n_convs)::BIGINT AS n_convs, min(chars) AS chars, list_sort(flatten(list(ends) FILTER (ends IS NOT NULL))) AS ends FROM a GROUP BY k, depth)),
d AS (SELECT left(k, 64 * (depth - 1)) AS k, count(*) AS n_children FROM b WHERE depth > 0 GROUP BY 1),
e AS (SELECT b.*, coalesce(n_children, 0) AS n_children FROM b LEFT JOIN d USING (k)),
g AS (SELECT left(k, 64 * unnest(range(depth + 1))) AS k, own, (n_children = 0)::INT AS leaf FROM e),
s AS (SELECT k, sum(own)::BIGINT AS saved_tokens, sum(leaf)::BIGINT AS n_leaves FROM g GROUP BY k)
SELECT e.conv_id, e.depth::BIGINT AS depth, u.conv_id AS parent_conv_id, e.n_convs, e.n_children::BIGINT AS n_children, n_leaves, saved_tokens,
       sha256(coalesce(array_to_string(e.ends, ','), '')) AS ends_sha256
FROM e JOIN s USING (k) LEFT JOIN e u ON e.depth > 0 AND u.k = left(e.k, 64 * (e.depth - 1))""",
    "op13_filter_audit": r"""
WITH t AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS s FROM documents),
w AS (SELECT *, regexp_extract_all(s, '[^\x20\x09-\x0D]+') AS l FROM t),
f AS (SELECT s, min(doc_id) AS first FROM t GROUP BY s),
b AS (SELECT doc_id, bool_or(coalesce(quality = 1, false)) AS good, bool_or(coalesce(toxic = 1, false)) AS bad FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (SELECT part, coalesce(good, false) AS good, coalesce(bad, false) AS bad,
             (len(l) < 200)::INT + 2 * (100 * len(list_distinct(l)) < 50 * len(l))::INT
             + 4 * (100 * length(regexp_replace(s, '[^A-Z]', '', 'g')) > 3 * length(s))::INT
             + 8 * regexp_matches(s, '[#$%&*|]')::INT + 16 * coalesce(first < doc_id, false)::INT AS mask
      FROM w JOIN f USING (s) LEFT JOIN b USING (doc_id)),
c AS (SELECT part, good, bad, mask, count(*) AS n FROM d GROUP BY ALL),
x AS (SELECT chr(65 + i::INT) AS a, (1 << i::INT) AS bit FROM range(5) r(i)),
o AS (SELECT x1.a || x2.a || x3.a || x4.a || x5.a AS filter_order, [x1.bit, x2.bit, x3.bit, x4.bit, x5.bit] AS bits
      FROM x x1, x x2, x x3, x x4, x x5 WHERE x1.bit | x2.bit | x3.bit | x4.bit | x5.bit = 31),
s AS (SELECT filter_order, k::INT AS step, bits[k] AS bit, list_sum(bits[1:k - 1])::INT AS earlier FROM o, range(1, 6) r(k)),
r AS (SELECT part, filter_order, step, bit,
             sum(n) FILTER (mask & (coalesce(earlier, 0) | bit) = 0) AS kept,
             sum(n) FILTER (mask & coalesce(earlier, 0) = 0 AND mask & bit <> 0) AS removed,
             sum(n) FILTER (mask & coalesce(earlier, 0) <> 0 AND mask & bit <> 0) AS redundant,
             sum(n) FILTER (mask = bit) AS unique_fails,
             sum(n) FILTER (mask & coalesce(earlier, 0) = 0 AND mask & bit <> 0 AND good) AS good_lost,
             sum(n) FILTER (mask & coalesce(earlier, 0) = 0 AND mask & bit <> 0 AND bad) AS toxic_lost
      FROM c, s GROUP BY ALL)
SELECT part, filter_order, step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed, coalesce(redundant, 0)::BIGINT AS redundant,
       coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost, coalesce(toxic_lost, 0)::BIGINT AS toxic_lost,
       coalesce(sum(removed) OVER (PARTITION BY part, bit), 0)::BIGINT AS shapley
FROM r""",
}


def queries() -> dict[str, Job]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(ORACLE_SQL)
