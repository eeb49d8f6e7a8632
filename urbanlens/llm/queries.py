"""The numbered queries: each applies its operator to the whole of its table.

``QUERIES`` maps names to ``fn(spark, sf_dir)``; ``ORACLES`` holds DuckDB SQL
where SQL can express the result at a bearable price. The digests a query's
contract names are made here from the operator's own results.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from urbanlens.llm import (bestfit, decontaminate, filter_audit, hmm, packing, periodic, pii, quality, rules, sharding, simhash,
                           substring_dedup, toxicity)
from urbanlens.llm.text import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(fn=None, *, sql: str | None = None):
    if fn is None:
        return lambda f: query(f, sql=sql)
    QUERIES[fn.__name__] = fn
    if sql:
        ORACLES[fn.__name__] = sql
    return fn


_SPACE_WORDS, _ALNUM_WORDS = r"'[^\x20\x09-\x0D]+'", r"'[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'"
_FOLD = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _grams(words: str, key: str, size: int) -> str:
    """All runs of ``size`` words of a table (key, pos, word)."""
    return f"""SELECT {key}, pos, {size} AS s, gram FROM (SELECT {key}, pos, string_agg(word, ' ') OVER f AS gram, count(*) OVER f AS n
  FROM {words} WINDOW f AS (PARTITION BY {key} ORDER BY pos ROWS BETWEEN CURRENT ROW AND {size - 1} FOLLOWING)) WHERE n = {size}"""


_SUBSTRINGS = f"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), {_SPACE_WORDS}) AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM w),
g AS (SELECT doc_id, pos, md5(gram) AS h FROM ({_grams('t', 'doc_id', 50)})),
m AS (SELECT h, min(doc_id) AS first FROM g GROUP BY h HAVING min(doc_id) < max(doc_id)),
bad AS (SELECT DISTINCT doc_id, unnest(range(pos, pos + 50)) AS pos FROM g JOIN m USING (h) WHERE doc_id > first),
k AS (SELECT t.doc_id, count(bad.pos) AS gone, string_agg(CASE WHEN bad.pos IS NULL THEN word END, ' ' ORDER BY t.pos) AS kept
  FROM t LEFT JOIN bad ON t.doc_id = bad.doc_id AND t.pos = bad.pos GROUP BY t.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(gone, 0) AS BIGINT) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN k USING (doc_id)"""

_CONTAMINATION = f"""
WITH w AS (SELECT doc_id, regexp_extract_all({_FOLD}, {_ALNUM_WORDS}) AS ws FROM documents),
t AS (SELECT doc_id, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM w),
iw AS (SELECT row_number() OVER () AS r, item_id, regexp_extract_all({_FOLD}, {_ALNUM_WORDS}) AS ws FROM benchmark),
it AS (SELECT r, unnest(ws) AS word, unnest(range(len(ws))) AS pos FROM iw),
ig AS (SELECT DISTINCT CAST(item_id AS VARCHAR) AS item, s, gram FROM iw JOIN (
  {' UNION ALL '.join(_grams('it', 'r', s) for s in range(1, 11))}) USING (r) WHERE s = least(len(ws), 10)),
hit AS (SELECT doc_id, pos, h.s, item FROM (
  {' UNION ALL '.join(_grams(f'(SELECT * FROM t WHERE {s} IN (SELECT s FROM ig))', 'doc_id', s) for s in range(1, 11))}) h
  JOIN ig ON h.gram = ig.gram AND h.s = ig.s),
words AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(pos, pos + s)) AS p FROM hit) GROUP BY doc_id),
items AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS names FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words, CAST(coalesce(words.n, 0) AS BIGINT) AS n_hit, CAST(coalesce(items.n, 0) AS BIGINT) AS n_items,
  sha256(coalesce(names, '')) AS items_sha256, coalesce(words.n, 0) > 0 AS contaminated
FROM w LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)"""


_AUDIT = f"""
WITH w AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), {_SPACE_WORDS}) AS ws FROM documents),
f AS (SELECT doc_id, part, CAST(len(ws) < 100 AS INT) + 2 * CAST(100 * len(list_distinct(ws)) < 80 * len(ws) AS INT)
  + 4 * CAST(100 * (length(t) - length(translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', ''))) > 10 * length(t) AS INT)
  + 8 * CAST(regexp_matches(t, '[#$%&*|]') AS INT) + 16 * CAST(doc_id > min(doc_id) OVER (PARTITION BY t) AS INT) AS bits FROM w),
l AS (SELECT doc_id, max(CAST(quality = 1 AS INT)) AS good, max(CAST(toxic = 1 AS INT)) AS toxic FROM labels GROUP BY doc_id),
c AS (SELECT part, bits, count(*) AS n, count(*) FILTER (good = 1) AS good, count(*) FILTER (toxic = 1) AS toxic FROM f LEFT JOIN l USING (doc_id) GROUP BY part, bits),
k(name, b) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
o AS (SELECT v.name || w.name || x.name || y.name || z.name AS filter_order, [v.b, w.b, x.b, y.b, z.b] AS bs
  FROM k v, k w, k x, k y, k z WHERE v.b | w.b | x.b | y.b | z.b = 31),
s AS (SELECT filter_order, step, bs[step] AS own, coalesce(list_sum(bs[1:step - 1]), 0)::INT AS earlier FROM o, (SELECT unnest(range(1, 6)) AS step)),
r AS (SELECT part, filter_order, step, own, sum(n) FILTER (bits & (earlier | own) = 0) AS kept,
  sum(n) FILTER (bits & own > 0 AND bits & earlier = 0) AS removed, sum(n) FILTER (bits & own > 0 AND bits & earlier > 0) AS redundant,
  sum(n) FILTER (bits = own) AS unique_fails, sum(good) FILTER (bits & own > 0 AND bits & earlier = 0) AS good_lost,
  sum(toxic) FILTER (bits & own > 0 AND bits & earlier = 0) AS toxic_lost FROM s, c GROUP BY ALL)
SELECT part, filter_order, step::INT AS step, {', '.join(f'coalesce({c}, 0)::BIGINT AS {c}' for c in
  'kept removed redundant unique_fails good_lost toxic_lost'.split())}, coalesce(sum(removed) OVER (PARTITION BY part, own), 0)::BIGINT AS shapley FROM r"""


@query
def op5_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, sf_dir, "documents"))
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query(sql=_CONTAMINATION)
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
                        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
                        (F.col("n_hit") > 0).alias("contaminated"))


@query
def op3_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = pii.find_spans(docs, pii.fit(docs))
    counts = [pii.count_kind("base", i).alias(f"n_{k}") for i, k in enumerate(pii.KINDS)]
    return found.select("doc_id", *counts, F.sha2(pii.as_text(F.col("base")), 256).alias("base_sha256"),
                        pii.as_text(F.col("spans")).alias("spans"))


@query
def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return packing.pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json")).drop("segment")


@query
def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels")
    model = toxicity.fit(docs, labels.filter(toxicity.learnable()))
    return toxicity.score(docs, model, ["doc_id"]).select(
        "doc_id", F.coalesce(~toxicity.learnable(), F.lit(True)).alias("held_out"), "score",
        (F.col("score") >= 0.7).cast("int").alias("predicted"))


@query(sql=_SUBSTRINGS)
def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = substring_dedup.dedup_substrings(table(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


@query
def op4_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = sharding.pack_shards(table(spark, sf_dir, "documents"), 24)
    return found.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
                        F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = rules.quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "rule")


@query
def op10_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return hmm.score_texts(table(spark, sf_dir, "documents"))


@query
def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return bestfit.pack_texts(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic.periodic_runs(table(spark, sf_dir, "documents"))


@query(sql=_AUDIT)
def op13_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
