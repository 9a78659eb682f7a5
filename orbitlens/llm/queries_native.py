"""Registered queries of the operators built on columns alone, and their SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from orbitlens.llm import preferences, quality_rules, sharding

SHARDS = 40


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _described(docs: DataFrame) -> DataFrame:
    """Base counts of every text, and the base rule's verdict."""
    text = F.col("text")
    rows = docs.withColumn("words", quality_rules.words_of(text))
    rows = rows.withColumn("hashes", quality_rules.window_hashes(F.col("words"), 5))
    rows = rows.select(
        "doc_id", "text",
        F.size("words").cast("long").alias("n_words"),
        F.length(F.array_join("words", "")).cast("long").alias("word_chars"),
        quality_rules.count_chars(text, quality_rules.SYMBOLS).alias("n_symbols"),
        quality_rules.duplicate_lines(text).alias("n_dup_lines"),
        quality_rules.repeated_words(F.col("words"), F.col("hashes"), 5).alias("n_repeat_words"))
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    return rows.withColumn("base_failed", failed)


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts of every text, and the cascade's verdict on those that pass the base rule."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    others = [r for r in quality_rules.STANDARD if r.name not in ("few_words", "repetitive")]
    # the base rule has been applied where the cascade starts, and counts are columns there
    others = quality_rules.order_rules(docs, others, features=quality_rules.ColumnFeatures,
                                       prepare=_described, among="not base_failed")
    chain = quality_rules.first_rejection(others, quality_rules.ColumnFeatures(F.col("text")))
    by = F.when(F.col("base_failed"), F.lit("base")).otherwise(chain)
    rows = _described(docs).withColumn("rejected_by", by)
    return rows.withColumn("kept", F.col("rejected_by").isNull()).drop("text", "rejected_by")


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shuffle_into_shards(docs, SHARDS).select(
        "doc_id", "size", "text_crc32", "law", "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


def op5_preferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations 2k (chosen) and 2k + 1 (rejected) are the pairs."""
    turns = table(spark, sf_dir, "conversations").withColumn("pair_id", F.expr("conv_id div 2"))
    even = F.pmod("conv_id", F.lit(2)) == 0
    out = preferences.format_preferences(turns.where(even), turns.where(~even))

    def listed(spans: str):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws("-", s["start"], s["end"])), ",")

    return out.withColumns({"chosen_spans": listed("chosen_spans"), "rejected_spans": listed("rejected_spans")})


WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

OP6_SQL = rf"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {WORDS} AS w FROM documents),
win AS (
  SELECT r, i, array_to_string(w[i:i + 4], ' ') AS g
  FROM (SELECT r, w, unnest(range(1, len(w) - 3)) AS i FROM d WHERE len(w) > 4)
),
twice AS (SELECT r, i FROM (SELECT r, i, count(*) OVER (PARTITION BY r, g) AS n FROM win) WHERE n > 1),
cover AS (
  SELECT r, sum(least(5, coalesce(nxt - i, 5))) AS n_repeat
  FROM (SELECT r, i, lead(i) OVER (PARTITION BY r ORDER BY i) AS nxt FROM twice) GROUP BY r
),
lines AS (SELECT r, unnest(string_split(text, chr(10))) AS line FROM d),
dup AS (
  SELECT r, sum(n - 1) AS n_dup FROM (
    SELECT r, line, count(*) AS n FROM lines WHERE regexp_matches(line, '[^\x20\x09-\x0D]') GROUP BY r, line) GROUP BY r
),
f AS (
  SELECT r, doc_id, text, w, CAST(len(w) AS BIGINT) AS n_words, CAST(length(array_to_string(w, '')) AS BIGINT) AS word_chars,
    CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
    CAST(coalesce(n_dup, 0) AS BIGINT) AS n_dup_lines, CAST(coalesce(n_repeat, 0) AS BIGINT) AS n_repeat_words
  FROM d LEFT JOIN cover USING (r) LEFT JOIN dup USING (r)
),
b AS (SELECT *, (n_words < 10 OR 100 * n_repeat_words > 20 * n_words) AS base_failed FROM f)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  (NOT base_failed AND NOT 100 * n_symbols > 10 * n_words
   AND NOT 100 * (length(text) - length(regexp_replace(text, '[A-Z]', '', 'g'))) > 30 * length(text)
   AND NOT 100 * (length(text) - length(replace(text, '!', ''))) > 20 * n_words
   AND NOT 100 * len(list_filter(w, lambda x, i: i > 1 AND x = w[i - 1])) > 30 * n_words
   AND NOT 100 * n_dup_lines > 60 * len(string_split(text, chr(10)))) AS kept
FROM b
"""

OP5_SQL = r"""
WITH t AS (
  SELECT DISTINCT conv_id // 2 AS pair_id, conv_id % 2 AS side, turn, coalesce(role, 'none') AS role,
    coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL
),
n AS (SELECT *, row_number() OVER (PARTITION BY pair_id, side ORDER BY turn NULLS FIRST, role, text) AS i FROM t),
sides AS (SELECT pair_id, max(i) FILTER (side = 0) AS na, max(i) FILTER (side = 1) AS nb FROM n GROUP BY pair_id),
differ AS (
  SELECT coalesce(a.pair_id, b.pair_id) AS pair_id, min(coalesce(a.i, b.i)) AS i
  FROM (SELECT * FROM n WHERE side = 0) a FULL JOIN (SELECT * FROM n WHERE side = 1) b
    ON a.pair_id = b.pair_id AND a.i = b.i
  WHERE a.role IS DISTINCT FROM b.role OR a.text IS DISTINCT FROM b.text GROUP BY 1
),
p AS (SELECT s.*, coalesce(d.i - 1, na) AS k FROM sides s LEFT JOIN differ d USING (pair_id)),
r AS (
  SELECT n.*, p.k, '<|' || role || '|>' || chr(10) || text || '<|end|>' || chr(10) AS x
  FROM n JOIN p USING (pair_id)
),
z AS (
  SELECT *, coalesce(sum(length(x)) OVER (PARTITION BY pair_id, side ORDER BY i
    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS at FROM r WHERE i > k
),
c AS (
  SELECT pair_id, side, string_agg(x, '' ORDER BY i) AS body,
    string_agg(CAST(z.at + 5 + length(role) AS BIGINT) || '-' || CAST(z.at + length(x) AS BIGINT), ',' ORDER BY i) FILTER (role = 'assistant') AS spans
  FROM z GROUP BY pair_id, side
),
q AS (SELECT pair_id, string_agg(x, '' ORDER BY i) AS prompt FROM r WHERE side = 0 AND i <= k GROUP BY pair_id)
SELECT p.pair_id, CAST(p.k AS INTEGER) AS n_prompt_turns, coalesce(q.prompt, '') AS prompt,
  CASE WHEN p.na IS NULL THEN NULL ELSE coalesce(a.body, '') END AS chosen,
  CASE WHEN p.nb IS NULL THEN NULL ELSE coalesce(b.body, '') END AS rejected,
  CASE WHEN p.na IS NULL THEN NULL ELSE coalesce(a.spans, '') END AS chosen_spans,
  CASE WHEN p.nb IS NULL THEN NULL ELSE coalesce(b.spans, '') END AS rejected_spans
FROM p LEFT JOIN q USING (pair_id) LEFT JOIN c a ON a.pair_id = p.pair_id AND a.side = 0
  LEFT JOIN c b ON b.pair_id = p.pair_id AND b.side = 1
"""

QUERIES = {
    "op5_preferences": op5_preferences, "op6_quality_rules": op6_quality_rules, "op9_sharding": op9_sharding,
}
ORACLES = {"op5_preferences": OP5_SQL, "op6_quality_rules": OP6_SQL}
