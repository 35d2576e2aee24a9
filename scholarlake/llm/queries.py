"""The registered queries of this subpackage, each over whole tables, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from scholarlake.llm import (
    decontamination,
    hard_negatives,
    html_extraction,
    importance_resampling,
    language_id,
    ngram_join,
    packing,
    quality_rules,
    substring_dedup,
    token_counts,
    toxicity,
    url_filters,
    url_filters_sql,
    whitening,
)
from scholarlake.llm.common import shipped_code, table

Query = Callable[[SparkSession, str], DataFrame]


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.counted(table(spark, sf_dir, "documents"))


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    out, (left, total, removed) = substring_dedup.without_repeats(docs)
    return out.select(
        "doc_id", F.col(left).alias("text"), F.col(total).alias("n_pieces"),
        F.col(removed).alias("n_removed"),
    )


def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, items = (table(spark, sf_dir, name) for name in ("documents", "benchmark"))
    return decontamination.contamination(docs, items, unnamed=True).drop("k1", "k2")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identified(table(spark, sf_dir, "documents"))


def op5_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extracted(table(spark, sf_dir, "pages"))


def op6_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return quality_rules.judged(docs, quality_rules.train(docs, labels))


def op7_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return toxicity.scored(docs, toxicity.train(docs, labels))


def op8_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = (table(spark, sf_dir, name) for name in ("documents", "labels"))
    return importance_resampling.resampled(docs, labels)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.packed_documents(table(spark, sf_dir, "documents"))


def op10_ngram_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.links(table(spark, sf_dir, "documents")).select(
        "doc_id", "class_id", "n_links"
    )


def op11_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    vectors = table(spark, sf_dir, "embeddings").withColumn("label", label)
    return hard_negatives.mined(vectors, F.col("vec_id") % 50 == 0)


# Hosts and beginnings of paths; "org/" is every path of every host below org.
URL_RULES = (
    ("allow", "org/"),
    ("block", "example.org/es/"),
    ("block", "example.org/en/1"),
    ("allow", "com/fr/"),
    ("block", "com/de/"),
)


def op12_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judged(table(spark, sf_dir, "pages"), URL_RULES)


def op13_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def _shipped(query: Query) -> Query:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        shipped_code(spark)
        return query(spark, sf_dir)

    return run


QUERIES: dict[str, Query] = {
    query.__name__: _shipped(query)
    for query in (
        op1_token_counts,
        op2_substring_dedup,
        op3_decontamination,
        op4_language_id,
        op5_html_extraction,
        op6_quality_rules,
        op7_toxicity,
        op8_importance_resampling,
        op9_packing,
        op10_ngram_jaccard,
        op11_hard_negatives,
        op12_url_filters,
        op13_embedding_whitening,
    )
}

# Words, as operators 3 and 10 take them.
_WORDS = (
    "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',"
    " 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
)

ORACLES: dict[str, str] = {
    "op3_decontamination": f"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS item, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT item, unnest(CASE WHEN len(w) < 10 THEN [w]
    ELSE list_transform(range(1, len(w) - 8), lambda i: w[i:i + 9]) END) AS win
  FROM b WHERE len(w) > 0
),
spelled AS (SELECT DISTINCT item, len(win) AS n, array_to_string(win, ' ') AS s FROM windows),
lengths AS (SELECT DISTINCT n FROM spelled),
starts AS (
  SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lengths WHERE len(w) >= n
),
hits AS (
  SELECT doc_id, i, n, item
  FROM (SELECT doc_id, i, n, array_to_string(w[i:i + n - 1], ' ') AS s FROM starts)
  JOIN spelled USING (n, s)
),
hit_words AS (
  SELECT doc_id, count(DISTINCT word) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS word FROM hits) GROUP BY doc_id
),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
""",
    "op10_ngram_jaccard": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_WORDS} AS w FROM documents),
grams AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5
    THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END)
    AS g
  FROM d
),
sizes AS (SELECT doc_id, len(g) AS n FROM grams),
single AS (SELECT doc_id, unnest(g) AS gram FROM grams),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS common
  FROM single a JOIN single b ON a.gram = b.gram AND a.doc_id <> b.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM shared JOIN sizes x ON x.doc_id = a JOIN sizes y ON y.doc_id = b
  WHERE CAST(common AS DOUBLE) / (x.n + y.n - common) >= 0.8
),
reach AS (
  SELECT doc_id, doc_id AS other FROM documents
  UNION
  SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other
)
SELECT doc_id, min(other) AS class_id,
  CAST((SELECT count(*) FROM links WHERE a = reach.doc_id) AS BIGINT) AS n_links
FROM reach GROUP BY doc_id
""",
    "op11_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
),
scores AS (
  SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
    CAST(list_dot_product(a.x, b.x) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM positives JOIN scores USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
QUALIFY row_number() OVER w <= 3
""",
    # The tables' urls have at most three segments, an empty last one included.
    "op12_url_filters": url_filters_sql.oracle(URL_RULES, 4),
}
