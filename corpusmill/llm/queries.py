"""Queries ``opN_<name>``: each operator with production parameters over its whole table."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from . import decontamination, line_dedup, lm_scoring, ngram_join, packing, quality_rules, substring_dedup, token_counts, toxicity, url_filters


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contained_items(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


def op3_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack_documents(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score_toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar_sets(_table(spark, sf_dir, "documents"), width=4, percent=85)


def op6_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judge_urls(_table(spark, sf_dir, "pages"))


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.repetition_measures(_table(spark, sf_dir, "documents"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.line_report(_table(spark, sf_dir, "documents"))


def op9_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm_scoring.score_documents(_table(spark, sf_dir, "documents"))


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.repeated_passages(_table(spark, sf_dir, "documents"))


QUERIES = {f.__name__: f for f in (
    op1_token_counts, op2_decontamination, op3_best_fit_packing, op4_toxicity, op5_ngram_jaccard_join,
    op6_url_filters, op7_quality_rules, op8_line_dedup, op9_lm_scoring, op10_substring_dedup,
)}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_LOW = f"translate(text, '{UPPER}', '{LOWER}')"
_SPACED = r"'[^\x20\x09-\x0D]+'"
_PLAIN = r"'[0-9a-z\x{80}-\x{10FFFF}]+'"

ORACLES: dict[str, str] = {
    "op2_decontamination": rf"""WITH d AS (SELECT doc_id, regexp_extract_all({_LOW}, {_PLAIN}) AS w FROM documents),
        i AS (SELECT item_id, regexp_extract_all({_LOW}, {_PLAIN}) AS w FROM benchmark),
        k AS (SELECT item_id, least(5, len(w)) AS k, w FROM i WHERE len(w) > 0),
        s AS (SELECT DISTINCT item_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS g FROM k),
        n AS (SELECT item_id, count(*) AS n FROM s GROUP BY ALL),
        t AS (SELECT DISTINCT doc_id, k, unnest(list_transform(range(1, len(w) - k + 2), lambda j: array_to_string(w[j:j + k - 1], ' '))) AS g
              FROM d, (SELECT DISTINCT k FROM k) WHERE len(w) >= k)
        SELECT doc_id, item_id, n::BIGINT AS n_item_shingles, count(*)::BIGINT AS n_shared FROM s JOIN t USING (k, g) JOIN n USING (item_id)
        GROUP BY doc_id, item_id, n HAVING 100 * count(*) >= 80 * n""",
    "op5_ngram_jaccard_join": rf"""WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all({_LOW}, {_SPACED}) AS w FROM documents),
        s AS (SELECT doc_id, CASE WHEN len(coalesce(w, [])) = 0 THEN [] WHEN len(w) < 4 THEN [array_to_string(w, ' ')]
              ELSE list_distinct(list_transform(range(1, len(w) - 2), lambda j: array_to_string(w[j:j + 3], ' '))) END AS s FROM w),
        e AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
        p AS (SELECT x.doc_id AS a, y.doc_id AS b, x.n + y.n AS n, count(*) AS c FROM e x JOIN e y ON x.g = y.g AND x.doc_id < y.doc_id GROUP BY ALL),
        l AS (SELECT a, b FROM p WHERE 100 * c >= 85 * (n - c)), u AS (SELECT a, b FROM l UNION ALL SELECT b, a FROM l),
        r(a, b) AS (SELECT a, b FROM u UNION SELECT r.a, u.b FROM r JOIN u ON r.b = u.a)
        SELECT doc_id, len(s)::BIGINT AS n_shingles, least(doc_id, coalesce((SELECT min(b) FROM r WHERE r.a = s.doc_id), doc_id)) AS component_id FROM s""",
    "op8_line_dedup": rf"""WITH t AS (SELECT doc_id, string_split(text, chr(10)) AS a FROM documents), l AS (SELECT doc_id, unnest(a) AS x, generate_subscripts(a, 1) - 1 AS k FROM t),
        w AS (SELECT doc_id, k, list_sort(list_distinct(regexp_extract_all(x, {_SPACED}))) AS w FROM l), h AS (SELECT *, row_number() OVER (PARTITION BY w ORDER BY doc_id, k) AS copy FROM w WHERE len(w) > 0),
        f AS MATERIALIZED (SELECT doc_id, k, w, len(w) AS n FROM h WHERE copy = 1),
        e AS (SELECT doc_id, k, n, w, unnest(w) AS g FROM f), q AS (SELECT g, count(*) AS m FROM e GROUP BY g),
        o AS (SELECT e.doc_id, e.k, e.n, e.w, g, row_number() OVER (PARTITION BY e.doc_id, e.k ORDER BY m, g) AS place FROM e JOIN q USING (g)),
        x AS (SELECT * FROM o WHERE place <= n - (80 * n + 99) // 100 + 1),
        c AS (SELECT DISTINCT a.doc_id, a.k, a.w, b.w AS v FROM x a JOIN x b ON a.g = b.g AND (b.doc_id, b.k) < (a.doc_id, a.k) AND 100 * least(a.n, b.n) >= 80 * greatest(a.n, b.n)),
        j AS (SELECT doc_id, k FROM (SELECT *, len(list_intersect(w, v)) AS i FROM c) WHERE 100 * i >= 80 * (len(w) + len(v) - i)),
        r AS (SELECT doc_id, k FROM h WHERE copy > 1 UNION SELECT doc_id, k FROM j)
        SELECT d.doc_id, (SELECT count(*) FROM h WHERE h.doc_id = d.doc_id)::INT AS n_lines, len(coalesce(g.r, []))::INT AS n_removed, coalesce(g.r, [])::INT[] AS removed_lines
        FROM documents d LEFT JOIN (SELECT doc_id, list(k ORDER BY k) AS r FROM r GROUP BY doc_id) g ON g.doc_id = d.doc_id""",
}
"""SQL of the operators that SQL can express as a whole; exact words stand for the operators' hashes."""
