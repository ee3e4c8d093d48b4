"""The registered queries opN_<name> with production parameters, and their SQL where SQL can say it."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import audit, bpe, exact, language, leaks, nearjoin, negatives, neighbours, packing, quality, substrings, tokenio, toxicity
from .common import table


def vocabulary() -> str:
    return public_tokenizers.path("byte_bpe_50k.json")


def op1_projected_neighbours(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neighbours.nearest(spark, table(spark, sf_dir, "embeddings"))


def op2_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearjoin.near_duplicates(spark, table(spark, sf_dir, "documents"))


def op3_token_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokenio.round_trip(spark, table(spark, sf_dir, "documents"), vocabulary())


def op4_crf_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op5_bm25_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(spark, table(spark, sf_dir, "documents"), vocabulary())


def op6_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.identify(spark, table(spark, sf_dir, "documents"))


def op7_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_duplicates(spark, table(spark, sf_dir, "documents"))


def op8_fm_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.score(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.round_trip(spark, table(spark, sf_dir, "documents"), vocabulary())


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substrings.removed_repeats(spark, table(spark, sf_dir, "documents"))


def op11_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return audit.interactions(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = table(spark, sf_dir, "embeddings")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return negatives.hard_negatives(spark, vectors.select("vec_id", "embedding", label.alias("label")))


def op13_benchmark_leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks.contamination(spark, table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (
        op1_projected_neighbours,
        op2_minhash_near_dedup,
        op3_token_output,
        op4_crf_toxicity,
        op5_bm25_packing,
        op6_language_id,
        op7_exact_dedup,
        op8_fm_quality,
        op9_bpe,
        op10_suffix_dedup,
        op11_filter_audit,
        op12_hard_negatives,
        op13_benchmark_leaks,
    )
}

SQL: dict[str, str] = {
    "op7_exact_dedup": """
        SELECT doc_id,
               max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
               count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
               row_number() OVER (PARTITION BY coalesce(text, '') ORDER BY doc_id DESC NULLS LAST) = 1 AS kept,
               sha256(coalesce(text, '')) AS text_sha256
        FROM documents
    """,
    "op11_filter_audit": r"""
        WITH letters(l, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 4), ('D', 8), ('E', 16)),
        orders AS (
            SELECT a.l || b.l || c.l || d.l || e.l AS filter_order
            FROM letters a, letters b, letters c, letters d, letters e
            WHERE (a.bit | b.bit | c.bit | d.bit | e.bit) = 31
        ),
        steps AS (
            SELECT filter_order, s.step, letters.bit AS own,
                   coalesce((SELECT sum(x.bit) FROM letters x WHERE contains(substr(filter_order, 1, s.step - 1), x.l)), 0) AS before
            FROM orders, range(1, 6) AS s(step), letters
            WHERE letters.l = substr(filter_order, s.step, 1)
        ),
        texts AS (SELECT doc_id, coalesce(source, '') AS part, coalesce(text, '') AS t FROM documents),
        words AS (
            SELECT *, regexp_extract_all(t, '[^\x20\x09-\x0D]+') AS w,
                   doc_id IS DISTINCT FROM min(doc_id) OVER (PARTITION BY t) AS copy
            FROM texts
        ),
        masks AS (
            SELECT doc_id, part,
                   (len(w) < 200)::INT + 2 * (100 * len(list_distinct(w)) < 50 * len(w))::INT
                   + 4 * (100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 2 * length(t))::INT
                   + 8 * regexp_matches(t, '[#$%&*|]')::INT + 16 * copy::INT AS mask
            FROM words
        ),
        said AS (SELECT doc_id, max((quality = 1)::INT) AS good, max((toxic = 1)::INT) AS toxic FROM labels GROUP BY doc_id),
        counted AS (
            SELECT part, mask, count(*) AS n, coalesce(sum(good), 0) AS good, coalesce(sum(toxic), 0) AS toxic
            FROM masks LEFT JOIN said USING (doc_id) GROUP BY part, mask
        )
        SELECT part, filter_order, step::INT AS step,
               coalesce(sum(n) FILTER ((mask & (own | before)) = 0), 0)::BIGINT AS kept,
               coalesce(sum(n) FILTER ((mask & own) > 0 AND (mask & before) = 0), 0)::BIGINT AS removed,
               coalesce(sum(n) FILTER ((mask & own) > 0 AND (mask & before) > 0), 0)::BIGINT AS redundant,
               coalesce(sum(n) FILTER (mask = own), 0)::BIGINT AS unique_fails,
               coalesce(sum(good) FILTER ((mask & own) > 0 AND (mask & before) = 0), 0)::BIGINT AS good_lost,
               coalesce(sum(toxic) FILTER ((mask & own) > 0 AND (mask & before) = 0), 0)::BIGINT AS toxic_lost,
               coalesce(sum(n * (120 // greatest(bit_count(mask), 1))) FILTER ((mask & own) > 0), 0)::BIGINT AS shapley
        FROM counted, (SELECT filter_order, step, own, before::INT AS before FROM steps)
        GROUP BY part, filter_order, step
    """,
    "op12_hard_negatives": """
        WITH r AS (
            SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                   list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS v
            FROM embeddings
            WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ),
        pairs AS (
            SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same, CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
            FROM r a JOIN r b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        ),
        best AS (
            SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM pairs WHERE same
            QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT anchor_id, positive_id, CAST(row_number() OVER w AS INT) AS rank, vec_id AS negative_id, positive_score, score AS negative_score
        FROM best JOIN pairs USING (anchor_id)
        WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
        WINDOW w AS (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id)
        QUALIFY row_number() OVER w <= 3
    """,
    "op13_benchmark_leaks": r"""
        WITH items AS (
            SELECT coalesce(CAST(item_id AS VARCHAR), '') AS item,
                   regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
            FROM benchmark
        ),
        windows AS (
            SELECT DISTINCT item, list_slice(w, i, i + 9) AS g
            FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 8, 2))) AS i FROM items WHERE len(w) > 0)
        ),
        docs AS (
            SELECT row_number() OVER () AS node, doc_id,
                   coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w
            FROM documents
        ),
        grams AS (
            SELECT node, i, k, list_slice(w, i, i + k - 1) AS g
            FROM (SELECT node, w, unnest(range(1, len(w) + 1)) AS i FROM docs), (SELECT DISTINCT len(g) AS k FROM windows)
            WHERE i + k - 1 <= len(w)
        ),
        found AS (SELECT node, i, k, item FROM grams JOIN windows USING (g)),
        hit AS (SELECT node, count(DISTINCT p) AS n_hit FROM (SELECT node, unnest(range(i, i + k)) AS p FROM found) GROUP BY node),
        named AS (SELECT node, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS names FROM found GROUP BY node)
        SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
               sha256(coalesce(names, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
        FROM docs LEFT JOIN hit USING (node) LEFT JOIN named USING (node)
    """,
}
