"""The registered queries of the training-data operators, with production parameters over whole tables."""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from edustar.llm import (collocations, fingerprint, hard_negatives, html_text, license_scan, order_minhash, packing, piece_sampling,
                         pq_dedup, quality, secret_scan, token_attribution, toxicity)
from edustar.llm.store import importable_by_workers

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    @wraps(f)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        importable_by_workers(spark)
        return f(spark, sf_dir.rstrip("/"))
    QUERIES[f.__name__] = run
    return run


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_quality(spark, sf_dir):
    return quality.classify(_table(spark, sf_dir, "documents"))


@query
def op2_token_attribution(spark, sf_dir):
    return token_attribution.attribute_lines(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN, "most")


@query
def op3_secret_scan(spark, sf_dir):
    return secret_scan.scan_documents(_table(spark, sf_dir, "documents"))


@query
def op4_packing(spark, sf_dir):
    return packing.pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_fingerprint(spark, sf_dir):
    return fingerprint.edit_likeness(_table(spark, sf_dir, "documents"))


@query
def op6_toxicity(spark, sf_dir):
    return toxicity.toxicity(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


@query
def op7_html_text(spark, sf_dir):
    return html_text.extract(_table(spark, sf_dir, "pages"))


@query
def op8_piece_sampling(spark, sf_dir):
    return piece_sampling.segmentations(_table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))


@query
def op9_pq_dedup(spark, sf_dir):
    return pq_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"))


@query
def op10_order_minhash(spark, sf_dir):
    return order_minhash.near_duplicates(_table(spark, sf_dir, "documents"))


@query
def op11_license_scan(spark, sf_dir):
    return license_scan.scan_documents(_table(spark, sf_dir, "documents"))


@query
def op12_collocations(spark, sf_dir):
    return collocations.collocations(_table(spark, sf_dir, "documents"))


@query
def op13_hard_negatives(spark, sf_dir):
    return hard_negatives.hard_negatives(_table(spark, sf_dir, "embeddings"))


@query
def pipeline(spark, sf_dir):
    return corpus_pipeline.run(spark, sf_dir)


#: DuckDB SQL of the queries that SQL can express; the others are tested against brute force in tests/llm.
ORACLE: dict[str, str] = {
    "op9_pq_dedup": """
WITH RECURSIVE
  v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS x FROM embeddings),
  link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM v a JOIN v b
           ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.x, b.x) >= 0.9),
  reach(node, seen) AS (
    SELECT vec_id, vec_id FROM v
    UNION
    SELECT link.b, reach.seen FROM reach JOIN link ON link.a = reach.node),
  comp AS (SELECT node, min(seen) AS component_id FROM reach GROUP BY node)
SELECT v.vec_id, (SELECT count(*) FROM link WHERE link.a = v.vec_id) AS n_links, comp.component_id, v.vec_id = comp.component_id AS kept
FROM v JOIN comp ON comp.node = v.vec_id
""",
}
ORACLE["op12_collocations"] = r"""
WITH
  pieces AS (SELECT coalesce(lang, 'und') AS lang, unnest(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
  words AS (SELECT lang, list_filter(regexp_split_to_array(piece, '[\x20\x09]+'), lambda x: x <> '') AS w FROM pieces),
  grams AS (
    SELECT lang, 1 AS k, unnest(w) AS phrase FROM words
    UNION ALL SELECT lang, 2, unnest(list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])) FROM words
    UNION ALL SELECT lang, 3, unnest(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) FROM words),
  n AS (SELECT lang, count(*) AS n FROM grams WHERE k = 1 GROUP BY lang),
  f AS (SELECT lang, k, phrase, count(*) AS f FROM grams GROUP BY ALL HAVING count(*) >= 10),
  cand AS (SELECT lang, k, phrase, f AS a, string_split(phrase, ' ') AS w FROM f WHERE k > 1),
  cuts AS (
    SELECT c.*, 1 AS cut, w[1] AS lp, array_to_string(w[2:], ' ') AS rp FROM cand c
    UNION ALL SELECT c.*, 2, w[1] || ' ' || w[2], w[3] FROM cand c WHERE k = 3),
  scored AS (
    SELECT c.lang, c.phrase, c.a, c.cut, x.f AS l, y.f AS r,
           (1000000::HUGEINT * c.a * c.a) // (x.f::HUGEINT * y.f::HUGEINT) AS score
    FROM cuts c JOIN f x ON x.lang = c.lang AND x.phrase = c.lp JOIN f y ON y.lang = c.lang AND y.phrase = c.rp),
  best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, cut) = 1),
  longer AS (
    SELECT lang, phrase, max(a) AS a FROM (
      SELECT lang, w[1] || ' ' || w[2] AS phrase, a FROM cand WHERE k = 3
      UNION ALL SELECT lang, w[2] || ' ' || w[3], a FROM cand WHERE k = 3) GROUP BY ALL),
  left_over AS (SELECT b.* FROM best b LEFT JOIN longer g ON g.lang = b.lang AND g.phrase = b.phrase
                WHERE g.a IS NULL OR 100 * g.a < 50 * b.a),
  ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank FROM left_over)
SELECT r.lang, r.rank, r.phrase, r.a, r.l, r.r, n.n, CAST(r.score AS BIGINT) AS score FROM ranked r JOIN n ON n.lang = r.lang WHERE r.rank <= 2000
"""

ORACLE["op13_hard_negatives"] = """
WITH
  v AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
        FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
  s AS (SELECT a.vec_id AS anchor_id, a.label AS own, b.vec_id AS other_id, b.label AS label, CAST(list_inner_product(a.x, b.x) AS BIGINT) AS score
        FROM v a JOIN v b ON b.vec_id <> a.vec_id WHERE a.vec_id % 100 = 0),
  pos AS (SELECT * FROM s WHERE label = own QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5),
  neg AS (SELECT p.anchor_id, p.other_id AS positive_id, p.score AS positive_score, s.other_id AS negative_id, s.score AS negative_score,
                 row_number() OVER (PARTITION BY p.anchor_id, p.other_id ORDER BY s.score DESC, s.other_id) AS rank
          FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND s.label <> s.own AND 80 * p.score <= 100 * s.score AND s.score <= p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 5
"""
