"""Queries and oracle SQL of the training-data operators."""

from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

from stratiform.llm import bpe_codec, conversation_repair, divergence, hilbert, jaccard, metric_join, packing, periodic_runs, resampling, secrets, suffix_dedup, token_counts, winnowing

_ROOT = str(Path(__file__).resolve().parents[2])

Query = Callable[[SparkSession, str], DataFrame]


def on_workers(query: Query) -> Query:
    """Python workers of this session import the package from where the
    driver does; on a cluster it is installed or sent with --py-files."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        paths = spark.sparkContext.environment.setdefault("PYTHONPATH", _ROOT)
        if _ROOT not in paths.split(":"):
            spark.sparkContext.environment["PYTHONPATH"] = f"{paths}:{_ROOT}"
        return query(spark, sf_dir)

    return run


_QUERIES: dict[str, Query] = {
    "op1_secret_scan": secrets.op1_secret_scan,
    "op2_packing": packing.op2_packing,
    "op3_hilbert_shards": hilbert.op3_hilbert_shards,
    "op4_jaccard_join": jaccard.op4_jaccard_join,
    "op5_token_counts": token_counts.op5_token_counts,
    "op6_divergence": divergence.op6_divergence,
    "op7_metric_join": metric_join.op7_metric_join,
    "op8_suffix_dedup": suffix_dedup.op8_suffix_dedup,
    "op9_bpe_codec": bpe_codec.op9_bpe_codec,
    "op10_importance_resampling": resampling.op10_importance_resampling,
    "op11_conversation_repair": conversation_repair.op11_conversation_repair,
    "op12_winnowing": winnowing.op12_winnowing,
    "op13_periodic_runs": periodic_runs.op13_periodic_runs,
}


def queries() -> dict[str, Query]:
    return {name: on_workers(query) for name, query in _QUERIES.items()}


_REACH = """
reach(node, other) AS (
  SELECT node, node FROM nodes
  UNION
  SELECT r.node, CASE WHEN l.a = r.other THEN l.b ELSE l.a END FROM reach r JOIN links l ON r.other IN (l.a, l.b))"""

#: Documents as sets of distinct five-word strings, their links, and what they reach.
_JACCARD_SQL = f"""
WITH RECURSIVE
texts AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents),
sets AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS shingle
  FROM texts),
nodes AS (SELECT t.doc_id AS node, count(s.shingle) AS n FROM texts t LEFT JOIN sets s USING (doc_id) GROUP BY ALL),
common AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c
  FROM sets x JOIN sets y ON x.shingle = y.shingle AND x.doc_id < y.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN nodes p ON p.node = a JOIN nodes q ON q.node = b
  WHERE 100 * c >= 75 * (p.n + q.n - c)), {_REACH}
SELECT n.node AS doc_id, n.n AS n_shingles, min(r.other) AS component_id
FROM nodes n JOIN reach r USING (node) GROUP BY ALL"""

_COSINE_SQL = f"""
WITH RECURSIVE
nodes AS (SELECT vec_id AS node, CAST(embedding AS DOUBLE[]) AS v FROM embeddings),
sound AS (
  SELECT node, v, list_sum(list_transform(v, lambda x: x * x)) AS s FROM nodes
  WHERE len(v) > 0 AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(v, lambda x: x <> 0)) > 0),
links AS (
  SELECT p.node AS a, q.node AS b FROM sound p JOIN sound q ON p.node < q.node AND len(p.v) = len(q.v)
  WHERE list_dot_product(p.v, q.v) / sqrt(p.s * q.s) >= 0.95), {_REACH}
SELECT n.node AS vec_id, (SELECT count(*) FROM links WHERE n.node IN (a, b)) AS n_links,
       min(r.other) AS component_id, n.node = min(r.other) AS kept
FROM nodes n JOIN reach r USING (node) GROUP BY n.node"""


def oracle_sql() -> dict[str, str]:
    """For the queries that SQL can express on whole tables."""
    return {"op4_jaccard_join": _JACCARD_SQL, "op7_metric_join": _COSINE_SQL}
