"""Vector queries on ``embeddings``: V3, V4, V5, V6, S8."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.vectors import cosine, is_valid_vector, l2norm
from ..operators import blocks
from ..operators.search import cosine_topk, search_vector
from ..session import read_table
from .registry import register

QUERY_VEC_ID = 0
TOP_K = 5

_SCORE_SQL = """
CASE WHEN sqrt(list_dot_product({a}, {a})) = 0 OR sqrt(list_dot_product({b}, {b})) = 0 THEN -1.0
     ELSE list_dot_product({a}, {b}) / (sqrt(list_dot_product({a}, {a})) * sqrt(list_dot_product({b}, {b}))) END
"""


def _score_sql(a: str, b: str) -> str:
    return " ".join(_SCORE_SQL.format(a=a, b=b).split())


def _query_vector(emb):
    return emb.where(F.col("vec_id") == QUERY_VEC_ID).select(F.col("embedding").alias("qvec"))


VECTOR_SEARCH_SQL = f"""
WITH q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = {QUERY_VEC_ID}),
s AS (SELECT e.vec_id, e.label, {_score_sql('e.embedding::DOUBLE[]', 'q.qv')} AS score
      FROM embeddings e CROSS JOIN q WHERE e.embedding IS NOT NULL AND len(e.embedding) > 0)
SELECT vec_id, label, round(score, 9) AS score,
       CAST(row_number() OVER (ORDER BY score DESC, vec_id) AS BIGINT) AS rank
FROM s WHERE score > 0 AND NOT isnan(score)
QUALIFY rank <= {TOP_K}
"""


@register("vector_search", VECTOR_SEARCH_SQL)
def vector_search(spark, sf_dir):
    """V5 (+F2, V3, V4): cosine top-k of all stored vectors against vector 0."""
    emb = read_table(spark, sf_dir, "embeddings")
    hits = search_vector(emb, _query_vector(emb), k=TOP_K, id_col="vec_id", vec_col="embedding", payload=["label"])
    return hits.select("vec_id", "label", F.round("score", 9).alias("score"), F.col("rank").cast("bigint").alias("rank"))


VECTOR_SEARCH_BATCH_SQL = f"""
WITH s AS (SELECT q.vec_id AS qid, e.vec_id, e.label,
                  {_score_sql('e.embedding::DOUBLE[]', 'q.embedding::DOUBLE[]')} AS score
           FROM embeddings q CROSS JOIN embeddings e
           WHERE e.embedding IS NOT NULL AND len(e.embedding) > 0
             AND q.embedding IS NOT NULL AND len(q.embedding) > 0)
SELECT qid, vec_id, label, round(score, 9) AS score,
       CAST(row_number() OVER (PARTITION BY qid ORDER BY score DESC, vec_id) AS BIGINT) AS rank
FROM s WHERE score > 0 AND NOT isnan(score)
QUALIFY rank <= {TOP_K}
"""


@register("vector_search_batch", VECTOR_SEARCH_BATCH_SQL)
def vector_search_batch(spark, sf_dir):
    """V6: every stored vector is also a query: top-k neighbours of each (exact kNN)."""
    emb = read_table(spark, sf_dir, "embeddings")
    queries = emb.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))
    hits = cosine_topk(emb, queries, k=TOP_K, id_col="vec_id", vec_col="embedding", payload=["label"])
    return hits.select(
        "qid", "vec_id", "label", F.round("score", 9).alias("score"), F.col("rank").cast("bigint").alias("rank")
    )


@register("vector_search_blocks", VECTOR_SEARCH_BATCH_SQL)
def vector_search_blocks(spark, sf_dir):
    """V6 over blocks of similar vectors, those skipped that cannot hold one of the k best."""
    emb = read_table(spark, sf_dir, "embeddings")
    queries = emb.select(F.col("vec_id").alias("qid"), F.col("embedding").alias("qvec"))
    hits = blocks.search(blocks.build(emb, "vec_id", "embedding"), queries, k=TOP_K).hits
    hits = hits.join(emb.select(F.col("vec_id").alias("id"), "label"), "id")
    return hits.select("qid", F.col("id").alias("vec_id"), "label", F.round("score", 9).alias("score"), F.col("rank").cast("bigint").alias("rank"))


@register(
    "cosine_scores",
    f"""
WITH q AS (SELECT embedding::DOUBLE[] AS qv FROM embeddings WHERE vec_id = {QUERY_VEC_ID})
SELECT e.vec_id, round(CASE WHEN e.embedding IS NULL OR len(e.embedding) = 0 THEN -1.0
                  ELSE {_score_sql('e.embedding::DOUBLE[]', 'q.qv')} END, 9) AS score
FROM embeddings e CROSS JOIN q
""",
)
def cosine_scores(spark, sf_dir):
    """V4 over the whole table, as a JVM expression: cosine of every vector with vector 0."""
    emb = read_table(spark, sf_dir, "embeddings")
    q = _query_vector(emb).limit(2)
    rows = q.collect()  # one vector: the query of a search, bounded
    if len(rows) != 1:
        raise ValueError("query vector id must select exactly one row")
    qv = F.array(*[F.lit(float(x)) for x in rows[0]["qvec"]])
    return emb.select("vec_id", F.round(cosine(F.col("embedding"), qv), 9).alias("score"))


@register(
    "valid_vectors",
    """
SELECT vec_id, CAST(len(embedding) AS INTEGER) AS dim,
       round(sqrt(list_dot_product(embedding::DOUBLE[], embedding::DOUBLE[])), 9) AS norm
FROM embeddings WHERE embedding IS NOT NULL AND len(embedding) > 0
""",
)
def valid_vectors(spark, sf_dir):
    """V3: rows that hold a usable vector, with dimension and norm."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.where(is_valid_vector("embedding")).select(
        "vec_id", F.size("embedding").alias("dim"), F.round(l2norm("embedding"), 9).alias("norm")
    )


@register(
    "search_json",
    f"""
WITH hits AS ({VECTOR_SEARCH_SQL})
SELECT CAST(to_json({{'vec_id': vec_id, 'label': label, 'score': score, 'rank': rank}}) AS VARCHAR) AS json FROM hits
""",
)
def search_json(spark, sf_dir):
    """The search hits as JSON documents (non-ASCII kept)."""
    hits = vector_search(spark, sf_dir)
    return hits.select(F.to_json(F.struct("vec_id", "label", "score", "rank")).alias("json"))
