"""Text-vector queries: V1 (embed documents), V2 + V5 (search by text)."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import embed as V
from ..operators.search import cosine_topk
from ..operators.search import search_pages as find_pages
from ..session import read_table, spread
from .registry import register

DIM = V.DIM
TOP_K = 5
SCORE_DIGITS = 12  # scores are compared at this precision when ranking
OUT_DIGITS = 8


def _weights_sql(table: str, id_col: str, name: str) -> str:
    """Sparse ``(id, bucket, tf)`` rows of a text table, set-based."""
    return f"""
{name}_t AS (SELECT {id_col} AS id, unnest(list_filter(string_split_regex(lower(coalesce(text, '')), '{V.TOKEN_SPLIT_RE}'),
                    lambda x: x <> '')) AS tok FROM {table}),
{name}_tf AS (SELECT id, CAST(('0x' || substring(md5(tok), 1, 8))::BIGINT % {DIM} AS INTEGER) AS bucket, count(*) AS tf
              FROM {name}_t GROUP BY ALL)"""


ENCODER_SQL = f"""
{_weights_sql('documents', 'doc_id', 'd')},
nd AS (SELECT count(*) AS n FROM documents),
idf AS (SELECT bucket, ln((nd.n + 1.0) / (count(*) + 1.0)) AS idf FROM d_tf CROSS JOIN nd GROUP BY bucket, nd.n),
d_w AS (SELECT d_tf.id, d_tf.bucket, d_tf.tf * idf.idf AS w FROM d_tf JOIN idf USING (bucket)),
d_n AS (SELECT id, sqrt(sum(w * w)) AS norm FROM d_w GROUP BY id)"""


@register(
    "embed_documents",
    f"""
WITH {ENCODER_SQL},
cell AS (SELECT d.doc_id, g.i, CASE WHEN n.norm > 0 THEN coalesce(w.w / n.norm, 0.0) ELSE 0.0 END AS x
         FROM documents d CROSS JOIN range({DIM}) g(i)
         LEFT JOIN d_w w ON w.id = d.doc_id AND w.bucket = g.i
         LEFT JOIN d_n n ON n.id = d.doc_id)
SELECT doc_id, CAST(count(*) FILTER (WHERE x <> 0) AS INTEGER) AS nnz,
       list(round(x, {OUT_DIGITS}) ORDER BY i) AS embedding
FROM cell GROUP BY doc_id
""",
)
def embed_documents(spark, sf_dir):
    """V1: a lexical vector for every document (encoder fitted on the whole table)."""
    docs = read_table(spark, sf_dir, "documents")
    enc = V.fit_encoder(docs, "text", DIM)
    e = V.embed(spread(docs.select("doc_id", "text"), "doc_id"), enc, "text")
    return e.select(
        "doc_id",
        F.size(F.filter("embedding", lambda x: x != 0)).alias("nnz"),
        F.transform("embedding", lambda x: F.round(x, OUT_DIGITS)).alias("embedding"),
    )


@register(
    "search_text",
    f"""
WITH {ENCODER_SQL},
{_weights_sql('benchmark', 'item_id', 'q')},
q_w AS (SELECT q_tf.id, q_tf.bucket, q_tf.tf * idf.idf AS w FROM q_tf JOIN idf USING (bucket)),
q_n AS (SELECT id, sqrt(sum(w * w)) AS norm FROM q_w GROUP BY id),
s AS (SELECT q_w.id AS item_id, d_w.id AS doc_id, sum(q_w.w * d_w.w) AS dot
      FROM q_w JOIN d_w USING (bucket) GROUP BY q_w.id, d_w.id),
sc AS (SELECT s.item_id, s.doc_id, round(s.dot / (qn.norm * dn.norm), {SCORE_DIGITS}) AS score
       FROM s JOIN q_n qn ON qn.id = s.item_id JOIN d_n dn ON dn.id = s.doc_id
       WHERE qn.norm > 0 AND dn.norm > 0)
SELECT item_id, doc_id, round(score, 9) AS score,
       CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS BIGINT) AS rank
FROM sc WHERE score > 0
QUALIFY rank <= {TOP_K}
""",
)
def search_text(spark, sf_dir):
    """V2 + V5: each benchmark passage is a text query; its top 5 documents by
    cosine of the lexical vectors (queries encoded with the documents' IDF)."""
    docs = read_table(spark, sf_dir, "documents")
    enc = V.fit_encoder(docs, "text", DIM)
    store = enc.embed_batches(spread(docs.select("doc_id", "text"), "doc_id"), "text").select("doc_id", "embedding")
    bench = read_table(spark, sf_dir, "benchmark")
    queries = enc.embed(bench.select(F.col("item_id").alias("qid"), "text"), "text", "qvec").select("qid", "qvec")
    hits = cosine_topk(store, queries, k=TOP_K, id_col="doc_id", vec_col="embedding", score_digits=SCORE_DIGITS)
    return hits.select(
        F.col("qid").alias("item_id"), "doc_id", F.round("score", 9).alias("score"), F.col("rank").cast("bigint").alias("rank")
    )


@register(
    "search_pages",
    f"""
WITH {ENCODER_SQL},
one AS (SELECT item_id, text FROM benchmark ORDER BY item_id LIMIT 1),
{_weights_sql('one', 'item_id', 'q')},
q_w AS (SELECT q_tf.bucket, q_tf.tf * idf.idf AS w FROM q_tf JOIN idf USING (bucket)),
q_n AS (SELECT sqrt(sum(w * w)) AS norm FROM q_w),
sc AS (SELECT d_w.id, round(sum(q_w.w * d_w.w) / (any_value(q_n.norm) * any_value(d_n.norm)), {SCORE_DIGITS}) AS score
       FROM q_w JOIN d_w USING (bucket) JOIN d_n ON d_n.id = d_w.id CROSS JOIN q_n WHERE d_n.norm > 0 AND q_n.norm > 0 GROUP BY d_w.id)
SELECT 'https://docs.example/' || id AS url, source AS title, round(score, 9) AS score, lang AS summary
FROM sc JOIN documents d ON d.doc_id = sc.id WHERE score > 0 ORDER BY sc.score DESC, id LIMIT {TOP_K}
""",
)
def search_pages(spark, sf_dir):
    """V5 from a text: the five pages nearest to the first benchmark passage, with url, title, score and
    summary. Every document is a page; its vector comes from its whole text."""
    docs = read_table(spark, sf_dir, "documents")
    enc = V.fit_encoder(docs, "text", DIM)
    pages = enc.embed_batches(spread(docs, "doc_id"), "text").select(
        F.col("doc_id").alias("id"),
        F.concat(F.lit("https://docs.example/"), F.col("doc_id").cast("string")).alias("url"),
        F.col("source").alias("title"),
        F.col("lang").alias("summary_text"),
        "embedding",
    )
    text = read_table(spark, sf_dir, "benchmark").orderBy("item_id").first()["text"]
    return find_pages(pages, text, enc, TOP_K, SCORE_DIGITS).withColumn("score", F.round("score", 9))
