"""Enrichment job (T7): pending pages -> summary record -> vector -> written back.

Plan: the queue selection (F1) and the summary with its keywords (T6) work
inside each row, no shuffle; the vector is a per-row expression with the
fitted IDF inlined; the write-back is one join of the
page table with the updates on ``id`` (AQE broadcasts the updates when a
run's batch is small; otherwise a shuffle join).

Row isolation: every step is an expression that cannot fail on a row's
content (NULL and empty texts have defined results), so one bad page cannot
stop the others; the optional model slots fall back per text, as the
original falls back per page.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.text import py_strip
from ..session import spread
from . import embed as V
from .ingest import pending
from .text import summarize

ENRICHED = ["summary_text", "summary_keywords", "embedding"]


def enrich(
    pages: DataFrame,
    limit: int | None = None,
    skip_empty_first: bool = False,
    encoder: V.TextEncoder | None = None,
    encoder_path: str | None = None,
    summarizer=None,
    max_chars: int = 4000,
    overlap: int = 200,
    top_k: int = 15,
) -> DataFrame:
    """The page table with ``summary_text``, ``summary_keywords`` and
    ``embedding`` filled for the pending pages (``updated`` marks them).

    ``encoder``: a fitted text encoder, or ``encoder_path``: where the table's encoder is kept (see ``page_encoder``).
    Without either, one is fitted on the ``text_excerpt`` of every page, for this call alone. The vector is that of
    the final summary, or of the excerpt when the summary is empty.
    """
    if encoder is None:
        encoder = page_encoder(pages, encoder_path) if encoder_path else fit_page_encoder(pages)
    todo = pending(pages, limit, skip_empty_first).select("id", "text_excerpt")
    if summarizer is None:
        # the summary is empty only when the text is blank: only those rows carry their text along
        blank = py_strip("text_excerpt") == ""
        todo = todo.withColumn("_fallback", F.when(blank, F.col("text_excerpt")))
    else:
        todo = todo.withColumn("_fallback", F.col("text_excerpt"))
    s = summarize(todo, "id", "text_excerpt", max_chars, overlap, top_k, summarizer, passthrough=["_fallback"])
    s = s.withColumn("_src", F.when(F.col("final_summary") != "", F.col("final_summary")).otherwise(F.coalesce("_fallback", F.lit(""))))
    upd = encoder.embed_batches(s, "_src", "_emb").select(
        "id",
        F.col("final_summary").alias("_n_summary_text"),
        F.col("keywords").alias("_n_summary_keywords"),
        F.col("_emb").alias("_n_embedding"),
        F.lit(True).alias("_upd"),
    )
    j = pages.join(upd, "id", "left")
    hit = F.coalesce(F.col("_upd"), F.lit(False))
    cols = [
        (F.when(hit, F.col("_n_" + c)).otherwise(F.col(c)) if c in ENRICHED else F.col(c)).alias(c) for c in pages.columns
    ]
    return j.select(*cols, hit.alias("updated"))


def fit_page_encoder(pages: DataFrame, dim: int = V.DIM) -> V.TextEncoder:
    return V.fit_encoder(spread(pages.select("text_excerpt")), "text_excerpt", dim)


def page_encoder(pages: DataFrame, path: str, dim: int = V.DIM) -> V.TextEncoder:
    """The encoder kept at ``path``; where there is none yet, one is fitted on every page and kept. Later runs read it, so
    they scan only the pages they enrich, and all vectors lie in one space."""
    spark = pages.sparkSession
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(folder):
        fit_page_encoder(pages, dim).save(spark, path)
    return V.TextEncoder.load(spark, path)
