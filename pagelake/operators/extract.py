"""Page extraction jobs.

Staged projections: the cleaned HTML is computed once per page and reused by
every extractor (Catalyst keeps a projection separate when collapsing it would
repeat an expensive expression).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import html as H
from ..session import spread
from ..sources.rawstore import digest


def with_clean(df: DataFrame, html_col: str = "html", key: str | None = None) -> DataFrame:
    return spread(df, key).withColumn("_clean", H.clean_html(html_col))


def extract_pages(
    df: DataFrame,
    html_col: str = "html",
    key: str | None = None,
    min_text: int = H.MIN_TEXT_CHARS,
    min_block: int = H.MIN_BLOCK_CHARS,
    max_link_density: float = H.MAX_LINK_DENSITY,
    **boilerplate,
) -> DataFrame:
    """X5 over a table: adds ``title``, ``text``, ``method``. A page is folded into blocks once, for both extractors."""
    c = with_clean(df, html_col, key).withColumn("_blocks", H.folded("_clean", **boilerplate))
    c = c.withColumn("_t1", H.accepted(H.joined_blocks("_blocks", min_block, max_link_density), min_text))
    c = c.withColumn("_t2", F.when(F.col("_t1").isNull(), H.accepted(H.joined_paragraphs("_blocks"), min_text)))
    c = c.withColumn("_t3", F.when(F.col("_t1").isNull() & F.col("_t2").isNull(), H.body_text("_clean")))
    return c.select(
        *[x for x in df.columns],
        F.when(F.col("_t1").isNotNull(), H.title_text("_clean")).otherwise(H.title_string("_clean")).alias("title"),
        F.coalesce("_t1", "_t2", "_t3").alias("text"),
        F.when(F.col("_t1").isNotNull(), F.lit("blocks"))
        .when(F.col("_t2").isNotNull(), F.lit("paragraphs"))
        .otherwise(F.lit("body"))
        .alias("method"),
    )


def raw_digest(html_col: str = "html"):
    """sha256 of the UTF-8 bytes of the page, hex."""
    return digest(html_col)


def raw_digests(df: DataFrame, html_col: str = "html", raw_dir: str = "raw") -> DataFrame:
    """What the raw store holds of the pages, without them: ``digest, html_path, n_bytes, n_pages``. Only digests
    are shuffled."""
    d = df.select(raw_digest(html_col).alias("digest"), F.octet_length(html_col).cast("bigint").alias("n_bytes"))
    path = F.concat(F.lit(raw_dir.rstrip("/") + "/"), "digest", F.lit(".html"))
    return d.groupBy("digest", "n_bytes").agg(F.count("*").alias("n_pages")).select("digest", path.alias("html_path"), "n_bytes", "n_pages")


def raw_store(df: DataFrame, html_col: str = "html", raw_dir: str = "raw") -> DataFrame:
    """S2 without a store: one row per distinct page body, ``digest, html_path, html, n_bytes, n_pages``. It shuffles the
    bodies; ``sources.rawstore`` keeps them in a table and does not."""
    d = df.select(raw_digest(html_col).alias("digest"), F.col(html_col).alias("html"))
    bodies = d.groupBy("digest").agg(F.first("html").alias("html"))
    return raw_digests(df, html_col, raw_dir).join(bodies, "digest").select("digest", "html_path", "html", "n_bytes", "n_pages")
