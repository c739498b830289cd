"""Inputs the pipeline needs that the driver tables do not hold directly.

Each is derived by a fixed rule from a whole driver table (never a subset of
it), so the work grows with the data. The rules are the ones listed in
FIXTURES.md section 3.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import read_table

LABEL_NAMES = ("quality", "toxic")


def label_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(id, text, labels)``: every document; ``labels`` is the comma list of the
    flags that are 1 (``''`` when none or when the document has no label row).
    Even ids use ``', '`` between labels, odd ids ``','``; where the id is divisible by 3 a tab and a
    non-breaking space follow the comma, and a newline the last label."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    lab = read_table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    sep = F.when(F.col("doc_id") % 3 == 0, F.lit(",\t\u00a0")).when(F.col("doc_id") % 2 == 0, F.lit(", ")).otherwise(F.lit(","))
    end = F.when((F.col("doc_id") % 3 == 0) & (F.size("_parts") > 0), F.lit("\n")).otherwise(F.lit(""))
    parts = F.array_compact(F.array(*[F.when(F.col(n) == 1, F.lit(n)) for n in LABEL_NAMES]))
    return j.select(F.col("doc_id").alias("id"), "text", parts.alias("_parts"), sep.alias("_sep"), "doc_id").select(
        "id", "text", F.concat(F.expr("array_join(_parts, _sep)"), end).alias("labels")
    )


LABEL_ROWS_SQL = """
SELECT id, text, CASE WHEN id % 3 = 0 THEN array_to_string(parts, ',' || chr(9) || chr(160)) || CASE WHEN len(parts) > 0 THEN chr(10) ELSE '' END
            WHEN id % 2 = 0 THEN array_to_string(parts, ', ') ELSE array_to_string(parts, ',') END AS labels
FROM (SELECT d.doc_id AS id, d.text,
             list_filter([CASE WHEN l.quality = 1 THEN 'quality' END, CASE WHEN l.toxic = 1 THEN 'toxic' END],
                         lambda x: x IS NOT NULL) AS parts
      FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id)
"""


def scored_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``labels`` with a deterministic predicted probability per label (from ``doc_id``):
    ``(doc_id, y_quality, y_toxic, p_quality, p_toxic)``."""
    lab = read_table(spark, sf_dir, "labels")
    return lab.select(
        "doc_id",
        F.col("quality").alias("y_quality"),
        F.col("toxic").alias("y_toxic"),
        ((F.col("doc_id") * 7919 % 1000) / 1000.0).alias("p_quality"),
        ((F.col("doc_id") * 104729 % 1000) / 1000.0).alias("p_toxic"),
    )


SCORED_LABELS_SQL = """
SELECT doc_id, quality AS y_quality, toxic AS y_toxic,
       (doc_id * 7919 % 1000) / 1000.0 AS p_quality, (doc_id * 104729 % 1000) / 1000.0 AS p_toxic
FROM labels
"""

LOGIT_LABELS = tuple(f"v{i}" for i in range(1, 65))


def logits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(vec_id, logits array<double>)``: the 64 embedding values times 10, read as logits of labels v1 to v64."""
    emb = read_table(spark, sf_dir, "embeddings")
    return emb.select("vec_id", F.transform(F.col("embedding").cast("array<double>"), lambda x: x * 10.0).alias("logits"))


LOGITS_SQL = "SELECT vec_id, list_transform(embedding::DOUBLE[], lambda x: x * 10.0) AS logits FROM embeddings"


# ---------------------------------------------------------------- ingest fixtures

ROBOTS_CLASSES = 7
# (class, robots_status, agent, group_seq, rule_seq, allow, path_prefix); class = length(scheme://host) % 7
ROBOTS_TEMPLATE = [
    (0, 200, "PagelakeBot", 1, 1, True, "/fr/"),
    (0, 200, "PagelakeBot", 1, 2, False, "/"),
    (0, 200, "*", 2, 1, False, "/"),
    (1, 200, "*", 1, 1, False, "/en/"),
    (1, 200, "*", 1, 2, True, "/en/1"),
    (2, 401, None, None, None, None, None),
    (3, 404, None, None, None, None, None),
    (4, 500, None, None, None, None, None),
    (5, None, None, None, None, None, None),
    (6, 200, "otherbot", 1, 1, False, "/"),
    (6, 200, "*", 2, 1, True, "/de/"),
    (6, 200, "*", 2, 2, False, "/de"),
    (6, 200, "*", 2, 3, False, ""),
    (6, 200, "*", 3, 1, False, "/"),
]
ROBOTS_TEMPLATE_SCHEMA = "cls int, robots_status int, agent string, group_seq int, rule_seq int, allow boolean, path_prefix string"


def robots_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parsed robots rules for every host of ``pages``, by host class."""
    from ..operators.ingest import site_base

    hosts = read_table(spark, sf_dir, "pages").select(site_base(F.col("url")).alias("base")).distinct()
    tpl = spark.createDataFrame(ROBOTS_TEMPLATE, ROBOTS_TEMPLATE_SCHEMA)
    return hosts.join(F.broadcast(tpl), (F.length("base") % ROBOTS_CLASSES) == F.col("cls")).drop("cls")


def robots_rules_sql() -> str:
    def v(x):
        if x is None:
            return "NULL"
        if isinstance(x, bool):
            return "true" if x else "false"
        if isinstance(x, str):
            return "'" + x + "'"
        return str(x)

    values = ", ".join("(" + ", ".join(v(x) for x in row) + ")" for row in ROBOTS_TEMPLATE)
    return f"""
tpl(cls, robots_status, agent, group_seq, rule_seq, allow, path_prefix) AS (VALUES {values}),
hosts AS (SELECT DISTINCT regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1) AS base FROM pages),
rules AS (SELECT h.base, t.robots_status, t.agent, t.group_seq, t.rule_seq, t.allow, t.path_prefix
          FROM hosts h JOIN tpl t ON length(h.base) % {ROBOTS_CLASSES} = t.cls)"""


TIMEOUT_ERROR = "Timeout 30000ms exceeded"
DNS_ERROR = "net::ERR_NAME_NOT_RESOLVED"


def crawl_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The URLs to ingest ``(seq, url)``: every page's, and for ``page_id % 11 = 4`` one more that was never fetched."""
    p = read_table(spark, sf_dir, "pages")
    more = p.where(F.col("page_id") % 11 == 4).select((-1 - F.col("page_id")).alias("seq"), F.concat("url", F.lit("/never-fetched")).alias("url"))
    return p.select(F.col("page_id").alias("seq"), "url").unionByName(more)


CRAWL_URLS_SQL = """
crawl AS (SELECT page_id AS seq, url FROM pages
          UNION ALL SELECT -1 - page_id, url || '/never-fetched' FROM pages WHERE page_id % 11 = 4)"""


def attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fetch-attempt log: every page x attempts 1..4; attempt fails when
    ``(page_id + attempt) % 3 = 0``; every attempt fails for ``page_id % 10 = 9``;
    a successful page answers 404 when ``page_id % 7 = 0``, else 200."""
    p = read_table(spark, sf_dir, "pages")
    a = p.select("page_id", "url", "html", F.explode(F.sequence(F.lit(1), F.lit(4))).alias("attempt"))
    err = F.when(F.col("page_id") % 10 == 9, F.lit(DNS_ERROR)).when((F.col("page_id") + F.col("attempt")) % 3 == 0, F.lit(TIMEOUT_ERROR))
    a = a.withColumn("error", err)
    return a.select(
        "page_id",
        "url",
        "attempt",
        F.when(F.col("error").isNull(), F.when(F.col("page_id") % 7 == 0, F.lit(404)).otherwise(F.lit(200))).alias("status_code"),
        F.when(F.col("error").isNull(), F.col("html")).alias("html"),
        "error",
    )


ATTEMPTS_SQL = f"""
a0 AS (SELECT page_id, url, html, unnest(generate_series(1, 4)) AS attempt FROM pages),
a1 AS (SELECT *, CASE WHEN page_id % 10 = 9 THEN '{DNS_ERROR}'
                      WHEN (page_id + attempt) % 3 = 0 THEN '{TIMEOUT_ERROR}' END AS error FROM a0),
attempts AS (SELECT page_id, url, attempt,
                    CASE WHEN error IS NULL THEN CASE WHEN page_id % 7 = 0 THEN 404 ELSE 200 END END AS status_code,
                    CASE WHEN error IS NULL THEN html END AS html, error FROM a1)"""


def stored_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-table rows already stored: pages with ``page_id % 3 <> 0``."""
    from ..sources.pagestore import FETCHED_BY, conform

    p = read_table(spark, sf_dir, "pages").where(F.col("page_id") % 3 != 0)
    meta = F.create_map(*[x for k, v in FETCHED_BY.items() for x in (F.lit(k), F.lit(v))])
    return conform(
        p.select(
            F.col("page_id").alias("id"),
            "url",
            F.timestamp_seconds(F.lit(1_700_000_000) + F.col("page_id")).alias("fetched_at"),
            F.lit(200).alias("status_code"),
            F.concat(F.lit("stored title "), F.col("page_id").cast("string")).alias("title"),
            F.concat(F.lit("stored "), F.col("url")).alias("text_excerpt"),
            F.concat(F.lit("raw/"), F.sha2(F.encode("html", "UTF-8"), 256), F.lit(".html")).alias("html_path"),
            meta.alias("raw_meta"),
            F.when(F.col("page_id") % 4 != 1, F.concat(F.lit("summary "), F.col("page_id").cast("string"))).alias("summary_text"),
        )
    )


def incoming_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An upsert batch ``(seq, url, status_code, title, lang, text_excerpt, html_path)``:
    pages with ``page_id % 2 = 0`` and those not stored; those with ``page_id % 4 = 0`` are written a
    second time later (304, NULL title and excerpt: NULLs overwrite); plus one
    row without URL."""
    p = read_table(spark, sf_dir, "pages").where((F.col("page_id") % 2 == 0) | (F.col("page_id") % 3 == 0))
    path = F.concat(F.lit("raw/"), F.sha2(F.encode("html", "UTF-8"), 256), F.lit(".html"))
    first = p.select(
        (F.col("page_id") * 2).alias("seq"),
        "url",
        F.lit(200).alias("status_code"),
        F.concat(F.lit("title "), F.col("page_id").cast("string")).alias("title"),
        F.lit(None).cast("string").alias("lang"),
        F.concat(F.lit("excerpt "), F.col("url")).alias("text_excerpt"),
        path.alias("html_path"),
    )
    again = p.where(F.col("page_id") % 4 == 0).select(
        (F.col("page_id") * 2 + 1).alias("seq"),
        "url",
        F.lit(304).alias("status_code"),
        F.lit(None).cast("string").alias("title"),
        F.lit("en").alias("lang"),
        F.lit(None).cast("string").alias("text_excerpt"),
        path.alias("html_path"),
    )
    no_url = first.orderBy("seq").limit(1).select(
        F.lit(-1).cast("bigint").alias("seq"), F.lit(None).cast("string").alias("url"), *first.columns[2:]
    )
    return first.unionByName(again).unionByName(no_url)


UPSERT_FIXTURES_SQL = """
stored AS (SELECT page_id AS id, url, 200 AS status_code, 'stored title ' || page_id AS title,
                  CAST(NULL AS VARCHAR) AS lang, 'stored ' || url AS text_excerpt,
                  'raw/' || sha256(html) || '.html' AS html_path,
                  CASE WHEN page_id % 4 <> 1 THEN 'summary ' || page_id END AS summary_text
           FROM pages WHERE page_id % 3 <> 0),
inc1 AS (SELECT page_id * 2 AS seq, url, 200 AS status_code, 'title ' || page_id AS title, CAST(NULL AS VARCHAR) AS lang,
                'excerpt ' || url AS text_excerpt, 'raw/' || sha256(html) || '.html' AS html_path
         FROM pages WHERE page_id % 2 = 0 OR page_id % 3 = 0),
incoming AS (SELECT * FROM inc1
             UNION ALL
             SELECT page_id * 2 + 1, url, 304, NULL, 'en', NULL, 'raw/' || sha256(html) || '.html'
             FROM pages WHERE page_id % 4 = 0
             UNION ALL
             SELECT -1, NULL, status_code, title, lang, text_excerpt, html_path FROM inc1
             WHERE seq = (SELECT min(seq) FROM inc1))"""
