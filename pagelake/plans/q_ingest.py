"""Ingest and queue queries: S1, S3, I1-I4, F1, F3."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import ingest as I
from ..operators.ingest import NO_ATTEMPT
from ..operators.extract import raw_digest
from ..session import read_table, scratch_path
from ..sources import pagestore, urls
from . import fixtures as X
from .registry import register

BASE_SQL = "regexp_extract(url, '^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)', 1)"
PATH_SQL = (
    "CASE WHEN regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(.*)$', 1) = '' THEN '/' "
    "ELSE regexp_extract(url, '^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(.*)$', 1) END"
)
TOKEN = I.agent_token(I.USER_AGENT)


def admission_sql() -> str:
    return f"""
{X.robots_rules_sql()},
{X.CRAWL_URLS_SQL},
u AS (SELECT seq, url, {BASE_SQL} AS base, {PATH_SQL} AS path FROM crawl),
j AS (SELECT u.seq, u.url, u.path, r.*,
             (r.agent IS NOT NULL AND r.agent <> '*' AND contains('{TOKEN}', lower(r.agent))) AS named,
             (r.agent = '*') AS star,
             (r.rule_seq IS NOT NULL AND (r.path_prefix = '*' OR starts_with(u.path, r.path_prefix))) AS matches,
             (r.allow OR r.path_prefix = '') AS allow_val,
             r.group_seq * 1000000 + r.rule_seq AS k
      FROM u LEFT JOIN rules r ON u.base = r.base),
a AS (SELECT seq, url, max(robots_status) AS status,
             min(CASE WHEN named THEN group_seq END) AS g_named,
             min(CASE WHEN named AND matches THEN k END) AS k_named,
             arg_min(allow_val, k) FILTER (WHERE named AND matches) AS a_named,
             min(CASE WHEN star THEN group_seq END) AS g_star,
             min(CASE WHEN star AND matches THEN k END) AS k_star,
             arg_min(allow_val, k) FILTER (WHERE star AND matches) AS a_star
      FROM j GROUP BY seq, url),
adm AS (SELECT seq, url,
       CASE WHEN status IS NULL THEN {str(I.ALLOW_ROBOTS_FALLBACK).lower()}
            WHEN status IN (401, 403) THEN false
            WHEN status >= 400 AND status < 500 THEN true
            WHEN status >= 500 THEN false
            WHEN g_named IS NOT NULL THEN CASE WHEN k_named // 1000000 = g_named THEN a_named ELSE true END
            WHEN g_star IS NOT NULL THEN CASE WHEN k_star // 1000000 = g_star THEN a_star ELSE true END
            ELSE true END AS allowed,
       CASE WHEN status IS NULL THEN 'robots_unreadable'
            WHEN status IN (401, 403) THEN 'robots_forbidden'
            WHEN status >= 400 AND status < 500 THEN 'robots_missing'
            WHEN status >= 500 THEN 'robots_server_error'
            ELSE 'robots_rules' END AS reason
FROM a)"""


def _admission(spark, sf_dir):
    return I.robots_admission(X.crawl_urls(spark, sf_dir), X.robots_rules(spark, sf_dir), "url", "seq")


@register("robots_admission", f"WITH {admission_sql()} SELECT seq, url, allowed, reason FROM adm")
def robots_admission(spark, sf_dir):
    """May the crawler fetch each page URL, from per-host parsed robots rules."""
    return _admission(spark, sf_dir)


@register(
    "fetch_outcomes",
    f"""
WITH {admission_sql()}, {X.ATTEMPTS_SQL},
w AS (SELECT * FROM attempts WHERE attempt <= {I.FETCH_RETRIES + 1}
      QUALIFY row_number() OVER (PARTITION BY url ORDER BY CASE WHEN error IS NULL THEN attempt ELSE 1000000 - attempt END) = 1)
SELECT adm.seq, adm.url,
       CASE WHEN NOT adm.allowed THEN 'blocked_by_robots' WHEN w.url IS NOT NULL AND w.error IS NULL THEN 'ok' ELSE 'error' END AS status,
       CASE WHEN adm.allowed AND w.error IS NULL THEN w.status_code END AS status_code,
       CASE WHEN adm.allowed THEN w.attempt END AS attempt,
       CASE WHEN adm.allowed AND w.url IS NULL THEN 'no fetch attempt recorded' WHEN adm.allowed THEN w.error END AS error,
       CASE WHEN adm.allowed AND w.error IS NULL THEN sha256(w.html) END AS digest
FROM adm LEFT JOIN w ON adm.url = w.url
""",
)
def fetch_outcomes(spark, sf_dir):
    """I2 + I3: admission, then the first successful attempt (of 3) or the last error."""
    adm = _admission(spark, sf_dir)
    # the pages themselves stay where they are: their digests take part
    log = X.attempts(spark, sf_dir).drop("page_id").withColumn("html", raw_digest("html"))
    res = I.resolve_attempts(log, "url")
    j = adm.join(res, "url", "left")  # a blocked URL has no attempt, by nature
    tried = F.coalesce(F.col("ok"), F.lit(False))
    ok = F.col("allowed") & tried
    return j.select(
        "seq",
        "url",
        F.when(~F.col("allowed"), F.lit("blocked_by_robots")).when(tried, F.lit("ok")).otherwise(F.lit("error")).alias("status"),
        F.when(ok, F.col("status_code")).alias("status_code"),
        F.when(F.col("allowed"), F.col("attempt")).alias("attempt"),
        F.when(F.col("allowed") & ~tried, F.coalesce("error", F.lit(NO_ATTEMPT))).alias("error"),
        F.when(ok, F.col("html")).alias("digest"),
    )


def upsert_tail_sql(incoming: str) -> str:
    """CTEs ``red, old, new``: the batch ``incoming`` upserted into ``stored`` by URL."""
    return f"""
red AS (SELECT *, min(seq) OVER (PARTITION BY url) AS first_seq FROM {incoming} WHERE url IS NOT NULL
        QUALIFY row_number() OVER (PARTITION BY url ORDER BY seq DESC) = 1),
old AS (SELECT s.id, s.url,
               CASE WHEN r.url IS NOT NULL THEN r.status_code ELSE s.status_code END AS status_code,
               CASE WHEN r.url IS NOT NULL THEN r.title ELSE s.title END AS title,
               CASE WHEN r.url IS NOT NULL THEN r.lang ELSE s.lang END AS lang,
               CASE WHEN r.url IS NOT NULL THEN r.text_excerpt ELSE s.text_excerpt END AS text_excerpt,
               CASE WHEN r.url IS NOT NULL THEN r.html_path ELSE s.html_path END AS html_path,
               s.summary_text, false AS is_new
        FROM stored s LEFT JOIN red r ON s.url = r.url),
new AS (SELECT (SELECT coalesce(max(id), 0) FROM stored) + row_number() OVER (ORDER BY r.first_seq) AS id,
               r.url, r.status_code, r.title, r.lang, r.text_excerpt, r.html_path,
               CAST(NULL AS VARCHAR) AS summary_text, true AS is_new
        FROM red r WHERE r.url NOT IN (SELECT url FROM stored))"""


@register(
    "upsert_pages",
    f"""
WITH {X.UPSERT_FIXTURES_SQL},
{upsert_tail_sql('incoming').strip()}
SELECT * FROM old UNION ALL SELECT * FROM new
""",
)
def upsert_pages(spark, sf_dir):
    """I4: upsert an incoming batch into the stored page table by URL."""
    out = I.upsert_pages(X.stored_pages(spark, sf_dir), X.incoming_pages(spark, sf_dir))
    return out.select("id", "url", "status_code", "title", "lang", "text_excerpt", "html_path", "summary_text", "is_new")


def summary_pages(spark, sf_dir):
    """Documents seen as page rows for the queue: ``summary_text`` NULL when the
    document has no label row, ``''`` when ``quality = 0``, else its text."""
    d = read_table(spark, sf_dir, "documents")
    lab = read_table(spark, sf_dir, "labels")
    j = d.join(lab, "doc_id", "left")
    return pagestore.conform(
        j.select(
            F.col("doc_id").alias("id"),
            F.concat(F.lit("doc://"), F.col("doc_id").cast("string")).alias("url"),
            F.col("text").alias("text_excerpt"),
            F.col("lang"),
            F.when(F.col("quality").isNull(), F.lit(None).cast("string"))
            .when(F.col("quality") == 0, F.lit(""))
            .otherwise(F.col("text"))
            .alias("summary_text"),
        )
    )


PENDING_SQL = """
SELECT d.doc_id AS id, d.text AS text_excerpt
FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id
WHERE (l.doc_id IS NULL OR l.quality = 0)"""


@register("pending_pages", f"SELECT id, text_excerpt FROM ({PENDING_SQL}) WHERE coalesce(text_excerpt, '') <> ''")
def pending_pages(spark, sf_dir):
    """every page still waiting for a summary (NULL or empty summary, non-empty text)."""
    return I.pending(summary_pages(spark, sf_dir)).select("id", "text_excerpt")


QUEUE_LIMIT = 50


@register(
    "pending_batch",
    f"SELECT id, text_excerpt FROM ({PENDING_SQL} ORDER BY id LIMIT {QUEUE_LIMIT}) WHERE coalesce(text_excerpt, '') <> ''",
)
def pending_batch(spark, sf_dir):
    """F1 as the queue runs it: the next 50 pending pages by id (the limit is the
    feature: one batch per run), then empty texts skipped."""
    return I.pending(summary_pages(spark, sf_dir), limit=QUEUE_LIMIT).select("id", "text_excerpt")


@register(
    "page_lookup",
    """
WITH q AS (SELECT url AS requested FROM pages UNION ALL SELECT url || '#missing' FROM pages)
SELECT q.requested, p.page_id FROM q LEFT JOIN pages p ON q.requested = p.url
""",
)
def page_lookup(spark, sf_dir):
    """F3 in bulk: every page URL and a variant that is not stored, looked up by URL."""
    p = read_table(spark, sf_dir, "pages")
    req = p.select(F.col("url").alias("requested")).unionByName(
        p.select(F.concat("url", F.lit("#missing")).alias("requested"))
    )
    j = req.join(p.select("url", "page_id"), req["requested"] == p["url"], "left")
    return j.select("requested", "page_id")


@register(
    "pages_table",
    """
SELECT page_id AS id, url, 'raw/' || sha256(html) || '.html' AS html_path, 'playwright' AS fetched_by FROM pages
""",
)
def pages_table(spark, sf_dir):
    """S3: the declared page table written as a snapshot and read back with its schema."""
    p = read_table(spark, sf_dir, "pages")
    meta = F.create_map(F.lit("fetched_by"), F.lit("playwright"))
    rows = p.select(
        F.col("page_id").alias("id"),
        "url",
        F.concat(F.lit("raw/"), raw_digest("html"), F.lit(".html")).alias("html_path"),
        meta.alias("raw_meta"),
    )
    path = scratch_path(spark, "pages-table")
    pagestore.write_snapshot(rows, path)
    back = pagestore.read_pages(spark, path)
    return back.select("id", "url", "html_path", F.col("raw_meta")["fetched_by"].alias("fetched_by"))


@register("url_source", "SELECT CAST(row_number() OVER (ORDER BY page_id) - 1 AS BIGINT) AS seq, url FROM pages")
def url_source(spark, sf_dir):
    """Page URLs written one per line (padded, with blank lines between) and read back in order."""
    p = read_table(spark, sf_dir, "pages")
    lines = p.select(
        "page_id",
        F.posexplode(F.array(F.concat(F.lit("  "), F.col("url"), F.lit(" ")), F.lit("   "))).alias("k", "line"),
    ).select((F.col("page_id") * 2 + F.col("k")).alias("o"), F.col("line").alias("url"))
    path = scratch_path(spark, "urls")
    urls.write_url_list(lines, path, "o")
    return urls.read_url_list(spark, path)
