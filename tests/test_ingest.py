"""Robots admission, attempt resolution, upsert by URL, queue, URL list."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from pagelake.operators import ingest as I
from pagelake.session import scratch_path
from pagelake.sources import pagestore, urls

RULES_SCHEMA = "base string, robots_status int, agent string, group_seq int, rule_seq int, allow boolean, path_prefix string"


def test_robots_admission(spark):
    rules = spark.createDataFrame(
        [
            # specific group first; first matching rule wins (not the longest)
            ("https://a.org", 200, "PagelakeBot", 1, 1, False, "/private"),
            ("https://a.org", 200, "PagelakeBot", 1, 2, True, "/private/open"),
            ("https://a.org", 200, "*", 2, 1, False, "/"),
            # only '*' applies; an empty Disallow allows
            ("https://b.org", 200, "otherbot", 1, 1, False, "/"),
            ("https://b.org", 200, "*", 2, 1, True, ""),
            ("https://c.org", 401, None, None, None, None, None),
            ("https://d.org", 404, None, None, None, None, None),
            ("https://e.org", 503, None, None, None, None, None),
            ("https://f.org", None, None, None, None, None, None),
            # a specific group that has no matching rule still decides: allowed
            ("https://g.org", 200, "pagelakebot", 1, 1, False, "/x"),
            ("https://g.org", 200, "*", 2, 1, False, "/"),
        ],
        RULES_SCHEMA,
    )
    cases = [
        ("https://a.org/private/open/1", False),
        ("https://a.org/public", True),
        ("https://b.org/anything", True),
        ("https://c.org/", False),
        ("https://d.org/", True),
        ("https://e.org/", False),
        ("https://f.org/", True),  # unreadable: fallback flag
        ("https://unknown.org/", True),  # no robots row at all: fallback flag
        ("https://g.org/y", True),
        ("https://g.org/x1", False),
    ]
    u = spark.createDataFrame([(i, url) for i, (url, _) in enumerate(cases)], "seq long, url string")
    got = {r.url: r.allowed for r in I.robots_admission(u, rules).collect()}
    assert got == dict(cases)
    strict = {r.url: r.allowed for r in I.robots_admission(u, rules, fallback=False).collect()}
    assert strict["https://f.org/"] is False and strict["https://unknown.org/"] is False


def test_attempt_resolution(spark):
    rows = [
        ("u1", 1, None, None, "timeout"),
        ("u1", 2, 404, "<p>x</p>", None),  # HTTP status is not checked: success
        ("u1", 3, 200, "<p>y</p>", None),
        ("u2", 1, None, None, "e1"),
        ("u2", 2, None, None, "e2"),
        ("u2", 3, None, None, "e3"),
        ("u2", 4, 200, "<p>late</p>", None),  # beyond retries + 1
    ]
    a = spark.createDataFrame(rows, "url string, attempt int, status_code int, html string, error string")
    got = {r.url: (r.attempt, r.status_code, r.error, r.ok) for r in I.resolve_attempts(a).collect()}
    assert got == {"u1": (2, 404, None, True), "u2": (3, None, "e3", False)}


def _stored(spark):
    ts = dt.datetime(2024, 1, 1)
    df = spark.createDataFrame(
        [
            (1, "https://a/", ts, 200, "A", "en", "old a", "raw/a.html", {"fetched_by": "playwright"}, "sum a", ["k"], [1.0]),
            (5, "https://b/", ts, 200, "B", "de", "old b", "raw/b.html", {"fetched_by": "playwright"}, None, None, None),
        ],
        pagestore.PAGES_SCHEMA,
    )
    return df


def test_upsert_semantics(spark):
    batch = spark.createDataFrame(
        [
            (10, "https://a/", 500, None, None, "new a", "raw/a2.html"),  # NULLs overwrite
            (11, "https://c/", 200, "C1", "en", "c first", "raw/c.html"),
            (12, None, 200, "nourl", "en", "x", "raw/x.html"),  # dropped
            (13, "https://c/", 304, "C2", "fr", "c last", "raw/c2.html"),  # last write wins
            (14, "https://d/", 200, "D", "en", "d", "raw/d.html"),
        ],
        "seq long, url string, status_code int, title string, lang string, text_excerpt string, html_path string",
    )
    now = F.lit(dt.datetime(2025, 1, 1)).cast("timestamp")
    out = {r.url: r for r in I.upsert_pages(_stored(spark), batch, now=now).collect()}
    assert set(out) == {"https://a/", "https://b/", "https://c/", "https://d/"}
    a = out["https://a/"]
    assert (a.id, a.status_code, a.title, a.lang, a.text_excerpt, a.html_path) == (1, 500, None, None, "new a", "raw/a2.html")
    # kept on update: id, fetched_at, raw_meta, enrichment columns
    assert (a.fetched_at, a.summary_text, a.summary_keywords, a.embedding) == (dt.datetime(2024, 1, 1), "sum a", ["k"], [1.0])
    assert out["https://b/"].text_excerpt == "old b" and not out["https://b/"].is_new
    c, d = out["https://c/"], out["https://d/"]
    assert (c.id, c.title, c.status_code, c.is_new) == (6, "C2", 304, True)  # first-seen order gives the id
    assert (d.id, d.fetched_at, d.raw_meta) == (7, dt.datetime(2025, 1, 1), {"fetched_by": "playwright"})
    assert c.summary_text is None


def test_upsert_is_idempotent_for_the_same_batch(spark):
    batch = spark.createDataFrame(
        [(1, "https://c/", 200, "C", "en", "c", "raw/c.html")],
        "seq long, url string, status_code int, title string, lang string, text_excerpt string, html_path string",
    )
    once = I.upsert_pages(_stored(spark), batch).drop("is_new", "fetched_at")
    twice = I.upsert_pages(once.withColumn("fetched_at", F.current_timestamp()), batch).drop("is_new", "fetched_at")
    assert sorted(map(tuple, once.collect()), key=repr) == sorted(map(tuple, twice.collect()), key=repr)


def test_pending_queue(spark):
    pages = spark.createDataFrame(
        [(1, None, "t1"), (2, "", ""), (3, "done", "t3"), (4, None, "t4"), (5, "", "t5")],
        "id long, summary_text string, text_excerpt string",
    )
    assert [r.id for r in I.pending(pages).orderBy("id").collect()] == [1, 4, 5]
    # the limit is taken before empty texts are skipped (they use up the batch)
    assert [r.id for r in I.pending(pages, limit=2).collect()] == [1]
    assert [r.id for r in I.pending(pages, limit=2, skip_empty_first=True).orderBy("id").collect()] == [1, 4]


def test_lookup(spark):
    pages = _stored(spark)
    req = spark.createDataFrame([("https://a/",), ("https://zzz/",)], "url string")
    got = {r[0]: r["id"] for r in I.lookup(pages, req).select(req["url"], pages["id"]).collect()}
    assert got == {"https://a/": 1, "https://zzz/": None}


def test_url_list_order_blanks_duplicates(spark, tmp_path):
    p = tmp_path / "urls.txt"
    p.write_text("  https://x/1 \n\n https://x/2\nhttps://x/1\n   \nhttps://x/3\n")
    got = [(r.seq, r.url) for r in urls.read_url_list(spark, str(p)).orderBy("seq").collect()]
    assert got == [(0, "https://x/1"), (1, "https://x/2"), (2, "https://x/1"), (3, "https://x/3")]


def test_page_snapshot_roundtrip(spark):
    path = scratch_path(spark, "t-pages")
    pagestore.write_snapshot(_stored(spark), path)
    back = pagestore.read_pages(spark, path)
    assert back.schema == pagestore.PAGES_SCHEMA or [f.name for f in back.schema] == pagestore.COLUMNS
    assert back.count() == 2
    with pytest.raises(Exception):
        pagestore.write_snapshot(_stored(spark), path)  # never overwrite a snapshot


def test_robots_paths_in_any_spelling(spark):
    """The standard library's parser, told the same rules, decides alike."""
    from urllib.robotparser import RobotFileParser

    prefixes = ["/a%20b", "/caf%C3%A9", "/x y", "/q?a=1", "/100%", "/plus+sign", "/tilde~"]
    parser = RobotFileParser()
    parser.parse(["User-agent: *", *(f"Disallow: {p}" for p in prefixes)])
    paths = ["/a b/x", "/a%20b/x", "/café/x", "/caf%c3%a9/x", "/x%20y", "/q?a=1", "/q?a=2", "/100%25", "/plus+sign", "/tilde%7E", "/free"]
    rules = spark.createDataFrame([("https://h.org", 200, "*", 1, i, False, p) for i, p in enumerate(prefixes)], RULES_SCHEMA)
    urls_df = spark.createDataFrame([(i, "https://h.org" + p) for i, p in enumerate(paths)], "seq long, url string")
    got = {r["seq"]: r["allowed"] for r in I.robots_admission(urls_df, rules).collect()}
    assert got == {i: parser.can_fetch("PagelakeBot", "https://h.org" + p) for i, p in enumerate(paths)}


def test_a_group_of_star_and_an_agent_is_the_default_only(spark):
    rules = spark.createDataFrame(
        [("https://h.org", 200, "*", 1, 1, False, "/"), ("https://h.org", 200, "PagelakeBot", 1, 1, False, "/"), ("https://h.org", 200, "pagelake", 2, 1, True, "/")],
        RULES_SCHEMA,
    )
    urls_df = spark.createDataFrame([(1, "https://h.org/x")], "seq long, url string")
    assert I.robots_admission(urls_df, rules).first()["allowed"]


def test_each_valid_escape_counts(spark):
    paths = ["/100%/caf%C3%A9", "/100%/café", "/100%25/caf%c3%a9", "/a%2", "/a%252", "/%zz%41", "/%25zzA", "/a+b", "/a%2Bb"]
    df = spark.createDataFrame([(p,) for p in paths], "p string")
    got = [r.n for r in df.select(I.normal_path(F.col("p")).alias("n")).collect()]
    assert got[0] == got[1] == got[2] and got[3] == got[4] and got[5] == got[6] and got[7] == got[8]
    assert len(set(got)) == 4


def test_urls_are_not_aggregated(spark):
    rules = spark.createDataFrame([("https://a.org", 200, "*", 1, i, i % 2 == 0, f"/{i}") for i in range(5)], RULES_SCHEMA)
    urls = spark.createDataFrame([(i, f"https://a.org/{i}") for i in range(6)] * 2, "seq long, url string")
    out = I.robots_admission(urls, rules)
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert not [line for line in plan.splitlines() if "Aggregate [" in line and "base" not in line.split("]")[0]]  # only rules, by host
    assert sorted((r.seq, r.allowed) for r in out.collect()) == sorted([(i, i % 2 == 0 or i == 5) for i in range(6)] * 2)
