"""Text queries on ``documents``: T1-T6, F4."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.text import STOP_WORDS, WORD, WS, excerpt, keyword_tokens
from ..operators import text as T
from ..session import read_table, spread
from .registry import register

MAX_CHARS, OVERLAP = 4000, 200
EXCERPT_CHARS = 1000

# SQL building blocks for the oracle (RE2 syntax, same classes as the Spark side)
STOP_SQL = "[" + ", ".join(f"'{w}'" for w in sorted(set(STOP_WORDS))) + "]"
STRIP_SQL = "regexp_replace({x}, '^[" + WS + "]+|[" + WS + "]+$', '', 'g')"
TOKENS_SQL = (
    "list_filter(string_split_regex(regexp_replace(lower({x}), '[^" + WORD + WS + "]', ' ', 'g'), '[" + WS + "]+'), "
    "lambda t: length(t) >= 3 AND NOT list_contains(" + STOP_SQL + ", t))"
)
STEP = MAX_CHARS - OVERLAP
NCHUNK_SQL = (
    "CASE WHEN {x} IS NULL OR length({x}) = 0 THEN 0 WHEN length({x}) <= " + str(MAX_CHARS) + " THEN 1 "
    "ELSE 1 + CAST(floor((length({x}) - " + str(MAX_CHARS) + " + " + str(STEP - 1) + ") / " + str(STEP) + ") AS INTEGER) END"
)


def strip_sql(x: str) -> str:
    return STRIP_SQL.replace("{x}", x)


def tokens_sql(x: str) -> str:
    return TOKENS_SQL.replace("{x}", x)


def nchunk_sql(x: str) -> str:
    return NCHUNK_SQL.replace("{x}", x)


def summary_sql(source: str, name: str) -> str:
    """CTEs ending in ``name(id, k, summary)``: of every text ``source(id, k, x)`` the three sentences whose
    keyword tokens are the most frequent in it on average, in text order; without a sentence the stripped text."""
    return f"""
{name}_r AS (SELECT id, k, regexp_extract_all(x, '[^.!?。！？\\n]+[.!?。！？]*') AS parts FROM {source}),
{name}_s AS (SELECT id, k, p, {strip_sql('raw')} AS s FROM
             (SELECT id, k, unnest(parts) AS raw, generate_subscripts(parts, 1) AS p FROM {name}_r) WHERE {strip_sql('raw')} <> ''),
{name}_t AS (SELECT id, k, p, unnest({tokens_sql('s')}) AS tok FROM {name}_s),
{name}_f AS (SELECT id, k, tok, count(*) AS n FROM {name}_t GROUP BY ALL),
{name}_m AS (SELECT t.id, t.k, t.p, CAST(sum(f.n) AS DOUBLE) / count(*) AS score
             FROM {name}_t t JOIN {name}_f f ON f.id = t.id AND f.k = t.k AND f.tok = t.tok GROUP BY ALL),
{name}_b AS (SELECT s.id, s.k, s.p, s.s FROM {name}_s s LEFT JOIN {name}_m m ON m.id = s.id AND m.k = s.k AND m.p = s.p
             QUALIFY row_number() OVER (PARTITION BY s.id, s.k ORDER BY coalesce(m.score, 0) DESC, s.p) <= 3),
{name} AS (SELECT c.id, c.k, coalesce(g.summary, {strip_sql('c.x')}) AS summary FROM {source} c
           LEFT JOIN (SELECT id, k, string_agg(s, ' ' ORDER BY p) AS summary FROM {name}_b GROUP BY id, k) g ON g.id = c.id AND g.k = c.k)"""


def record_sql(docs: str) -> str:
    """CTEs ``cs`` (chunk summaries), ``j`` (id, joined, n) and ``fin`` (id, summary) of the texts ``docs(id, text)``."""
    return f"""
ch AS (SELECT id, k, substring(text, CAST(k * {STEP} + 1 AS BIGINT), {MAX_CHARS}) AS x
       FROM (SELECT id, text, unnest(generate_series(0, {nchunk_sql('text')} - 1)) AS k FROM {docs})),
{summary_sql('ch', 'cs').strip()},
j AS (SELECT id, 0 AS k, string_agg(summary, chr(10) || chr(10) ORDER BY k) AS x, count(*) AS n FROM cs GROUP BY id),
{summary_sql('j', 'fin').strip()}"""


CHUNKS_SQL = f"""
WITH c AS (SELECT doc_id, text, unnest(generate_series(0, {nchunk_sql('text')} - 1)) AS i FROM documents)
SELECT doc_id, CAST(i AS INTEGER) AS chunk_idx, CAST(i * {STEP} AS INTEGER) AS start_idx,
       CAST(least(i * {STEP} + {MAX_CHARS}, length(text)) AS INTEGER) AS end_idx,
       substring(text, CAST(i * {STEP} + 1 AS BIGINT), {MAX_CHARS}) AS chunk
FROM c
"""


@register("chunks", CHUNKS_SQL)
def chunks(spark, sf_dir):
    """Overlapping character chunks of every document (4000 / 200)."""
    return T.chunks(read_table(spark, sf_dir, "documents"), "doc_id", "text", MAX_CHARS, OVERLAP)


@register(
    "keyword_tokens",
    f"""
SELECT doc_id, CAST(len(tk) AS INTEGER) AS n_tokens, array_to_string(tk, ' ') AS tokens
FROM (SELECT doc_id, {tokens_sql('text')} AS tk FROM documents)
""",
)
def keyword_tokens_q(spark, sf_dir):
    """Keyword tokens of every document."""
    d = spread(read_table(spark, sf_dir, "documents"), "doc_id").select("doc_id", keyword_tokens("text").alias("tk"))
    return d.select("doc_id", F.size("tk").alias("n_tokens"), F.array_join("tk", " ").alias("tokens"))


def _top_kw_sql(source: str, k: int) -> str:
    return f"""
WITH t AS (SELECT doc_id, unnest(tk) AS keyword, generate_subscripts(tk, 1) AS pos
           FROM (SELECT doc_id, {tokens_sql('text')} AS tk FROM {source})),
c AS (SELECT doc_id, keyword, count(*) AS cnt, min(pos) AS first_pos FROM t GROUP BY doc_id, keyword)
SELECT doc_id, CAST(row_number() OVER (PARTITION BY doc_id ORDER BY cnt DESC, first_pos) AS BIGINT) AS rank,
       keyword, cnt
FROM c QUALIFY rank <= {k}
"""


@register("top_keywords", _top_kw_sql("documents", 10))
def top_keywords(spark, sf_dir):
    """Top 10 keywords per document by count, ties by first occurrence."""
    return T.top_keywords(read_table(spark, sf_dir, "documents"), "doc_id", "text", 10)


@register(
    "chunk_summaries",
    f"""
WITH d AS (SELECT doc_id AS id, text FROM documents),
{record_sql('d').strip()}
SELECT id AS doc_id, CAST(k AS INTEGER) AS chunk_idx, summary FROM cs
""",
)
def chunk_summaries(spark, sf_dir):
    """T4: extractive summary of every whole chunk."""
    return T.chunk_summaries(read_table(spark, sf_dir, "documents"), "doc_id", "text", MAX_CHARS, OVERLAP)


@register(
    "final_summary",
    f"""
WITH d AS (SELECT doc_id AS id, text FROM documents),
{record_sql('d').strip()}
SELECT d.id AS doc_id, coalesce(fin.summary, '') AS final_summary, CAST(coalesce(j.n, 0) AS INTEGER) AS num_chunks
FROM d LEFT JOIN j ON j.id = d.id LEFT JOIN fin ON fin.id = d.id
""",
)
def final_summary(spark, sf_dir):
    """T5: the summary of all chunk summaries of a document."""
    s = T.summarize(read_table(spark, sf_dir, "documents"), "doc_id", "text", MAX_CHARS, OVERLAP, 15)
    return s.select("doc_id", "final_summary", "num_chunks")


@register(
    "summarize",
    f"""
WITH d AS (SELECT doc_id AS id, text FROM documents),
{record_sql('d').strip()},
t AS (SELECT id, unnest(tk) AS keyword, generate_subscripts(tk, 1) AS pos FROM (SELECT id, {tokens_sql('x')} AS tk FROM j)),
c AS (SELECT id, keyword, count(*) AS cnt, min(pos) AS first_pos FROM t GROUP BY id, keyword),
r AS (SELECT id, keyword, row_number() OVER (PARTITION BY id ORDER BY cnt DESC, first_pos) AS rk FROM c QUALIFY rk <= 15),
k AS (SELECT id, string_agg(keyword, ',' ORDER BY rk) AS keywords FROM r GROUP BY id)
SELECT d.id AS doc_id, coalesce(fin.summary, '') AS final_summary, CAST(coalesce(j.n, 0) AS INTEGER) AS num_chunks,
       coalesce(k.keywords, '') AS keywords, md5(coalesce(j.x, '')) AS chunk_summaries_md5
FROM d LEFT JOIN j ON j.id = d.id LEFT JOIN fin ON fin.id = d.id LEFT JOIN k ON k.id = d.id
""",
)
def summarize(spark, sf_dir):
    """The whole summary record per document; keywords (15) from the joined chunk summaries."""
    s = T.summarize(read_table(spark, sf_dir, "documents"), "doc_id", "text", MAX_CHARS, OVERLAP, 15)
    return s.select(
        "doc_id",
        "final_summary",
        "num_chunks",
        F.array_join("keywords", ",").alias("keywords"),
        F.md5(F.array_join("chunk_summaries", "\n\n")).alias("chunk_summaries_md5"),
    )


@register(
    "excerpt",
    f"""
SELECT doc_id, coalesce(substring(text, 1, {EXCERPT_CHARS}), '') AS excerpt,
       CAST(length(coalesce(substring(text, 1, {EXCERPT_CHARS}), '')) AS INTEGER) AS len_text
FROM documents
""",
)
def excerpt_q(spark, sf_dir):
    """excerpt of the first 1000 characters and its length."""
    d = read_table(spark, sf_dir, "documents").select("doc_id", excerpt("text", EXCERPT_CHARS).alias("excerpt"))
    return d.select("doc_id", "excerpt", F.length("excerpt").alias("len_text"))
