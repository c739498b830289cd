"""Ingest jobs: robots admission (I1), attempt resolution and outcomes (I2, I3),
upsert by URL (I4), pending queue (F1), bulk lookup (F3).

Robots semantics (those of Python's standard robots parser, applied to a
table of already-parsed rules):

* the agent token is the user agent up to ``/``, lower-cased; a rule group
  applies when one of its agents is ``*`` or a substring of the token;
* groups for named agents are tried in file order; the first group that
  applies decides, even when none of its rules matches (then: allowed);
  otherwise the first ``*`` group decides; no group: allowed;
* inside the deciding group the first rule (file order) whose path prefix
  starts the URL's path (or is ``*``) decides; an empty ``Disallow`` allows;
* robots answered 401/403: refused; other 4xx: allowed; 5xx: refused;
  robots unreadable or unknown (``robots_status`` NULL / host absent):
  the fallback flag.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import written
from .indexing import broadcast_if_small, dense_positions

# Configuration defaults: the crawler's user agent, and fixed values.
USER_AGENT = "PagelakeBot/1.0 (+https://example.org/bot)"
FETCH_RETRIES = 2
MAX_TEXT_SIZE = 200_000
ALLOW_ROBOTS_FALLBACK = True

NO_ATTEMPT = "no fetch attempt recorded"

SCHEME_HOST_RE = r"^([a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*)"
PATH_RE = r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*(.*)$"


def agent_token(user_agent: str) -> str:
    return user_agent.split("/")[0].lower()


def site_base(url: Column) -> Column:
    """``scheme://netloc`` of a URL (the robots key)."""
    return F.regexp_extract(url, SCHEME_HOST_RE, 1)


def url_path(url: Column) -> Column:
    """Path, parameters, query and fragment; ``/`` when empty."""
    p = F.regexp_extract(url, PATH_RE, 1)
    return F.when(p == "", F.lit("/")).otherwise(p)


def normal_path(path: Column) -> Column:
    """A path with its percent-escapes decoded and written anew, so that all spellings of it compare equal.
    A percent sign that begins no valid escape stands for itself."""
    escaped = F.regexp_replace(path, "%(?![0-9a-fA-F]{2})", "%25")
    quoted = F.url_encode(F.url_decode(F.replace(escaped, F.lit("+"), F.lit("%2B"))))
    for escape, char in (("+", "%20"), ("%2F", "/"), ("%7E", "~")):
        quoted = F.replace(quoted, F.lit(escape), F.lit(char))
    return quoted


def host_rules(rules: DataFrame, user_agent: str = USER_AGENT) -> DataFrame:
    """``base, status, decisions``: one row per host, with the rules that decide for one user agent, in order, as an array
    of (``prefix`` in its normal spelling, ``allow``)."""
    token = agent_token(user_agent)
    group = rules.groupBy("base", "group_seq").agg(
        F.max("robots_status").alias("status"),
        # a group that names "*" beside other agents is only the default
        F.coalesce(F.max(F.col("agent") == "*"), F.lit(False)).alias("_star"),
        F.coalesce(F.max(F.instr(F.lit(token), F.lower(F.col("agent"))) > 0), F.lit(False)).alias("_named"),
        F.array_sort(
            F.collect_set(
                F.when(
                    F.col("rule_seq").isNotNull() & F.col("path_prefix").isNotNull(),
                    # an empty Disallow allows everything
                    F.struct("rule_seq", normal_path(F.col("path_prefix")).alias("prefix"), (F.col("allow") | (F.col("path_prefix") == "")).alias("allow")),
                )
            )
        ).alias("decisions"),
    )
    # the first group for this agent, else the first default one
    first = F.min(F.when(F.col("_star"), F.struct(F.lit(1), "group_seq", "decisions")).when(F.col("_named"), F.struct(F.lit(0), "group_seq", "decisions")))
    return group.groupBy("base").agg(F.max("status").alias("status"), first["decisions"].alias("decisions"))


def robots_admission(
    urls: DataFrame,
    rules: DataFrame,
    url_col: str = "url",
    key_col: str = "seq",
    user_agent: str = USER_AGENT,
    fallback: bool = ALLOW_ROBOTS_FALLBACK,
    max_broadcast_rules: int = 2_000_000,
) -> DataFrame:
    """``key, url, allowed, reason`` for every URL.

    ``rules``: ``(base, robots_status, agent, group_seq, rule_seq, allow, path_prefix)``;
    hosts without rules have one row with NULL agent. The rules of a host become one row
    (a host's rules are what one robots file holds), so a URL meets one row and is decided there:
    nothing is aggregated over URLs. The hosts are broadcast when a count shows that they are few (a hot host then
    costs nothing extra); beyond that it is a shuffle join where AQE splits skewed hosts.
    """
    hosts = host_rules(rules, user_agent)
    u = urls.select(F.col(key_col).alias("_key"), F.col(url_col).alias("_url")).withColumn("base", site_base(F.col("_url")))
    u = u.withColumn("_path", normal_path(url_path(F.col("_url"))))
    sized = hosts.withColumn("_bytes", F.to_json("decisions"))  # (strings are what the size check measures)
    small = broadcast_if_small(sized, max_broadcast_rules)
    j = u.join(small.drop("_bytes") if small is sized else F.broadcast(hosts), "base", "left")
    fits = F.filter("decisions", lambda d: (d["prefix"] == "*") | F.col("_path").startswith(d["prefix"]))
    by_rules = F.coalesce(F.get(fits, F.lit(0))["allow"], F.lit(True))
    st = F.col("status")
    allowed = (
        F.when(st.isNull(), F.lit(fallback))
        .when(st.isin(401, 403), F.lit(False))
        .when((st >= 400) & (st < 500), F.lit(True))
        .when(st >= 500, F.lit(False))
        .otherwise(by_rules)
    )
    reason = (
        F.when(st.isNull(), F.lit("robots_unreadable"))
        .when(st.isin(401, 403), F.lit("robots_forbidden"))
        .when((st >= 400) & (st < 500), F.lit("robots_missing"))
        .when(st >= 500, F.lit("robots_server_error"))
        .otherwise(F.lit("robots_rules"))
    )
    return j.select(F.col("_key").alias(key_col), F.col("_url").alias(url_col), allowed.alias("allowed"), reason.alias("reason"))


def resolve_attempts(attempts: DataFrame, url_col: str = "url", retries: int = FETCH_RETRIES) -> DataFrame:
    """Per URL the first attempt (up to ``retries + 1``) without error, else the last one.

    ``attempts``: ``(url, attempt, status_code, html, error)``. The HTTP status is
    not checked: a 404 page is a success. Output: ``url, attempt, status_code,
    html, error, ok``. One aggregation by URL, combined map-side (``min_by``
    keeps one candidate per URL and task before the shuffle).
    """
    a = attempts.where(F.col("attempt") <= retries + 1)
    # successes rank by attempt, failures after every success, the last failure first
    order = F.when(F.col("error").isNull(), F.col("attempt")).otherwise(F.lit(1_000_000) - F.col("attempt"))
    pick = F.min_by(F.struct("attempt", "status_code", "html", "error"), order)
    first = a.groupBy(url_col).agg(pick.alias("_a")).select(url_col, "_a.*")
    return first.select(url_col, "attempt", "status_code", "html", "error", F.col("error").isNull().alias("ok"))


def outcome_struct(admitted: Column, ok: Column, status_code: Column, excerpt_len: Column, lang: Column, error: Column) -> Column:
    """One struct for the three outcome shapes."""
    status = F.when(~admitted, F.lit("blocked_by_robots")).when(ok, F.lit("ok")).otherwise(F.lit("error"))
    return F.struct(
        status.alias("status"),
        F.when(admitted & ok, status_code).alias("status_code"),
        F.when(admitted & ok, excerpt_len).alias("len_text"),
        F.when(admitted & ok, lang).alias("lang"),
        F.when(admitted & ~ok, error).alias("error"),
    )


UPDATED = ["status_code", "title", "lang", "text_excerpt", "html_path"]


def reduced_batch(batch: DataFrame) -> DataFrame:
    """I4: one row per URL of a batch, written once: ``url, _first_seq`` and the last write's columns as ``_n_<column>``.
    One aggregation, combined map-side: a URL written many times (a hot key) is reduced before the shuffle."""
    last = F.max_by(F.struct(*[F.col(c).alias("_n_" + c) for c in UPDATED]), F.col("seq"))
    red = batch.where(F.col("url").isNotNull()).groupBy("url").agg(last.alias("_last"), F.min("seq").alias("_first_seq"))
    return written(red.select("url", "_first_seq", "_last.*"), "upsert-batch")


def new_ids(reduced: DataFrame, urls: DataFrame, max_id: int) -> DataFrame:
    """``url, _new_id`` of the URLs of a reduced batch that are not among ``urls``: ``max_id + 1, ...`` in first-seen order."""
    fresh = written(reduced.select("url", "_first_seq").join(urls.select("url"), "url", "left_anti"), "upsert-new")
    return dense_positions(fresh, "_first_seq", "_new_id", start=max_id + 1).select("url", "_new_id")


def new_meta() -> Column:
    """The ``raw_meta`` of a page stored by this pipeline."""
    from ..sources.pagestore import FETCHED_BY

    return F.create_map(*[x for k, v in FETCHED_BY.items() for x in (F.lit(k), F.lit(v))])


def upsert_pages(stored: DataFrame, batch: DataFrame, now: Column | None = None) -> DataFrame:
    """I4: upsert a batch ``(seq, url, status_code, title, lang, text_excerpt, html_path)``
    into the page table by URL.

    * NULL URLs are dropped (the original's insert fails and finds no row);
    * a URL repeated in the batch: the last write (highest ``seq``) gives the
      five columns, the first write gives the insert (id order, fetched_at);
    * a matched row keeps ``id, fetched_at, raw_meta`` and the enrichment
      columns, and takes the five columns as they are, NULLs included;
    * new rows get ``max(id) + 1, +2, ...`` in first-seen order,
      ``fetched_at = now`` and the ``raw_meta`` marker.

    The batch is reduced with one aggregation by URL (partial aggregation
    first) and written once. Matched rows are a left join of the stored table with it; new URLs an anti join
    the other way, numbered as narrow ``(url, first_seq)`` rows (bucket the stored table by
    ``url`` to avoid shuffling it on every run).
    """
    from ..sources.pagestore import COLUMNS

    now = now if now is not None else F.current_timestamp()
    red = reduced_batch(batch)
    s = stored.select(*COLUMNS)
    old_rows = s.join(red, "url", "left")
    max_id = s.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).collect()[0]["m"]  # one number
    new_rows = red.join(new_ids(red, s, int(max_id)), "url")
    meta = new_meta()

    def shape(df, new: bool):
        cols = []
        for c in COLUMNS:
            if c == "id":
                cols.append((F.col("_new_id") if new else F.col("id")).alias("id"))
            elif c == "url":
                cols.append(F.col("url"))
            elif c == "fetched_at":
                cols.append((now if new else F.col("fetched_at")).cast("timestamp").alias(c))
            elif c == "raw_meta":
                cols.append((meta if new else F.col("raw_meta")).alias(c))
            elif c in UPDATED:
                upd = F.col("_first_seq").isNotNull()
                cols.append((F.col("_n_" + c) if new else F.when(upd, F.col("_n_" + c)).otherwise(F.col(c))).alias(c))
            else:
                cols.append((F.lit(None).cast(s.schema[c].dataType) if new else F.col(c)).alias(c))
        cols.append(F.lit(new).alias("is_new"))
        return df.select(*cols)

    return shape(old_rows, False).unionByName(shape(new_rows, True))


def pending(pages: DataFrame, limit: int | None = None, skip_empty_first: bool = False) -> DataFrame:
    """pages whose summary is NULL or empty, in id order; ``limit`` per run;
    rows with empty text are then skipped (they stay pending: the original's
    behaviour; ``skip_empty_first`` filters them before the limit instead)."""
    p = pages.where(F.col("summary_text").isNull() | (F.col("summary_text") == ""))
    has_text = F.coalesce(F.col("text_excerpt"), F.lit("")) != ""
    if skip_empty_first:
        p = p.where(has_text)
    if limit is not None:
        p = p.orderBy("id").limit(limit)
    return p.where(has_text)


def lookup(pages: DataFrame, urls: DataFrame, url_col: str = "url") -> DataFrame:
    """F3 in bulk: each requested URL with its page row (NULLs when absent)."""
    return urls.join(pages, urls[url_col] == pages["url"], "left")
