"""The ingest driver (I5): URLs through admission, attempts, extraction,
language, excerpt, raw store and upsert - one DataFrame plan, not a loop.

Shuffles: the robots rules join on the site (broadcast when the rules are
proven small), the attempt resolution by URL, the language scoring (grams
against the profile, then summed per page) and the upsert join on URL.
Extraction, digests and excerpts are per-row expressions on the resolved
pages.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import cached_property

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import extract as X
from . import ingest as I
from . import langid
from ..session import written
from ..sources import rawstore


@dataclass
class IngestResult:
    upsert: Callable[[], DataFrame]
    outcomes: DataFrame  # one row per URL: ``seq, url, outcome`` (I3)
    raw: DataFrame  # the raw pages of this run (S2), without their html: ``digest, html_path, n_bytes, n_pages``
    n_stored: int | None = None  # how many of them the raw store did not have yet

    @cached_property
    def pages(self) -> DataFrame:
        """The page table after the upsert (I4), with ``is_new``; run when it is asked for."""
        return self.upsert()


def ingest(
    urls: DataFrame,
    rules: DataFrame,
    attempts: DataFrame,
    stored: DataFrame,
    profile: langid.LangProfile,
    raw_dir: str = "raw",
    max_text: int | None = None,
    retries: int = I.FETCH_RETRIES,
    now: Column | None = None,
    raw_path: str | None = None,
) -> IngestResult:
    """``urls``: ``(seq, url)``; ``rules``: parsed robots rules; ``attempts``:
    ``(url, attempt, status_code, html, error)``; ``stored``: the page table. ``max_text`` cuts the
    text (F4) for a caller who asks for it, for example ``ingest.MAX_TEXT_SIZE``. With ``raw_path`` the pages are
    stored there as they came (see ``sources.rawstore``)."""
    adm = written(I.robots_admission(urls, rules, "url", "seq"), "admission")
    # attempts are resolved without their html; it is fetched once, for the successes that are admitted
    res = I.resolve_attempts(attempts.withColumn("html", F.lit(None).cast("string")), "url", retries)
    j = written(adm.join(res.drop("html"), "url", "left"), "resolved")
    fetched_ok = F.col("allowed") & F.coalesce(F.col("ok"), F.lit(False))
    won = j.where(fetched_ok).select("seq", "url", "attempt", "status_code")
    bodies = attempts.where(F.col("error").isNull() & (F.col("attempt") <= retries + 1)).select("url", "attempt", "html")
    ok = won.join(bodies, ["url", "attempt"]).select("seq", "url", "status_code", "html")
    # the extracted pages feed both the language scoring and the page rows:
    # written once to the shared folder instead of being extracted twice
    digest = F.concat(F.lit(raw_dir.rstrip("/") + "/"), X.raw_digest("html"), F.lit(".html"))
    ex = X.extract_pages(ok, "html", key="seq").withColumn("html_path", digest).drop("html")
    ex = written(ex, "extracted")
    lang = langid.detect(ex.select("seq", "text"), profile, "seq", "text")
    pages_rows = ex.join(lang, "seq", "left").select(
        "seq",
        "url",
        "status_code",
        "title",
        "lang",
        F.coalesce(F.col("text") if max_text is None else F.substring("text", 1, max_text), F.lit("")).alias("text_excerpt"),
        "html_path",
    )
    pages_rows = written(pages_rows, "page-rows")
    outcome = I.outcome_struct(
        F.col("allowed"),
        F.coalesce(F.col("ok"), F.lit(False)),
        F.col("status_code"),
        F.col("len_text"),
        F.col("lang"),
        F.coalesce(F.col("error"), F.lit(I.NO_ATTEMPT)),
    )
    outcomes = j.select("seq", "url", "allowed", "ok", "error").join(
        # (an attempt that is logged twice gives two equal rows: one is enough)
        pages_rows.select("seq", "status_code", F.length("text_excerpt").alias("len_text"), "lang").dropDuplicates(["seq"]), "seq", "left"
    ).select("seq", "url", outcome.alias("outcome"))
    stored_now = rawstore.insert_pages(ok, raw_path) if raw_path else None
    return IngestResult(lambda: I.upsert_pages(stored, pages_rows, now), outcomes, X.raw_digests(ok, "html", raw_dir), stored_now)
