"""Text column helpers (T1, T2, T4, T5, F4): Unicode-aware strip, keyword tokens, chunk arrays.

Regular expressions are written so that Java (Spark) and RE2 (DuckDB, the
oracle) read them alike: explicit code-point classes instead of ``\\s``/``\\w``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable

import regex
from pyspark.sql import Column
from pyspark.sql import functions as F

# The characters Python's str.isspace() accepts (strip()/split() semantics).
WS = r"\x{09}-\x{0D}\x{1C}-\x{20}\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}"
# Word characters: letters, numbers and underscore.
WORD = r"\p{L}\p{N}_"

# The keyword stop list (duplicates in the original list do no harm).
STOP_WORDS = (
    "the and for that with this from they have were their them "
    "what when where which there would could should about these "
    "those after before more over such also other some your you are was but not you all any"
).split()

KEYWORD_MIN_LEN = 3  # tokens longer than 2 characters are kept


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def py_strip(c) -> Column:
    """Strip Unicode whitespace from both ends (Python ``str.strip()``), in linear time however long the runs of it are."""
    return F.regexp_extract(_c(c), rf"(?s)^[{WS}]*+(.*[^{WS}])?", 1)


def keyword_tokens(c) -> Column:
    """Lower-case, non-word characters to spaces, split on whitespace,
    keep tokens longer than 2 characters that are not stop words: the maximal runs of so many word characters."""
    tokens = F.regexp_extract_all(F.lower(_c(c)), F.lit(f"[{WORD}]{{{KEYWORD_MIN_LEN},}}"), F.lit(0))
    # isin over a long literal list becomes a hash-set lookup (InSet), not a scan
    stop = sorted(set(STOP_WORDS))
    return F.filter(tokens, lambda t: ~t.isin(*stop))


def chunk_count(n: Column, max_chars: int, overlap: int) -> Column:
    """Number of chunks of a text of ``n`` characters (closed form of the chunk loop)."""
    step = max_chars - overlap
    if step <= 0:
        # the original loop never ends here once the text is longer than one chunk
        return (
            F.when(n.isNull() | (n == 0), F.lit(0))
            .when(n <= max_chars, F.lit(1))
            .otherwise(F.raise_error(F.lit("overlap must be smaller than max_chars")).cast("int"))
        )
    return (
        F.when(n.isNull() | (n == 0), F.lit(0))
        .when(n <= max_chars, F.lit(1))
        .otherwise(F.lit(1) + F.floor((n - F.lit(max_chars) + F.lit(step - 1)) / F.lit(step)).cast("int"))
    )


def chunk_array(text, max_chars: int = 4000, overlap: int = 200) -> Column:
    """``array<struct<chunk_idx, start_idx, end_idx, chunk>>`` of overlapping character chunks.

    NULL or empty text gives no chunks; ``max_chars <= 0`` is an error; a
    negative overlap counts as 0.
    """
    if max_chars <= 0:
        raise ValueError("max_chars must be > 0")
    overlap = max(0, overlap)
    step = max(1, max_chars - overlap)
    t = _c(text)
    n = F.length(t)
    # one pass: each match takes ``step`` characters and looks ahead at the whole chunk that begins there
    chunks = F.regexp_extract_all(t, F.lit(f"(?s)(?=(.{{1,{max_chars}}})).{{1,{step}}}"), F.lit(1))
    kept = F.slice(chunks, 1, F.coalesce(chunk_count(n, max_chars, overlap), F.lit(0)))
    return let(
        F.struct(F.coalesce(kept, F.array().cast("array<string>")).alias("c"), n.alias("n")),
        lambda v: F.transform(
            v["c"],
            lambda c, i: F.struct(
                i.alias("chunk_idx"),
                (i * step).alias("start_idx"),
                F.least(i * step + max_chars, v["n"]).alias("end_idx"),
                c.alias("chunk"),
            ),
        ),
    )


LEAD_CHARS = 200


def lead_summary(chunk) -> Column:
    """What stands in for a chunk's summary when a model fails on it: first 200 characters stripped plus
    ``...`` when the chunk is longer than 200 characters, else the stripped chunk."""
    c = _c(chunk)
    return F.when(F.length(c) > LEAD_CHARS, F.concat(py_strip(F.substring(c, 1, LEAD_CHARS)), F.lit("..."))).otherwise(
        py_strip(c)
    )


SUMMARY_SENTENCES = 3
SENTENCE_RE = "[^.!?。！？\\n]+[.!?。！？]*"
SENTENCE = re.compile(SENTENCE_RE)
# the same for Java, whose negated classes are slow once they name characters beyond Latin-1: the ranges between the enders
SENTENCE_JAVA = (
    r"[\x{40}-\x{3001}\x{B}-\x{20}\x{22}-\x{2D}\x{2F}-\x{3E}\x{0}-\x{9}\x{3003}-\x{FF00}\x{FF02}-\x{FF1E}\x{FF20}-\x{10FFFF}]+"
    r"[.!?\x{3002}\x{FF01}\x{FF1F}]*"
)
TOKEN = regex.compile(r"[\p{L}\p{N}_]+")
_STOP = frozenset(STOP_WORDS)


def extract_summary(text: str | None, sentences: int = SUMMARY_SENTENCES) -> str:
    """The sentences of the whole text whose keyword tokens are the most frequent in it, in text order.

    A sentence scores the mean frequency of its keyword tokens (none: 0); ties go to the earlier one. A text
    without a sentence is its own summary, stripped.
    """
    text = text or ""
    found = [s for s in map(str.strip, SENTENCE.findall(text)) if s]
    tokens = [[t for t in TOKEN.findall(s.lower()) if len(t) >= KEYWORD_MIN_LEN and t not in _STOP] for s in found]
    n = Counter(t for ts in tokens for t in ts)
    score = [sum(n[t] for t in ts) / len(ts) if ts else 0.0 for ts in tokens]
    best = sorted(sorted(range(len(found)), key=lambda i: (-score[i], i))[:sentences])
    return " ".join(found[i] for i in best) if best else text.strip()


def _run_ends(sorted_: Column, same: Callable[[Column, Column], Column]) -> Column:
    """The positions (from 1) at which runs of equal elements of a sorted array end."""
    n = F.size(sorted_)
    places = F.slice(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), 1, n)
    return F.filter(places, lambda i: ~same(F.get(sorted_, i - 1), F.get(sorted_, i)))


def _lengths(ends: Column) -> Column:
    """The lengths of the runs that end at the positions ``ends``."""
    return F.zip_with(ends, F.slice(F.concat(F.array(F.lit(0)), ends), 1, F.size(ends)), lambda to, after: to - after)


def sentence_extract(text, sentences: int = SUMMARY_SENTENCES) -> Column:
    """``extract_summary`` as a column expression: sorted arrays and their runs, no Python."""

    def of(found: Column) -> Column:
        tokens = F.flatten(F.transform(found, lambda s, i: F.transform(keyword_tokens(s), lambda t: F.struct(t.alias("t"), i.alias("i")))))

        def counted(sorted_: Column) -> Column:
            # every token's sentence with the token's count, as one number, which sorts faster than a struct
            runs = let(_run_ends(sorted_, lambda a, b: a["t"].eqNullSafe(b["t"])), _lengths)
            counts = F.flatten(F.transform(runs, lambda n: F.array_repeat(n, n)))
            return F.zip_with(sorted_, counts, lambda x, n: F.shiftleft(x["i"].cast("long"), 32) + n)

        def scored(pairs: Column) -> Column:
            ends = _run_ends(pairs, lambda a, b: F.shiftright(a, 32).eqNullSafe(F.shiftright(b, 32)))

            def mean(to: Column, n: Column) -> Column:
                total = F.aggregate(F.slice(pairs, to - n + 1, n), F.lit(0).cast("long"), lambda acc, x: acc + x.bitwiseAND(F.lit(0xFFFFFFFF)))
                return F.struct((-(total / n)).alias("score"), F.shiftright(F.get(pairs, to - 1), 32).cast("int").alias("i"))

            return let(ends, lambda e: F.sort_array(F.zip_with(e, _lengths(e), mean)))

        def chosen(at: Column) -> Column:
            # sentences without a keyword token come last, the first ones first
            rest = F.array_except(F.slice(F.sequence(F.lit(0), F.size(found)), 1, F.size(found)), at)
            best = F.sort_array(F.slice(F.concat(at, F.sort_array(rest)), 1, sentences))
            return F.array_join(F.transform(best, lambda i: F.get(found, i)), " ")

        pairs = let(F.sort_array(tokens), lambda s: F.sort_array(counted(s)))
        return let(F.transform(let(pairs, scored), lambda x: x["i"]), chosen)

    t = F.coalesce(_c(text), F.lit(""))
    found = F.filter(F.transform(F.regexp_extract_all(t, F.lit(SENTENCE_JAVA), F.lit(0)), lambda s: py_strip(s)), lambda s: s != "")
    return let(found, lambda f: F.when(F.size(f) > 0, of(f)).otherwise(py_strip(t)))


def chunk_extracts(chunks) -> Column:
    """T4 default backend: the extractive summary of every chunk of a row."""
    return F.transform(_c(chunks), lambda c: sentence_extract(c))


def text_extract(text) -> Column:
    """T5 default backend: the extractive summary of all chunk summaries together."""
    return sentence_extract(text)


def joined_summaries(summaries) -> Column:
    """The text the keywords come from: chunk summaries joined by a blank line."""
    return F.array_join(_c(summaries), "\n\n")


def excerpt(text, n: int) -> Column:
    """first ``n`` characters, ``''`` when there is no text."""
    return F.coalesce(F.substring(_c(text), 1, n), F.lit(""))
