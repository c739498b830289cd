"""Chunking, keyword tokens, top-k keywords, lead summaries."""

import random
import time

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pagelake.functions import text as text_functions
from pagelake.functions.text import chunk_array, excerpt, extract_summary, keyword_tokens, lead_summary, py_strip, sentence_extract
from pagelake.operators import text as T


def _chunks(spark, text, max_chars, overlap):
    df = spark.createDataFrame([(1, text)], "id long, text string")
    rows = T.chunks(df, "id", "text", max_chars, overlap).orderBy("chunk_idx").collect()
    return [(r.start_idx, r.end_idx, r.chunk) for r in rows]


def _loop_chunks(text, max_chars, overlap):
    """Plain loop with the original's contract, for comparison."""
    if not text:
        return []
    overlap = max(0, overlap)
    out, start, n = [], 0, len(text)
    while start < n:
        end = min(start + max_chars, n)
        out.append((start, end, text[start:end]))
        if end == n:
            break
        start = end - overlap
    return out


def test_long_text_chunks_overlap(spark):
    # the reference's own case: 10,000 x 'a', 3000 / 100
    ch = _chunks(spark, "a" * 10000, 3000, 100)
    assert len(ch) >= 3
    assert ch[1][0] < ch[0][1]
    assert ch == _loop_chunks("a" * 10000, 3000, 100)


@pytest.mark.parametrize(
    "text,max_chars,overlap",
    [
        (None, 10, 2),
        ("", 10, 2),
        ("x" * 10, 10, 2),  # exactly max_chars
        ("x" * 11, 10, 2),  # one more
        ("abcdefghijklmnopqrstuvwxyz", 10, -5),  # negative overlap counts as 0
        ("😀a😀b😀c😀d😀e😀f", 4, 1),  # non-BMP characters count as one
        ("abc", 10, 9),  # overlap = max_chars - 1, one chunk
        ("abcdefghijklmnopq", 10, 9),
    ],
)
def test_chunk_edges(spark, text, max_chars, overlap):
    assert _chunks(spark, text, max_chars, overlap) == _loop_chunks(text, max_chars, overlap)


def test_overlap_not_below_max_chars_is_error(spark):
    # the original loops forever here; we raise
    with pytest.raises(Exception):
        _chunks(spark, "x" * 30, 10, 10)
    assert _chunks(spark, "x" * 10, 10, 10) == [(0, 10, "x" * 10)]


def test_max_chars_must_be_positive(spark):
    with pytest.raises(ValueError):
        chunk_array("text", 0, 0)


@settings(max_examples=25, deadline=None)
@given(
    n=st.integers(min_value=0, max_value=300),
    max_chars=st.integers(min_value=1, max_value=60),
    overlap_frac=st.floats(min_value=0, max_value=0.95),
)
def test_chunks_cover_and_overlap(spark, n, max_chars, overlap_frac):
    text = "".join(chr(97 + (i * 7) % 26) for i in range(n))
    overlap = min(max_chars - 1, int(max_chars * overlap_frac))
    ch = _chunks(spark, text, max_chars, overlap)
    assert ch == _loop_chunks(text, max_chars, overlap)
    if ch:
        assert ch[0][0] == 0 and ch[-1][1] == n
        for (s0, e0, _), (s1, _, _) in zip(ch, ch[1:]):
            assert e0 - s1 == overlap


def test_keyword_tokens_unicode_and_stop_words(spark):
    df = spark.createDataFrame([("The Café, and naïve-words: über_alles! 42 an x",)], "t string")
    toks = df.select(keyword_tokens("t").alias("k")).first().k
    assert toks == ["café", "naïve", "words", "über_alles"]


def test_top_keywords_ties_by_first_occurrence(spark):
    df = spark.createDataFrame([(1, "beta alpha gamma alpha beta delta"), (2, None), (3, "")], "id long, text string")
    rows = T.top_keywords(df, "id", "text", top_k=3).orderBy("id", "rank").collect()
    assert [(r.id, r.keyword, r.cnt) for r in rows] == [(1, "beta", 2), (1, "alpha", 2), (1, "gamma", 1)]
    arr = {r.id: r.keywords for r in T.keywords_array(df, "id", "text", 2).collect()}
    assert arr == {1: ["beta", "alpha"], 2: [], 3: []}


def test_lead_summary_and_strip(spark):
    long = "  " + "w" * 250
    df = spark.createDataFrame([(long,), ("　 short \n",)], "c string")
    got = [r.s for r in df.select(lead_summary("c").alias("s")).collect()]
    assert got == [("w" * 198) + "...", "short"]
    assert df.select(py_strip(F.lit(" x y\t")).alias("s")).first().s == "x y"


def test_summarize_record(spark):
    text = ("Spark engines process spark data. " * 200).strip()
    df = spark.createDataFrame([(1, text), (2, ""), (3, None)], "id long, text string")
    rows = {r.id: r for r in T.summarize(df, "id", "text", max_chars=4000, overlap=200, top_k=15).collect()}
    assert rows[1].num_chunks == 2
    assert all(rows[1].chunk_summaries)
    # final summary: that of all chunk summaries together
    assert rows[1].final_summary == extract_summary("\n\n".join(rows[1].chunk_summaries))
    # keywords come from the chunk summaries
    assert rows[1].keywords[:2] == ["spark", "engines"]
    for i in (2, 3):
        assert (rows[i].final_summary, rows[i].chunk_summaries, rows[i].keywords, rows[i].num_chunks) == ("", [], [], 0)


def test_summarize_model_slot_falls_back_per_batch(spark):
    df = spark.createDataFrame([(1, "alpha beta gamma " * 10), (2, "")], "id long, text string")

    def upper(s):
        return s.str.upper()

    rows = {r.id: r for r in T.summarize(df, "id", "text", summarizer=upper).collect()}
    assert rows[1].chunk_summaries == [("alpha beta gamma " * 10).upper().strip()]  # model output is stripped
    assert rows[1].final_summary == rows[1].chunk_summaries[0]
    assert rows[2].num_chunks == 0

    def broken(s):
        raise RuntimeError("model down")

    rows = {r.id: r for r in T.summarize(df, "id", "text", summarizer=broken).collect()}
    assert rows[1].chunk_summaries == [("alpha beta gamma " * 10).strip()]


def test_excerpt(spark):
    df = spark.createDataFrame([("abcdef",), (None,)], "t string")
    assert [r.e for r in df.select(excerpt("t", 3).alias("e")).collect()] == ["abc", ""]


def test_summarize_model_slot_falls_back_per_chunk(spark):
    df = spark.createDataFrame([(1, "fine text " * 5), (2, "bad text " * 5)], "id long, text string")

    def picky(s):
        if s.str.contains("bad").any():
            raise RuntimeError("model fails on this text")
        return s.str.upper()

    rows = {r.id: r for r in T.summarize(df, "id", "text", summarizer=picky).collect()}
    assert rows[1].chunk_summaries == [("fine text " * 5).upper().strip()]  # not dragged down by its batch
    assert rows[2].chunk_summaries == [("bad text " * 5).strip()]  # the lead fallback


def test_the_end_of_a_chunk_reaches_summary_and_keywords(spark):
    """Nothing is cut off: the sentences that say most, wherever they stand, make the summary."""
    text = " ".join(f"Filler{i} alone{i}." for i in range(60)) + " Zebra zebra grazing. Zebra zebra running. Zebra zebra sleeping."
    assert len(text) > 700
    df = spark.createDataFrame([(1, text * 8), (2, ""), (3, None), (4, "  \n "), (5, "...")], "id long, text string")
    got = {r.id: r for r in T.summarize(df, "id", "text", 4000, 200, 3).collect()}
    assert "Zebra zebra" in got[1].final_summary and got[1].keywords[0] == "zebra" and got[1].num_chunks > 1
    assert all(1 <= s.count(".") <= 3 for s in got[1].chunk_summaries)
    assert (got[2].final_summary, got[2].chunk_summaries, got[2].num_chunks) == (got[3].final_summary, [], 0) == ("", [], 0)
    assert (got[4].final_summary, got[5].final_summary) == ("", "...")


def test_summaries_as_expressions_equal_the_plain_ones(spark):
    rnd = random.Random(5)
    words = "the spark plan reads data Data und über größe 東京 a an it x1 y_2 été".split()
    ends = [". ", "! ", "?", "\n", "。", "... ", " ", ", "]
    texts = ["", None, "   ", "no end", "...", "One. Two. One two three four. The the the.", "東京 東京。京都 data data！"]
    texts += ["".join(rnd.choice(words) + rnd.choice([" ", " ", " ", *ends]) for _ in range(rnd.randint(1, 80))) for _ in range(150)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, t string")
    got = {r.i: r.s for r in df.select("i", sentence_extract("t").alias("s")).collect()}
    assert got == {i: extract_summary(t) for i, t in enumerate(texts)}


def test_summaries_run_without_python(spark):
    df = spark.createDataFrame([(1, "One two three. Four five.")], "id long, text string")
    for out in (T.summarize(df, "id", "text"), T.chunk_summaries(df, "id", "text")):
        plan = out._jdf.queryExecution().executedPlan().toString()
        assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_long_texts_in_linear_time(spark):
    text = "word and 😀 more. " * 300_000
    spaces = "a" + " " * 300_000 + "b" + "\t" * 300_000
    df = spark.createDataFrame([(text, spaces)], "t string, s string")
    r = df.select(F.size(chunk_array("t")).alias("n"), chunk_array("t")[900].alias("c"), py_strip("s").alias("p")).first()
    assert r.n == 1 + -(-(len(text) - 4000) // 3800) and r.c.chunk == text[900 * 3800 : 900 * 3800 + 4000]
    assert (r.c.start_idx, r.c.end_idx) == (900 * 3800, 900 * 3800 + 4000)
    assert r.p == spaces.strip()


def test_sentences_of_long_texts_cost_no_more_than_words(spark):
    """Counts and places of many sentences, and a sentence pattern that is as quick as the one of the words."""
    rnd = random.Random(3)
    words = ["spark", "plan", "data", "größe", "東京", "été", "table", "a", "an"]
    text = "".join(rnd.choice(words) + rnd.choice([" ", " ", " ", ". ", "！", "\n"]) for _ in range(60_000))
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(sentence_extract("t").alias("s")).first().s == extract_summary(text)
    many = spark.createDataFrame([(i, "Plain words of a text and more of them, " * 1500 + f"{i}.") for i in range(160)], "i int, t string")
    many = many.repartition(4).cache()
    many.count()

    def seconds(column):
        times = []
        for _ in range(3):
            start = time.perf_counter()
            many.select(F.sum(F.length(column))).first()
            times.append(time.perf_counter() - start)
        return min(times)

    plain = F.array_join(F.regexp_extract_all("t", F.lit("[^.]+"), F.lit(0)), "")
    sentences = F.array_join(F.regexp_extract_all("t", F.lit(text_functions.SENTENCE_JAVA), F.lit(0)), "")
    assert seconds(sentences) < 6 * seconds(plain)


def test_the_sentence_pattern_parts_every_character_as_the_plain_one(spark):
    every = "".join("abc" + chr(c) for c in range(1, 0x11000) if not 0xD800 <= c < 0xE000) + "b\U0001f600c\U0010ffff"
    df = spark.createDataFrame([(every,)], "t string")
    found = df.select(F.regexp_extract_all("t", F.lit(text_functions.SENTENCE_JAVA), F.lit(0)).alias("s")).first().s
    assert found == text_functions.SENTENCE.findall(every)
    parts = F.split(F.regexp_replace(F.lower("t"), f"[^{text_functions.WORD}{text_functions.WS}]", " "), f"[{text_functions.WS}]+")
    tokens = df.select(keyword_tokens("t").alias("k"), F.filter(parts, lambda w: F.length(w) > 2).alias("p")).first()
    assert len(tokens.k) > 100 and tokens.k == tokens.p
