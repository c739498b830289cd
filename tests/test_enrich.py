"""Enrichment write-back (T7) and the encoder model slot (V1)."""

import datetime as dt

from pyspark.sql import functions as F

from pagelake.operators import embed as V
from pagelake.operators.enrich import enrich
from pagelake.sources import pagestore


def _pages(spark):
    ts = dt.datetime(2024, 1, 1)
    long = "Spark engines plan queries. " * 300
    rows = [
        (1, "https://a/", ts, 200, "A", "en", long, "raw/a.html", None, None, None, None),
        (2, "https://b/", ts, 200, "B", "en", "short text about spark", "raw/b.html", None, "", None, None),
        (3, "https://c/", ts, 200, "C", "en", "already done", "raw/c.html", None, "done", ["x"], [1.0]),
        (4, "https://d/", ts, 200, "D", "en", "", "raw/d.html", None, None, None, None),  # empty: stays pending
    ]
    return spark.createDataFrame(rows, pagestore.PAGES_SCHEMA)


def test_enrich_writes_back_pending_rows_only(spark):
    out = {r.id: r for r in enrich(_pages(spark)).collect()}
    assert [i for i in sorted(out) if out[i].updated] == [1, 2]
    a = out[1]
    assert a.summary_text and len(a.summary_keywords) <= 15
    assert a.summary_keywords[:4] == ["spark", "engines", "plan", "queries"]
    assert len(a.embedding) == V.DIM and abs(sum(x * x for x in a.embedding) - 1.0) < 1e-9
    assert out[2].summary_text == "short text about spark"
    assert (out[3].summary_text, out[3].summary_keywords, out[3].embedding) == ("done", ["x"], [1.0])
    assert out[4].summary_text is None and not out[4].updated
    # the other columns are untouched
    assert {r.url for r in out.values()} == {"https://a/", "https://b/", "https://c/", "https://d/"}


def test_enrich_limit_counts_empty_pages(spark):
    pages = _pages(spark).withColumn("id", F.when(F.col("id") == 4, F.lit(0)).otherwise(F.col("id")))
    out = {r.id: r.updated for r in enrich(pages, limit=2).collect()}
    # the empty page (now id 0) uses up one place of the batch, as in the original
    assert out == {0: False, 1: True, 2: False, 3: False}


def test_encoder_model_slot(spark):
    df = spark.createDataFrame([(1, "ab"), (2, None)], "id long, text string")

    def encode(texts):
        return [[float(len(t)), 1.0] for t in texts]

    got = {r.id: r.embedding for r in V.embed_with_model(df, "text", encode).collect()}
    assert got == {1: [2.0, 1.0], 2: [0.0, 1.0]}


def test_encoder_model_slot_isolates_failing_texts(spark):
    df = spark.createDataFrame([(1, "ok"), (2, "boom")], "id long, text string")

    def encode(texts):
        if "boom" in texts:
            raise RuntimeError("model fails on this text")
        return [[1.0] for _ in texts]

    got = {r.id: r.embedding for r in V.embed_with_model(df, "text", encode).collect()}
    assert got == {1: [1.0], 2: None}


def test_a_kept_encoder_is_read_by_later_runs(spark, tmp_path):
    path = str(tmp_path / "encoder")
    first = {r.id: r for r in enrich(_pages(spark), encoder_path=path).collect()}
    fitted = V.TextEncoder.load(spark, path)
    assert fitted.n_docs == 4
    later = _pages(spark).where("id <> 3").withColumn("text_excerpt", F.when(F.col("id") == 2, "other words").otherwise(F.col("text_excerpt")))
    again = {r.id: r for r in enrich(later, encoder_path=path).collect()}
    assert again[1].embedding == first[1].embedding and again[2].embedding != first[2].embedding
    assert V.TextEncoder.load(spark, path) == fitted
