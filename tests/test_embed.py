"""Lexical encoder (V1, V2) against a plain Python TF-IDF."""

import hashlib
import math
import re

import pytest
from pyspark.sql import functions as F

from pagelake.functions.vectors import is_valid_vector
from pagelake.operators import embed as V


def _py_tokens(t):
    return [x for x in re.split(r"[^\w]+|_(?!)", (t or "").lower()) if x] if False else [
        x for x in re.split(r"[^0-9a-zà-ÿ_]+", (t or "").lower()) if x
    ]


def _bucket(tok, dim):
    return int(hashlib.md5(tok.encode()).hexdigest()[:8], 16) % dim


TEXTS = [
    (1, "Spark plans the query; Spark runs it."),
    (2, "The optimizer pushes filters down to the scan."),
    (3, ""),
    (4, None),
    (5, "spark spark spark"),
    (6, "Café à la carte, café noir"),
]


def test_encoder_matches_python(spark):
    dim = 16
    df = spark.createDataFrame(TEXTS, "id long, text string")
    enc = V.fit_encoder(df, "text", dim)
    n = len(TEXTS)
    dfreq = [0] * dim
    for _, t in TEXTS:
        for b in {_bucket(x, dim) for x in _py_tokens(t)}:
            dfreq[b] += 1
    idf = [math.log((n + 1) / (d + 1)) for d in dfreq]
    assert enc.idf == pytest.approx(idf)
    got = {r.id: r.embedding for r in enc.embed(df, "text").collect()}
    for i, t in TEXTS:
        v = [0.0] * dim
        for x in _py_tokens(t):
            v[_bucket(x, dim)] += 1
        v = [c * w for c, w in zip(v, idf)]
        norm = math.sqrt(sum(x * x for x in v))
        want = [x / norm for x in v] if norm > 0 else [0.0] * dim
        assert got[i] == pytest.approx(want)


def test_embedding_survives_a_filter_on_it(spark):
    # a filter on the vector must not blow the plan up (no outer columns inside lambdas)
    df = spark.createDataFrame(TEXTS, "id long, text string")
    enc = V.TextEncoder(idf=[1.0] * 8, n_docs=6)
    e = enc.embed(df, "text").where(is_valid_vector("embedding") & (F.col("embedding")[0] >= 0))
    plan = e._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") <= 4
    assert e.count() == 6


def test_search_pages_by_text(spark, tmp_path):
    from pagelake.operators.search import search_pages

    rows = [(1, "u1", "t1", "s1", "red apple pie"), (2, "u2", "t2", None, "green apple tart"), (3, "u3", "t3", "s3", None)]
    df = spark.createDataFrame(rows, "id long, url string, title string, summary_text string, text string")
    enc = V.fit_encoder(df, "text", 64)
    enc.save(spark, str(tmp_path / "enc"))
    assert V.TextEncoder.load(spark, str(tmp_path / "enc")) == enc
    pages = enc.embed(df, "text").withColumn("embedding", F.when(F.col("id") != 3, F.col("embedding"))).drop("text")
    got = search_pages(pages, "red pie", enc, 2).collect()
    assert got[0].asDict().keys() == {"url", "title", "score", "summary"} and got[0]["url"] == "u1" and got[0]["score"] > 0
    assert search_pages(pages, "  ", enc).collect() == search_pages(pages, None, enc).collect() == []
    path = str(tmp_path / "pages")
    pages.write.parquet(path)
    plan = spark.read.parquet(path).where(F.col("embedding").isNotNull())._jdf.queryExecution().toString()
    assert "IsNotNull(embedding)" in plan


def test_batches_give_the_same_vectors(spark):
    texts = [None, "", " ., ", "One two two, THREE", "é_1 日本 é_1", "x " * 3000] + [f"w{i} w{i % 7} q" for i in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "id long, text string").repartition(3)
    enc = V.fit_encoder(df, "text", 16)
    plain, batches = ({r.id: r.embedding for r in f(df, "text").collect()} for f in (enc.embed, enc.embed_batches))
    assert plain == batches and len(plain) == len(texts) and not any(plain[0])
