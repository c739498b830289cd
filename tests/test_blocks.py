"""Block search with bounds: the same hits as scoring everything, with fewer blocks scored."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.operators import blocks as B
from pagelake.operators.search import cosine_topk

STORE, QUERIES = "id long, embedding array<double>, label int", "qid long, qvec array<double>"


def _hits(df, id_col="id"):
    return sorted((r["qid"], r["rank"], r[id_col], round(r["score"], 10)) for r in df.collect())


def _clustered(n=3000, dim=12, seed=4):
    rng = np.random.default_rng(seed)
    centres = rng.normal(size=(30, dim)) * 3
    return [(i, (centres[i % 30] + rng.normal(size=dim) * 0.2).tolist(), i % 3) for i in range(n)]


@pytest.mark.parametrize("k, at_once", [(1, 4096), (5, 4096), (40, 7)])
def test_equals_scoring_everything(spark, k, at_once):
    rows = _clustered()
    store = spark.createDataFrame(rows, STORE).repartition(4)
    queries = store.where("id % 150 = 0").select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    built = B.build(store, centres=40, block_rows=64)
    assert built.agg(F.sum("n")).first()[0] == len(rows) and built.agg(F.max("n")).first()[0] <= 64
    found = B.search(built, queries, k, queries_at_once=at_once)
    assert _hits(found.hits) == _hits(cosine_topk(store, queries, k, score_digits=12))
    assert found.pairs == 20 * built.count() and found.scored < found.pairs / 2


def test_many_equal_vectors_and_odd_ones(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(i, [1.0, 2.0, 0.5], 0) for i in range(700)] + [(1000 + i, [float(i), 1.0, -1.0], 1) for i in range(50)]
    rows += [(2000, None, 0), (2001, [], 0), (2002, [0.0, 0.0, 0.0], 0), (2003, [nan, 1.0, 1.0], 0), (2004, [inf, 0.0, 1.0], 0)]
    store = spark.createDataFrame(rows, STORE).repartition(3)
    queries = [(1, [1.0, 2.0, 0.5]), (2, [-1.0, -1.0, 0.0]), (3, None), (4, [0.0, 0.0, 0.0]), (5, [nan, 1.0, 1.0]), (6, [-5.0, -9.0, 0.0])]
    q = spark.createDataFrame(queries, QUERIES)
    built = B.build(store, centres=5, block_rows=32)
    got = _hits(B.search(built, q, 6).hits)
    assert got == _hits(cosine_topk(store.where("id < 2000"), q.where("qid in (1, 2, 6)"), 6, score_digits=12))
    assert [x[2] for x in got if x[0] == 1] == [0, 1, 2, 3, 4, 5] and not [x for x in got if x[0] in (3, 4, 5, 6)]


def test_empty_tables_and_lengths(spark):
    store = spark.createDataFrame(_clustered(20), STORE)
    q = spark.createDataFrame([(1, [1.0] * 12)], QUERIES)
    assert B.search(B.build(store.limit(0)), q).hits.collect() == []
    assert B.search(B.build(store), q.limit(0)).hits.collect() == []
    with pytest.raises(ValueError, match="length"):
        B.search(B.build(store), spark.createDataFrame([(1, [1.0])], QUERIES))
    with pytest.raises(ValueError, match="lengths"):
        B.build(store.unionByName(spark.createDataFrame([(99, [1.0], 0)], STORE)))


def test_only_what_reaches_the_threshold_is_sent(spark, monkeypatch):
    """Vectors without structure: no block is skipped, but few of their vectors leave a task; slabs do not matter."""
    rng = np.random.default_rng(9)
    store = spark.createDataFrame([(i, v.tolist(), 0) for i, v in enumerate(rng.normal(size=(2000, 16)))], STORE).repartition(3)
    queries = store.where("id % 40 = 0").select(F.col("id").alias("qid"), F.col("embedding").alias("qvec"))
    built = B.build(store, centres=4, block_rows=100)
    monkeypatch.setattr(B, "SLAB", 7)
    sent, with_column = [], type(store).withColumn

    def watched(df, name, column):
        if name == "rank" and "id" in df.columns:
            sent.append(df.count())
        return with_column(df, name, column)

    monkeypatch.setattr(type(store), "withColumn", watched)
    found = B.search(built, queries, 5)
    monkeypatch.undo()
    assert _hits(found.hits) == _hits(cosine_topk(store, queries, 5, score_digits=12))
    assert 50 * 5 <= sent[0] < found.scored * 5 / 2
