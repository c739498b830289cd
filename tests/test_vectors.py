"""Vector validity, cosine, exact top-k search (V3-V6)."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.functions.vectors import cosine, is_valid_vector
from pagelake.operators.search import cosine_topk, search_vector


def _cos(spark, a, b):
    df = spark.createDataFrame([(a, b)], "a array<double>, b array<double>")
    return df.select(cosine("a", "b").alias("c")).first().c


def test_identical_vectors(spark):
    v = [1 / math.sqrt(3)] * 3
    assert abs(_cos(spark, v, v) - 1.0) < 1e-6


def test_orthogonal_vectors(spark):
    assert abs(_cos(spark, [1.0, 0.0], [0.0, 1.0]) - 0.0) < 1e-6


def test_vector_validity(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0],), ([],), (None,)], "v array<double>")
    assert [r.ok for r in df.select(is_valid_vector("v").alias("ok")).collect()] == [True, False, False]


def test_cosine_sentinels(spark):
    assert _cos(spark, [0.0, 0.0], [1.0, 1.0]) == -1.0
    assert _cos(spark, None, [1.0]) == -1.0
    assert _cos(spark, [], [1.0]) == -1.0
    # a zero vector scores -1 before the length matters
    assert _cos(spark, [0.0], [1.0, 1.0]) == -1.0
    with pytest.raises(Exception):
        _cos(spark, [1.0], [1.0, 1.0])


def _store(spark):
    rows = [
        (1, [1.0, 0.0]),
        (2, [0.0, 1.0]),  # exactly orthogonal to the query: score 0, dropped
        (3, [1.0, 1.0]),
        (4, [0.0, 0.0]),  # zero vector: -1, dropped
        (5, None),
        (6, []),
        (7, [float("nan"), 1.0]),  # NaN score, dropped
        (8, [2.0, 0.0]),  # ties with 1, broken by id
        (9, [-1.0, 0.1]),
    ]
    return spark.createDataFrame(rows, "id long, embedding array<double>")


def test_search_drops_zero_nan_and_ties_by_id(spark):
    q = spark.createDataFrame([([1.0, 0.0],)], "qvec array<double>")
    hits = search_vector(_store(spark), q, k=5).orderBy("rank").collect()
    assert [(h.id, h.rank) for h in hits] == [(1, 1), (8, 2), (3, 3)]
    assert abs(hits[2].score - 1 / math.sqrt(2)) < 1e-12


def test_search_ragged_strict_and_lenient(spark):
    store = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0, 0.0, 0.0])], "id long, embedding array<double>")
    q = spark.createDataFrame([([1.0, 0.0],)], "qvec array<double>")
    with pytest.raises(Exception):
        search_vector(store, q, k=5).collect()
    assert [h.id for h in search_vector(store, q, k=5, strict=False).collect()] == [1]


@pytest.mark.parametrize("broadcast", [True, False])
def test_batch_search_matches_brute_force(spark, broadcast):
    rng = np.random.default_rng(7)
    n, d, k = 300, 8, 4
    mat = rng.normal(size=(n, d))
    store = spark.createDataFrame([(i, mat[i].tolist()) for i in range(n)], "id long, embedding array<double>")
    queries = store.select(F.col("id").alias("qid"), F.col("embedding").alias("qvec")).where("id < 40")
    kw = {} if broadcast else {"max_broadcast_queries": 0, "block_rows": 64, "block_queries": 16}
    got = cosine_topk(store, queries, k=k, **kw).collect()
    res = {}
    for r in got:
        res.setdefault(r.qid, []).append((r.rank, r.id, r.score))
    unit = mat / np.linalg.norm(mat, axis=1, keepdims=True)
    for qi in range(40):
        s = unit @ unit[qi]
        order = sorted((i for i in range(n) if s[i] > 0), key=lambda i: (-s[i], i))[:k]
        mine = sorted(res.get(qi, []))
        assert [m[1] for m in mine] == order
        assert np.allclose([m[2] for m in mine], [s[i] for i in order])


def test_search_empty_queries(spark):
    store = _store(spark)
    q = spark.createDataFrame([(None,)], "qvec array<double>")
    assert search_vector(store, q, k=5).count() == 0


@pytest.mark.parametrize("broadcast", [True, False])
def test_ties_among_duplicates_go_to_smallest_ids(spark, broadcast):
    # a third of the store is one identical vector: the best score ties many times over
    rows = [(i, [1.0, 2.0, 3.0] if i % 3 == 0 else [1.0, -1.0, float(i % 5)]) for i in range(600, 0, -1)]
    store = spark.createDataFrame(rows, "id long, embedding array<double>").repartition(7)
    q = spark.createDataFrame([(1, [1.0, 2.0, 3.0]), (2, [2.0, 4.0, 6.0])], "qid long, qvec array<double>")
    kw = {} if broadcast else {"max_broadcast_queries": 0, "block_rows": 50, "block_queries": 1}
    got = cosine_topk(store, q, k=4, score_digits=12, **kw).orderBy("qid", "rank").collect()
    assert [(r.qid, r.id) for r in got] == [(1, 3), (1, 6), (1, 9), (1, 12), (2, 3), (2, 6), (2, 9), (2, 12)]
