import numpy as np
import pytest
from pyspark.sql import functions as F

from pagelake.llm import annsearch

SCHEMA = "vec_id long, embedding array<float>, cell string, label int"


def exact(rows, query, k):
    out = {}
    for q, v in rows:
        if query(q):
            scored = [(-sum(float(np.float32(a)) * float(np.float32(b)) for a, b in zip(v, w, strict=True)), i) for i, w in rows if i != q]
            out[q] = [i for _, i in sorted(scored, key=lambda x: (round(x[0], 9), x[1]))[:k]]
    return out


@pytest.mark.parametrize("group_rows", [8192, 64])
def test_recall_and_order(spark, group_rows):
    rng = np.random.default_rng(5)
    centres = rng.normal(size=(12, 10))
    rows = [(i, (centres[i % 12] + rng.normal(size=10) * 0.4).round(3).tolist()) for i in range(1500)]
    rows += [(2000 + i, rows[0][1]) for i in range(500)]  # one vector, a quarter of all rows
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA).repartition(4)
    got = annsearch.search(df, F.col("vec_id") % 50 == 0, k=10, centroids=8, group_rows=group_rows).collect()
    by = {}
    for r in sorted(got, key=lambda r: (r.query_id, r.rank)):
        by.setdefault(r.query_id, []).append(r)
    want = exact(rows, lambda q: q % 50 == 0, 10)
    assert by.keys() == want.keys()
    assert np.mean([len({r.vec_id for r in by[q]} & set(want[q])) / 10 for q in want]) >= 0.9
    vectors = {i: np.array(v, dtype=np.float32).astype(float) for i, v in rows}
    for q, found in by.items():
        assert [r.rank for r in found] == list(range(1, 11))
        assert all(abs(r.score - vectors[q] @ vectors[r.vec_id]) < 1e-12 for r in found)
        assert [(-r.score, r.vec_id) for r in found] == sorted((-r.score, r.vec_id) for r in found)


def test_the_walk_gives_all_cells_in_order():
    rng = np.random.default_rng(1)
    index = annsearch.MultiIndex(rng.normal(size=(400, 7)), 6)
    q = rng.normal(size=7)
    cells = list(index.walk(q))
    cost = [-(index.books[0][c // index.shape[1]] @ q[:4] + index.books[1][c % index.shape[1]] @ q[4:]) for c in cells]
    assert sorted(cells) == list(range(index.shape[0] * index.shape[1])) and np.all(np.diff(cost) > -1e-12)


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(0, [1.0, 0.0]), (20, [0.0, 0.0]), (40, None), (60, [nan, 1.0]), (80, [inf, 1.0]), (100, [1.0, None]), (None, [1.0, 1.0])]
    rows += [(120, [1.0, 0.0, 0.0]), (3, [0.5, 0.5]), (4, [0.5, 0.5]), (4, [0.5, 0.5]), (140, [0.0, 1.0]), (140, [0.0, 1.0])]
    df = spark.createDataFrame([(i, v, "x", 1) for i, v in rows], SCHEMA)
    got = sorted((r.query_id, r.rank, r.vec_id, r.score) for r in annsearch.search(df, F.col("vec_id") % 20 == 0, k=20).collect())
    assert got == [
        (0, 1, 3, 0.5), (0, 2, 4, 0.5), (0, 3, 4, 0.5), (0, 4, 140, 0.0), (0, 5, 140, 0.0),
        (140, 1, 3, 0.5), (140, 2, 4, 0.5), (140, 3, 4, 0.5), (140, 4, 0, 0.0),
    ]
    assert annsearch.search(df.where("false"), F.col("vec_id") % 20 == 0).collect() == []


def test_queries_of_a_group_in_blocks_and_ids_of_other_types(spark):
    rng = np.random.default_rng(9)
    df = spark.createDataFrame([(i, rng.normal(size=6).tolist(), "x", 1) for i in range(900)], SCHEMA).repartition(3)
    whole, blocks = (
        sorted(map(tuple, annsearch.search(df, F.col("vec_id") % 2 == 0, k=5, centroids=6, query_rows=n).collect())) for n in (1 << 16, 70)
    )
    assert len(whole) == 450 * 5 and blocks == whole
    with pytest.raises(ValueError, match="integer"):
        annsearch.search(df.withColumn("vec_id", F.col("vec_id").cast("string")), F.lit(True))
