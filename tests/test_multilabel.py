"""One-pass multi-label training against Spark ML's own logistic regression."""

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pagelake.operators import multilabel as M


def _table(spark, labels, n=400, dim=12, parts=3):
    rng = np.random.default_rng(labels)
    x = rng.normal(size=(n, dim)) * (rng.random((n, dim)) < 0.4) * np.linspace(0.2, 5, dim)
    w = rng.normal(size=(dim, labels))
    y = (x @ w + rng.normal(size=(n, labels)) > 0.5).astype(float)
    rows = []
    for i, (a, b) in enumerate(zip(x, y, strict=True)):
        at = np.flatnonzero(a)
        v = Vectors.dense(a) if i % 5 == 0 else Vectors.sparse(dim, at, a[at])
        rows.append((v, b.tolist()))
    df = spark.createDataFrame(rows, ["features", "y"]).repartition(parts)
    return df.select("features", F.transform("y", lambda v: v.cast("float")).alias("y")), dim


def _of_spark(table, label, reg):
    lr = LogisticRegression(labelCol="t", regParam=reg, maxIter=200, tol=1e-9)
    m = lr.fit(table.withColumn("t", F.col("y")[label].cast("double")))
    return np.append(m.coefficients.toArray(), m.intercept)


@pytest.mark.parametrize("reg", [0.01, 0.3])
def test_equals_spark_ml(spark, reg, monkeypatch):
    monkeypatch.setattr(M, "TOLERANCE", 1e-12)
    table, dim = _table(spark, 3)
    got, _ = M.train(M.Problem.of(table, dim, 3), [(i, reg, 200) for i in range(3)])
    for i, (w, b) in enumerate(got):
        assert np.append(w, b) == pytest.approx(_of_spark(table, i, reg), abs=2e-3)


def test_passes_do_not_grow_with_the_labels(spark):
    table, dim = _table(spark, 8)
    p = M.Problem.of(table, dim, 8)
    alone = max(M.train(p, [(i, 0.05, 20)])[1] for i in range(8))
    together, passes = M.train(p, [(i, 0.05, 20) for i in range(8)])
    assert passes == alone
    assert [w.tolist() for w, _ in M.train(p, [(3, 0.05, 20)])[0]][0] == pytest.approx(together[3][0].tolist(), abs=1e-6)


def test_sums_in_two_levels_and_small_blocks(spark, monkeypatch):
    table, dim = _table(spark, 2, parts=9)
    whole = M.train(M.Problem.of(table, dim, 2), [(0, 0.1, 10), (1, 0.1, 10)])[0]
    monkeypatch.setattr(M, "DIRECT", 4)
    levels = M.train(M.Problem.of(table, dim, 2), [(0, 0.1, 10), (1, 0.1, 10)])[0]
    for (a, b), (c, d) in zip(whole, levels, strict=True):
        assert np.append(a, b) == pytest.approx(np.append(c, d), abs=1e-9)


def test_blocks_hold_every_value_once(monkeypatch):
    monkeypatch.setattr(M, "CELLS", 7)
    rows = [{"type": 0, "size": 9, "indices": [i % 9], "values": [float(i)]} for i in range(1, 6)] + [{"type": 0, "size": 9, "indices": [], "values": []}]
    kind = pa.struct([("type", pa.int8()), ("size", pa.int32()), ("indices", pa.list_(pa.int32())), ("values", pa.list_(pa.float64()))])
    rows.append({"type": 1, "size": None, "indices": None, "values": [0.5] * 9})
    x = np.zeros((7, 9))
    for some, part, columns in M.blocks(pa.array(rows, kind)):
        x[some, columns] = part
    want = np.zeros((7, 9))
    for i in range(1, 6):
        want[i - 1, i] = i
    want[6] = 0.5
    assert (x == want).all()


def test_scores_are_the_logistic_function(spark):
    table, dim = _table(spark, 2)
    rng = np.random.default_rng(0)
    w, b = rng.normal(size=(2, dim)), np.array([0.3, -2.0])
    rows = table.select(vector_to_array("features").alias("x"), M.scorer(w, b)("features").alias("p")).collect()
    for r in rows:
        assert r.p == pytest.approx((1 / (1 + np.exp(-(w @ np.array(r.x) + b)))).tolist())


def test_packed_blocks_hold_every_value_and_target_once(spark, monkeypatch):
    monkeypatch.setattr(M, "PACKED", 5)
    table, dim = _table(spark, 2, n=60, parts=2)
    table = table.unionByName(spark.createDataFrame([(Vectors.sparse(dim, [], []), [1.0, 0.0])], table.schema))
    want = sorted((list(x), list(y)) for x, y in table.select(vector_to_array("features"), "y").collect())
    batches = M.packed(table).select("n", "i", "v", "y").toArrow().to_batches()
    got = []
    for row, index, value, y in M._unpacked(batches, 2):
        x = np.zeros((len(y), dim))
        x[row, index] = value
        got += zip(x.tolist(), y.tolist(), strict=True)
    assert len(got) == 61 and sorted(map(list, got)) == sorted(map(list, want))


def test_what_a_task_holds_does_not_grow_with_its_share(spark):
    """Blocks, row groups and Arrow batches are a few MB, however many values (here 36 MB) a task goes through."""
    values = F.transform(F.sequence(F.lit(1), F.lit(1000)), lambda i: F.rand(3) * i)
    table = spark.range(0, 3000, 1, 1).select(array_to_vector(values).alias("features"), F.array(F.lit(1.0)).cast("array<float>").alias("y"))
    packed = M.packed(table)
    files = [f.removeprefix("file:") for f in packed.inputFiles()]
    groups = [m.row_group(i).total_byte_size for m in map(pq.read_metadata, files) for i in range(m.num_row_groups)]
    assert sum(groups) > 24 << 20 and max(groups) < 12 << 20
    assert packed.select(F.max(F.length("v"))).first()[0] <= 1 << 20

    def largest(batches):
        sizes = [b.nbytes for b in batches]
        return np.array([max(sizes), sum(sizes)], dtype=float)

    most, total = M._summed(packed.coalesce(1), largest)
    assert total > 36e6 and most < 12 << 20
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    assert spark.conf.get(key) == spark.newSession().conf.get(key)
