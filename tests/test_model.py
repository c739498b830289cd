"""Featurising, per-label training, scoring (L5, L6, L8, L9) on a learnable toy set."""

import numpy as np
import pyarrow as pa
import pytest
from pyspark.ml.linalg import Vectors
from pyspark.sql import functions as F

from pagelake.operators import active as A
from pagelake.operators import model as M
from pagelake.operators.metrics import flattened_f1


def _toy(spark):
    rows = []
    for i in range(80):
        sport = i % 2 == 0
        money = i % 4 < 2
        words = (["match goal team score"] if sport else ["garden flower tree"]) + (["bank price market"] if money else ["river cloud"])
        rows.append((i, " ".join(words) + f" filler{i % 7}", [int(sport), int(money)]))
    return spark.createDataFrame(rows, "id long, text string, vec array<int>")


def test_features_truncate_to_max_tokens(spark):
    df = spark.createDataFrame([(1, " ".join(f"w{i}" for i in range(300))), (2, "")], "id long, text string")
    f = M.feature_pipeline("text", max_tokens=256).fit(df).transform(df)
    assert {r.id: r.n for r in f.select("id", F.size("_tokens").alias("n")).collect()} == {1: 256, 2: 0}


def test_train_and_predict(spark):
    df = _toy(spark)
    model = M.train(df, ["sport", "money"], reg_param=0.01, max_iter=50)
    p = model.predict_proba(df).withColumn("pred", A.predict_from_probs("probs", model.labels, 0.5))
    got = {r.id: r.pred.labels for r in p.collect()}
    assert got[0] == ["sport", "money"] and got[1] == ["money"] and got[2] == ["sport"] and got[3] == []
    cells = p.select(F.col("vec")[0].alias("y0"), F.col("vec")[1].alias("y1"), "p_sport", "p_money")
    assert flattened_f1(cells, ["y0", "y1"], ["p_sport", "p_money"]).first().f1_micro == 1.0


def test_single_class_label_gives_constant_probability(spark):
    df = _toy(spark).withColumn("vec", F.array(F.col("vec")[0], F.lit(0)))
    model = M.train(df, ["sport", "never"], max_iter=10)
    ps = {r.p_never for r in model.predict_proba(df).collect()}
    assert ps == {0.0}


def test_save_and_load_with_any_label_name_and_a_constant_label(spark, tmp_path):
    rows = [(i, "good words here" if i % 2 else "bad things there", [i % 2, 1]) for i in range(20)]
    df = spark.createDataFrame(rows, "id long, text string, vec array<int>")
    model, table = M.select_model(M.prepare(df, ["sci.space", "always"]), df, [(0.1, 5), (0.01, 5)])
    assert [r["chosen"] for r in table].count(True) == 1 and model.labels == ["sci.space", "always"]
    model.save(str(tmp_path / "m"))
    back = M.load_model(spark, str(tmp_path / "m"))
    assert back.labels == model.labels
    a, b = (m.predict_proba(df).orderBy("id").collect() for m in (model, back))
    assert [r["probs"] for r in a] == [r["probs"] for r in b] and all(r["p_always"] == 1.0 for r in a)
    assert all((r["p_sci.space"] > 0.5) == (r["id"] % 2 == 1) for r in a)


def test_the_whole_text_counts(spark):
    df = spark.createDataFrame([(1, "word " * 400 + "last")], "id long, text string")
    n = lambda k: M.feature_pipeline(max_tokens=k).fit(df).transform(df).selectExpr("size(_tokens)").first()[0]
    assert (n(None), n(256)) == (401, 256)


def test_scoring_goes_through_held_values_only(spark):
    """Sparse, dense and empty vectors score as the logistic function, without a dense copy of each row."""
    rows = [(Vectors.sparse(5, [1, 3], [2.0, -1.0]),), (Vectors.dense([1.0, 0.0, 0.5, 0.0, 3.0]),), (Vectors.sparse(5, [], []),)]
    w, b = np.array([[0.1, 0.7, -2.0, 0.3, 0.9], [1.0, -1.0, 0.2, 0.0, -0.4]]), np.array([0.2, -0.1])
    model = M.MultiLabelModel(None, ["a", "b"], w, b, [None, None])
    out = spark.createDataFrame(rows, ["features"]).select("features", model._probabilities().alias("p"))
    for r in out.collect():
        assert r.p == pytest.approx((1 / (1 + np.exp(-(w @ r.features.toArray() + b)))).tolist())
    assert "UDF" not in out._jdf.queryExecution().optimizedPlan().toString()


def test_terms_are_counted_once_for_a_fit(spark):
    """The weights are fitted on the written counts: the texts of the training rows are gone through once."""
    read = spark.sparkContext.accumulator(0)

    def texts(it):
        for b in it:
            read.add(len(b))
            yield b

    df = _toy(spark).repartition(2).mapInPandas(texts, "id long, text string, vec array<int>")
    model = M.fit(M.prepare(df, ["sport", "money"]), 0.01, 5)
    assert read.value == 80 and len(model.labels) == 2


def test_a_grid_is_scored_in_batches_of_bounded_bytes(spark, monkeypatch):
    """The features of the validation rows reach the scorer in batches of a few MB (here: KB), not of a number of rows."""
    batches = spark.sparkContext.accumulator(0)

    @F.arrow_udf("array<double>")
    def halves(features: pa.Array) -> pa.Array:
        batches.add(1)
        return pa.array([[0.5] * 4] * len(features), pa.list_(pa.float64()))

    df = _toy(spark).coalesce(1)
    features = M.prepare(df, ["sport", "money"])
    monkeypatch.setattr(M.multilabel, "scorer", lambda w, b: halves)
    monkeypatch.setattr(M.multilabel, "BATCH", 2048, raising=False)
    _, table = M.select_model(features, df, [(0.1, 3), (0.01, 3)])
    assert batches.value > 1 and [r["chosen"] for r in table] == [True, False]
