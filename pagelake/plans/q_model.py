"""Classifier queries: L5 featurise, L6 train + L9 predict, L8 model selection, L11 with a model."""

from __future__ import annotations

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from ..operators import active as A
from ..operators import labels as L
from ..operators import model as M
from ..session import materialize, spread
from . import fixtures as X
from .q_labels import SEED, TEST_SIZE
from .registry import register

GRID = [(0.001, 20), (0.01, 20), (0.1, 20)]
THRESHOLD = 0.5


def _labelled(spark, sf_dir):
    rows = X.label_rows(spark, sf_dir)
    names = L.collect_label_list(L.label_map(rows))
    m = spread(rows, "id").select("id", "text", L.multihot(rows, names).alias("vec"))
    # read by the feature fit, the feature table and every evaluation: written once
    return materialize(L.train_val_split(m, "id", TEST_SIZE, SEED)), names


@register(
    "featurize",
    r"""
WITH t AS (SELECT doc_id AS id, list_filter(string_split_regex(lower(text), '[^\p{L}\p{N}_]+'), lambda x: x <> '') AS tokens FROM documents)
SELECT id, CAST(len(tokens) AS INTEGER) AS n_tokens, CAST(list_unique(tokens) AS INTEGER) AS n_terms,
       CAST(len(tokens) AS INTEGER) AS tf_total, true AS nnz_fits
FROM t
""",
)
def featurize(spark, sf_dir):
    """Features of every whole document: its tokens and distinct terms, the sum of its term frequencies, and whether
    it has at most as many features as terms (which of them meet in one is the hash's affair), none without a term."""
    docs = spread(X.label_rows(spark, sf_dir).select("id", "text"), "id")
    f = M.feature_pipeline("text").fit(docs).transform(docs)
    f = f.select("id", "_tokens", F.filter(vector_to_array("_tf"), lambda x: x != 0).alias("tf"))
    n_terms = F.size(F.array_distinct("_tokens"))
    return f.select(
        "id",
        F.size("_tokens").alias("n_tokens"),
        n_terms.alias("n_terms"),
        F.aggregate("tf", F.lit(0.0), lambda s, x: s + x).cast("int").alias("tf_total"),
        ((F.size("tf") <= n_terms) & ((F.size("tf") > 0) == (n_terms > 0))).alias("nnz_fits"),
    )


@register("train_predict")
def train_predict(spark, sf_dir):
    """L6 + L9: train on the training split, predict the validation split:
    labels with probability >= 0.5 in index order, probability per label."""
    split, names = _labelled(spark, sf_dir)
    model = M.train(split.where("split = 'train'"), names, reg_param=0.01, max_iter=20)
    val = split.where("split = 'val'")
    p = model.predict_proba(val).withColumn("pred", A.predict_from_probs("probs", names, THRESHOLD))
    return p.select(
        "id",
        F.array_join("pred.labels", ",").alias("labels"),
        L.encode_bin("vec").alias("labels_bin"),
        *[F.round(f"p_{n}", 6).alias(f"p_{n}") for n in names],
    )


@register("model_selection")
def model_selection(spark, sf_dir):
    """A small grid of (regParam, maxIter), each trained on the training
    split and scored by the flattened F1 on the validation split; the best
    ``f1_micro`` is chosen (ties: the first grid point)."""
    split, names = _labelled(spark, sf_dir)
    train_df, val = split.where("split = 'train'"), split.where("split = 'val'")
    feats = M.prepare(train_df, names)  # features computed once for the whole grid
    _, rows = M.select_model(feats, val, GRID, THRESHOLD)
    out = spark.createDataFrame(rows, "grid_idx int, reg_param double, max_iter int, f1_micro double, f1_macro double, chosen boolean")
    return out.select("grid_idx", "reg_param", "max_iter", F.round("f1_micro", 6).alias("f1_micro"), F.round("f1_macro", 6).alias("f1_macro"), "chosen")


@register("active_sample")
def active_sample(spark, sf_dir):
    """L10 + L11 with a trained model: score every document, keep the 50 whose
    label probabilities have the highest mean binary entropy (ties by id)."""
    split, names = _labelled(spark, sf_dir)
    model = M.train(split, names, reg_param=0.01, max_iter=20)
    p = model.predict_proba(split.select("id", "text"))
    top = A.sample_uncertain(p, "id", "probs", 50)
    return top.select("id", F.round("uncertainty", 6).alias("uncertainty"), *[F.round(f"p_{n}", 6).alias(f"p_{n}") for n in names])
