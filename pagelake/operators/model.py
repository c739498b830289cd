"""Multi-label text classifier (L5 featurise, L6 train, L8 select, L9 score).

The reference fine-tunes a transformer with one sigmoid output per label;
here the same contract (independent per-label probability, threshold 0.5) is
binary relevance: one logistic regression per label over shared sparse
features. Weight decay maps to ``reg_param``. All labels, and all points of a grid, are
trained in the same passes over the features (see ``multilabel``).

Features: ``RegexTokenizer`` (letters, digits, ``_``), ``HashingTF`` and ``IDF`` over
the whole text (``max_tokens`` cuts it for a caller who asks). The
features of the training rows are computed once and written to the shared
folder, so every pass (and every executor retry) reads them instead of
re-tokenising the texts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import IDF, HashingTF, RegexTokenizer, SQLTransformer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import let
from ..session import arrow_bytes, ship_code, written
from . import multilabel
from .metrics import flattened_f1

NUM_FEATURES = 1 << 12


def feature_pipeline(text_col: str = "text", max_tokens: int | None = None, num_features: int = NUM_FEATURES) -> Pipeline:
    """Text -> sparse TF-IDF ``features`` (of the first ``max_tokens`` tokens, if given)."""
    tok = RegexTokenizer(inputCol=text_col, outputCol="_tokens_all", pattern=r"[^\p{L}\p{N}_]+", gaps=True, toLowercase=True)
    tokens = "_tokens_all" if max_tokens is None else f"slice(_tokens_all, 1, {int(max_tokens)})"
    cut = SQLTransformer(statement=f"SELECT *, {tokens} AS _tokens FROM __THIS__")
    tf = HashingTF(inputCol="_tokens", outputCol="_tf", numFeatures=num_features)
    idf = IDF(inputCol="_tf", outputCol="features")
    return Pipeline(stages=[tok, cut, tf, idf])


def _prob_col(label: str) -> str:
    return f"p_{label}"


@dataclass
class MultiLabelModel:
    features: PipelineModel
    labels: list[str]
    coefficients: np.ndarray  # a row for each label; zeros for a label with one class in training
    intercepts: np.ndarray
    constants: list[float | None]  # the probability of a label with one class in training

    def predict_proba(self, df: DataFrame) -> DataFrame:
        """Adds ``p_<label>`` (probability of the label) for every label, and
        ``probs`` (``array<double>`` in label-index order). A column expression; what scores very many models at once
        is ``multilabel.scorer``."""
        out = self.features.transform(df)
        # (through a one-element generator: what uses the scores cannot be merged with, and repeat, what makes them)
        out = out.select("*", F.explode_outer(F.array(self._probabilities())).alias("probs"))
        if any(c is not None for c in self.constants):
            fixed = [F.col("probs")[i] if c is None else F.lit(float(c)) for i, c in enumerate(self.constants)]
            out = out.withColumn("probs", F.array(*fixed))
        out = out.drop("_tokens_all", "_tokens", "_tf", "features")
        return out.select("*", *[F.col("probs")[i].alias(_prob_col(lab)) for i, lab in enumerate(self.labels)])

    def _probabilities(self) -> Column:
        """Each label's probability from the values that a row's vector holds (a dense one: all), in index order."""

        def each(v: Column) -> Column:
            index = F.coalesce(v["indices"], F.slice(F.sequence(F.lit(0), F.size(v["values"])), 1, F.size(v["values"])))
            total = lambda at, w: F.aggregate(F.zip_with(at, v["values"], lambda i, x: x * F.get(w, i)), F.lit(0.0), lambda s, x: s + x)
            models = list(zip(self.coefficients, self.intercepts.tolist(), strict=True))
            return let(index, lambda at: F.array(*[1 / (1 + F.exp(-(total(at, F.lit(w)) + b))) for w, b in models]))

        return let(F.unwrap_udt("features"), each)

    def save(self, path: str) -> None:
        """The feature stages, and the labels with their coefficients beside them."""
        path = path.rstrip("/")
        self.features.write().overwrite().save(f"{path}/features")
        cells = zip(self.labels, self.constants, self.intercepts.tolist(), self.coefficients.tolist(), strict=True)
        rows = [(lab, i, c, b, w) for i, (lab, c, b, w) in enumerate(cells)]
        SparkSession.active().createDataFrame(rows, LABEL_FILE).coalesce(1).write.mode("overwrite").parquet(f"{path}/labels")


LABEL_FILE = "label string, idx int, constant double, intercept double, coefficients array<double>"


def load_model(spark: SparkSession, path: str) -> MultiLabelModel:
    """A saved model, with its labels in index order."""
    path = path.rstrip("/")
    rows = sorted(spark.read.schema(LABEL_FILE).parquet(f"{path}/labels").collect(), key=lambda r: r["idx"])
    coefficients, intercepts = np.array([r["coefficients"] for r in rows]), np.array([r["intercept"] for r in rows])
    features = PipelineModel.load(f"{path}/features")
    return MultiLabelModel(features, [r["label"] for r in rows], coefficients, intercepts, [r["constant"] for r in rows])


@dataclass
class Features:
    """Fitted features and the training rows' features, written once to the shared folder."""

    model: PipelineModel
    problem: multilabel.Problem  # the packed ``features, y`` with their moments
    labels: list[str]


def prepare(
    train_df: DataFrame,
    labels: list[str],
    target_col: str = "vec",
    text_col: str = "text",
    max_tokens: int | None = None,
    num_features: int = NUM_FEATURES,
) -> Features:
    """L5 on the training rows: count their terms once, fit the weights on the counts, then materialise the features
    with the per-label 0/1 targets, for any number of fits (a grid reuses them)."""
    *counting, idf = feature_pipeline(text_col, max_tokens, num_features).getStages()
    counting = Pipeline(stages=counting).fit(train_df)
    y = F.transform(F.col(target_col), lambda v: v.cast("float"))
    counted = written(counting.transform(train_df).select("_tf", y.alias("y")), "counts")
    weighted = idf.fit(counted)
    feats = PipelineModel(stages=[*counting.stages, weighted])
    table = weighted.transform(counted).select("features", "y")
    return Features(feats, multilabel.Problem.of(table, num_features, len(labels)), list(labels))


def fit_grid(features: Features, grid: list[tuple[float, int]]) -> list[MultiLabelModel]:
    """L6 for each (reg_param, max_iter): all labels of all grid points in the same passes."""
    p = features.problem
    # a label with one class has a constant model (a fit would be degenerate)
    constants = [None if 0 < k < p.n else float(k > 0) for k in p.positive.tolist()]
    wanted = [(g, i) for g in range(len(grid)) for i, c in enumerate(constants) if c is None]
    trained, _ = multilabel.train(p, [(i, grid[g][0], grid[g][1]) for g, i in wanted])
    out = []
    for g in range(len(grid)):
        coefficients, intercepts = np.zeros((len(features.labels), len(p.scale))), np.zeros(len(features.labels))
        for (at, i), (w, b) in zip(wanted, trained, strict=True):
            if at == g:
                coefficients[i], intercepts[i] = w, b
        out.append(MultiLabelModel(features.model, features.labels, coefficients, intercepts, constants))
    return out


def fit(features: Features, reg_param: float = 0.01, max_iter: int = 20) -> MultiLabelModel:
    """One logistic regression per label on prepared features."""
    return fit_grid(features, [(reg_param, max_iter)])[0]


def train(
    train_df: DataFrame,
    labels: list[str],
    target_col: str = "vec",
    text_col: str = "text",
    reg_param: float = 0.01,
    max_iter: int = 20,
    max_tokens: int | None = None,
    num_features: int = NUM_FEATURES,
) -> MultiLabelModel:
    """L5 + L6: features fitted on the training texts, then one logistic
    regression per label on ``target_col`` (the multi-hot ``array<int>``)."""
    return fit(prepare(train_df, labels, target_col, text_col, max_tokens, num_features), reg_param, max_iter)


def f1_scores(model: MultiLabelModel, rows: DataFrame, threshold: float = 0.5, target_col: str = "vec") -> DataFrame:
    """L7 for a model on labelled rows: the flattened F1 over all labels."""
    n = range(len(model.labels))
    p = model.predict_proba(rows).select(*[F.col(target_col)[i].alias(f"y{i}") for i in n], *[F.col("probs")[i].alias(f"p{i}") for i in n])
    return flattened_f1(p, [f"y{i}" for i in n], [f"p{i}" for i in n], threshold)


def select_model(
    features: Features, val: DataFrame, grid: list[tuple[float, int]], threshold: float = 0.5, target_col: str = "vec"
) -> tuple[MultiLabelModel, list[dict]]:
    """A model for each (reg_param, max_iter) of the grid, scored on ``val``: the one with the highest micro F1
    (ties: the first), and a row for every grid point. The grid is trained in the passes of one fit and scored
    in one pass over ``val``."""
    models = fit_grid(features, grid)
    spark = val.sparkSession
    ship_code(spark)
    n = range(len(features.labels))
    scored = features.model.transform(val)
    every = multilabel.scorer(np.concatenate([m.coefficients for m in models]), np.concatenate([m.intercepts for m in models]))
    cells = scored.select(target_col, every("features").alias("all"))
    out = []
    for g, m in enumerate(models):
        at = [F.col("all")[g * len(n) + i] if m.constants[i] is None else F.lit(m.constants[i]) for i in n]
        truth = [F.col(target_col)[i] for i in n]
        out.append(F.struct(F.lit(g).alias("grid"), *[c.alias(f"y{i}") for i, c in enumerate(truth)], *[c.alias(f"p{i}") for i, c in enumerate(at)]))
    rows = cells.select(F.explode(F.array(*out)).alias("r")).select("r.*")
    by_grid = flattened_f1(rows, [f"y{i}" for i in n], [f"p{i}" for i in n], threshold, by=["grid"])
    with arrow_bytes(spark, multilabel.BATCH):
        scores = {r["grid"]: r for r in by_grid.collect()}
    f1 = [(scores[g]["f1_micro"], scores[g]["f1_macro"]) if g in scores else (0.0, 0.0) for g in range(len(grid))]
    best = max(range(len(grid)), key=lambda i: (f1[i][0], -i))
    rows = [
        {"grid_idx": i, "reg_param": reg, "max_iter": it, "f1_micro": f1[i][0], "f1_macro": f1[i][1], "chosen": i == best}
        for i, (reg, it) in enumerate(grid)
    ]
    return models[best], rows
