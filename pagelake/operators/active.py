"""Scores to labels, uncertainty, uncertainty sampling (L9 on given logits, L10, L11)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

EPS = 1e-12


def sigmoid(c) -> Column:
    x = F.col(c) if isinstance(c, str) else c
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-x))


def probs_from_logits(logits) -> Column:
    lg = F.col(logits) if isinstance(logits, str) else logits
    return F.transform(lg, lambda x: sigmoid(x))


def label_names(n_from: Column, names: list[str]) -> Column:
    """Name of each index: the label map's name, or the index as text when unknown."""
    lit_names = F.array(*[F.lit(n) for n in names]) if names else F.array().cast("array<string>")
    return F.transform(
        F.sequence(F.lit(0), F.greatest(n_from - 1, F.lit(0))),
        lambda i: F.when(i < F.size(lit_names), F.element_at(lit_names, i + 1)).otherwise(i.cast("string")),
    )


def predict_from_probs(probs, names: list[str], threshold: float = 0.5) -> Column:
    """Struct ``labels array<string>`` (score >= threshold, index order) and ``scores map<string,double>``."""
    p = F.col(probs) if isinstance(probs, str) else probs
    nm = F.slice(label_names(F.size(p), names), 1, F.size(p))
    pairs = F.arrays_zip(nm.alias("n"), p.alias("s"))
    chosen = F.transform(F.filter(pairs, lambda z: z["s"] >= threshold), lambda z: z["n"])
    return F.struct(chosen.alias("labels"), F.map_from_arrays(nm, p).alias("scores"))


def mean_binary_entropy(probs) -> Column:
    """``-mean(p ln(p + eps) + (1 - p) ln(1 - p + eps))``; NULL for an empty vector."""
    p = F.col(probs) if isinstance(probs, str) else probs
    total = F.aggregate(
        p, F.lit(0.0), lambda s, x: s + x * F.log(x + F.lit(EPS)) + (F.lit(1.0) - x) * F.log(F.lit(1.0) - x + F.lit(EPS))
    )
    return F.when(F.size(p) > 0, -total / F.size(p))


def sample_uncertain(df: DataFrame, id_col: str, probs_col: str, top_k: int = 50) -> DataFrame:
    """The ``top_k`` rows of highest uncertainty (ties by id), with ``uncertainty`` and ``rank``.

    ``orderBy(...).limit(k)`` plans as ``TakeOrderedAndProject``: every task keeps
    its own top k, only those reach the final merge.
    """
    scored = df.withColumn("uncertainty", mean_binary_entropy(probs_col)).where(F.col("uncertainty").isNotNull())
    top = scored.orderBy(F.col("uncertainty").desc(), F.col(id_col).asc()).limit(top_k)
    return top
