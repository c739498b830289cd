"""Multi-label metrics over flattened cells.

The original flattens the (rows x labels) prediction and truth matrices
before calling F1, so ``f1_micro`` is cell accuracy and ``f1_macro`` is the
mean of the F1 of class 0 and class 1 over the classes that occur in truth or
prediction. One global aggregation (partial sums per task, then one row).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _f1(t, f1, f2):
    den = 2 * t + f1 + f2
    return F.when(den == 0, F.lit(0.0)).otherwise(2.0 * t / den)


def flattened_f1(
    df: DataFrame, truth_cols: list[str], prob_cols: list[str], threshold: float = 0.5, by: list[str] | None = None
) -> DataFrame:
    """``n_cells, tp, fp, fn, tn, f1_micro, f1_macro`` for 0/1 truth and probability columns, for each group ``by``."""
    by = by or []
    aggs = []
    for y, p in zip(truth_cols, prob_cols):
        pred = (F.col(p) >= threshold).cast("int")
        aggs.append(F.struct(F.col(y).alias("y"), pred.alias("p")))
    cells = df.select(*by, F.explode(F.array(*aggs)).alias("c")).select(*by, "c.y", "c.p")
    s = cells.groupBy(*by).agg(
        F.count("*").alias("n_cells"),
        F.sum(((F.col("y") == 1) & (F.col("p") == 1)).cast("long")).alias("tp"),
        F.sum(((F.col("y") == 0) & (F.col("p") == 1)).cast("long")).alias("fp"),
        F.sum(((F.col("y") == 1) & (F.col("p") == 0)).cast("long")).alias("fn"),
        F.sum(((F.col("y") == 0) & (F.col("p") == 0)).cast("long")).alias("tn"),
    )
    has1 = (F.col("tp") + F.col("fp") + F.col("fn")) > 0
    has0 = (F.col("tn") + F.col("fp") + F.col("fn")) > 0
    f1_1, f1_0 = _f1(F.col("tp"), F.col("fp"), F.col("fn")), _f1(F.col("tn"), F.col("fn"), F.col("fp"))
    n_classes = has1.cast("int") + has0.cast("int")
    macro = F.when(n_classes == 0, F.lit(0.0)).otherwise(
        (F.when(has1, f1_1).otherwise(0.0) + F.when(has0, f1_0).otherwise(0.0)) / n_classes
    )
    micro = F.when(F.col("n_cells") == 0, F.lit(0.0)).otherwise((F.col("tp") + F.col("tn")) / F.col("n_cells"))
    return s.select(*by, "n_cells", "tp", "fp", "fn", "tn", micro.alias("f1_micro"), macro.alias("f1_macro"))
