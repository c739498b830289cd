"""Label map, multi-hot targets, ``labels_bin`` codec, train/val split (L1-L4).

The label vocabulary is small by nature (a handful to a few thousand
classes); it is computed with a distributed ``distinct`` and only the
resulting map - checked against ``max_labels`` - is ever brought to the
driver, to be inlined as a literal array in the per-row expressions.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import py_strip


def label_parts(c) -> Column:
    """Split a comma list, strip white space of every kind from each part, drop empties (NULL counts as ``''``)."""
    col = F.col(c) if isinstance(c, str) else c
    parts = F.transform(F.split(F.coalesce(col, F.lit("")), ","), lambda x: py_strip(x))
    return F.filter(parts, lambda x: x != "")


def label_map(rows: DataFrame, labels_col: str = "labels") -> DataFrame:
    """L1: ``(label, idx)`` - distinct labels in code-point order, indexed from 0."""
    distinct = rows.select(F.explode(label_parts(labels_col)).alias("label")).distinct()
    # the window is over the distinct labels only (a small set), not over the rows
    return distinct.select("label", (F.row_number().over(Window.orderBy("label")) - 1).alias("idx"))


def collect_label_list(lmap: DataFrame, max_labels: int = 100_000) -> list[str]:
    """The label map as an index-ordered list, with a size check before it leaves Spark."""
    n = lmap.count()
    if n > max_labels:
        raise ValueError(f"label map has {n} entries, more than max_labels={max_labels}")
    return [r["label"] for r in lmap.orderBy("idx").collect()]


def multihot(rows: DataFrame, labels: list[str], labels_col: str = "labels") -> Column:
    """L2: 0/1 vector in label-index order; unknown labels are ignored, no label gives all zeros."""
    parts = label_parts(labels_col)
    return F.array(*[F.array_contains(parts, F.lit(lab)).cast("int") for lab in labels]) if labels else F.array().cast("array<int>")


def encode_bin(vec) -> Column:
    """L4: ``[0, 1, 0]`` -> ``'0,1,0'``."""
    v = F.col(vec) if isinstance(vec, str) else vec
    return F.array_join(F.transform(v, lambda x: x.cast("string")), ",")


def decode_bin(s) -> Column:
    """L4: ``'0,1,0'`` -> ``[0, 1, 0]`` (an empty string is an error, as in the original loader)."""
    c = F.col(s) if isinstance(s, str) else s
    return F.transform(
        F.split(c, ","),
        lambda x: F.when(py_strip(x).rlike("^-?[0-9]+$"), py_strip(x).cast("int")).otherwise(
            F.raise_error(F.concat(F.lit("bad labels_bin element: "), x)).cast("int")
        ),
    )


def split_hash(id_col: str, seed: int) -> Column:
    return F.md5(F.concat(F.col(id_col).cast("string"), F.lit("-"), F.lit(str(seed))))


def train_val_split(rows: DataFrame, id_col: str = "id", test_size: float = 0.1, seed: int = 42) -> DataFrame:
    """L3: adds ``split`` = ``'val'`` for the ``ceil(n * test_size)`` rows with the
    smallest ``md5(id || '-' || seed)`` (ties by id), ``'train'`` for the rest.

    Exact without a global sort: a 65,536-bucket histogram of the hash prefix
    (bounded size) finds the boundary bucket; only the rows of that one bucket
    are ranked.
    """
    h = rows.withColumn("_h", split_hash(id_col, seed)).withColumn("_b", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    hist = h.groupBy("_b").agg(F.count("*").alias("_n"))
    whole = Window.partitionBy()
    upto = Window.orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    hist = (
        hist.withColumn("_total", F.sum("_n").over(whole))
        .withColumn("_before", F.coalesce(F.sum("_n").over(upto), F.lit(0)))
        .withColumn("_nval", F.ceil(F.col("_total") * F.lit(float(test_size))))
        .select("_b", "_n", "_before", "_nval")
    )
    # at most 65,536 rows: a proven bound for the broadcast
    j = h.join(F.broadcast(hist), "_b")
    inside = (F.col("_before") + F.col("_n")) <= F.col("_nval")
    boundary = (F.col("_before") < F.col("_nval")) & ~inside
    settled = j.where(~boundary).withColumn("split", F.when(inside, F.lit("val")).otherwise(F.lit("train")))
    rank_w = Window.partitionBy("_b").orderBy("_h", id_col)
    edge = (
        j.where(boundary)
        .withColumn("_r", F.row_number().over(rank_w))
        .withColumn("split", F.when(F.col("_before") + F.col("_r") <= F.col("_nval"), F.lit("val")).otherwise(F.lit("train")))
        .drop("_r")
    )
    return settled.unionByName(edge).drop("_h", "_b", "_n", "_before", "_nval")
