"""Ordered dense numbering and size-checked broadcast."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def broadcast_if_small(df: DataFrame, max_rows: int, max_bytes: int = 64 << 20) -> DataFrame:
    """Broadcast hint only when rows and bytes, both measured, prove the side small; otherwise a shuffle join."""
    strings = [c for c, t in df.dtypes if t == "string"]
    size = F.lit(32 + 8 * len(df.columns))
    for c in strings:
        size = size + F.coalesce(F.octet_length(c), F.lit(0))
    r = df.agg(F.count("*").alias("n"), F.sum(size.cast("long")).alias("b")).first()
    return F.broadcast(df) if r["n"] <= max_rows and (r["b"] or 0) <= max_bytes else df


def dense_positions(df: DataFrame, key: str, name: str = "pos", start: int = 0, buckets: int | None = None) -> DataFrame:
    """Add ``name`` = ``start`` + 0-based rank of the unique numeric ``key``.

    No single-task window over all rows: approximate quantiles cut the key
    range into ``buckets`` ranges (a few numbers reach the driver), rows are
    counted per range (at most ``buckets`` rows), the prefix sums give each
    range its offset, and rows are ranked only inside their range.
    """
    spark = df.sparkSession
    if buckets is None:
        buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
    buckets = max(1, buckets)
    probs = [i / buckets for i in range(1, buckets)]
    bounds = sorted(set(df.approxQuantile(key, probs, 0.001))) if probs else []
    lit_bounds = F.array(*[F.lit(float(b)) for b in bounds]) if bounds else F.array().cast("array<double>")
    b = F.size(F.filter(lit_bounds, lambda x: x < F.col(key).cast("double")))
    keyed = df.withColumn("_bk", b)
    counts = keyed.groupBy("_bk").agg(F.count("*").alias("_cnt"))
    before = Window.orderBy("_bk").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("_bk", F.coalesce(F.sum("_cnt").over(before), F.lit(0)).alias("_off"))
    w = Window.partitionBy("_bk").orderBy(key)
    # offsets has at most `buckets` rows: a proven bound for the broadcast
    return (
        keyed.join(F.broadcast(offsets), "_bk")
        .withColumn(name, (F.lit(start) + F.col("_off") + F.row_number().over(w) - 1).cast("bigint"))
        .drop("_bk", "_off")
    )
