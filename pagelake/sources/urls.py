"""URL list source (S1): one URL per line, stripped, blanks dropped, order and duplicates kept."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.text import py_strip
from ..operators.indexing import broadcast_if_small, dense_positions


def read_url_list(spark: SparkSession, path: str) -> DataFrame:
    """``(seq, url)`` with ``seq`` the 0-based position among the non-blank lines.

    Line order is file order (file path, then split start, then position in
    the split). Every split is counted (one small row per split), prefix sums
    give line numbers without moving the lines, and the kept lines are then
    numbered densely by ``dense_positions``.
    """
    raw = spark.read.text(path).select(
        "value",
        F.col("_metadata.file_path").alias("_f"),
        F.col("_metadata.file_block_start").alias("_s"),
        F.monotonically_increasing_id().alias("_mid"),
    )
    splits = raw.groupBy("_f", "_s").agg(F.count("*").alias("_n"), F.min("_mid").alias("_m0"))
    before = Window.orderBy("_f", "_s").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.select("_f", "_s", "_m0", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    lines = raw.join(broadcast_if_small(splits, 1_000_000), ["_f", "_s"]).select(
        (F.col("_off") + F.col("_mid") - F.col("_m0")).alias("_line"), py_strip("value").alias("url")
    )
    kept = lines.where(F.col("url") != "")
    return dense_positions(kept, "_line", "seq").select("seq", "url")


def write_url_list(urls: DataFrame, path: str, order_col: str, url_col: str = "url") -> None:
    """Write URLs as text lines in ``order_col`` order (range-partitioned, so file order is URL order)."""
    urls.select(order_col, url_col).orderBy(order_col).select(F.col(url_col).alias("value")).write.mode("overwrite").text(path)
