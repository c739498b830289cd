"""CSV / JSON hand-over files of the labelling loop.

Quoted fields, doubled quotes, embedded newlines; all columns are strings.
Spark writes an empty string as ``""`` and reads it back as NULL, so string
columns are read back through ``coalesce(c, '')``. Whitespace at the ends of
a value is kept (Spark's writer would trim it by default).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

_WRITE_OPTS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "quoteAll": "true",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
    "lineSep": "\n",
}
_READ_OPTS = {"header": "true", "quote": '"', "escape": '"', "multiLine": "true", "mode": "FAILFAST"}


def write_csv(df: DataFrame, path: str) -> None:
    """Write all columns as strings."""
    df.select([F.col(c).cast("string").alias(c) for c in df.columns]).write.mode("overwrite").options(**_WRITE_OPTS).csv(path)


def read_csv(spark: SparkSession, path: str, columns: list[str]) -> DataFrame:
    """The named columns as strings, found by the header, whatever its order; other columns
    are left out, missing ones and empty fields are ``''``."""
    raw = spark.read.options(**_READ_OPTS).csv(path)  # no type inference: every column is a string
    named = {c: F.col(f"`{c}`") for c in raw.columns}
    return raw.select([F.coalesce(named.get(c, F.lit(None).cast("string")), F.lit("")).alias(c) for c in columns])


def label_export(pages: DataFrame) -> DataFrame:
    """Rows to label: ``id, summary_text AS text`` where the summary is not NULL
    (an empty summary passes), plus an empty ``labels`` column."""
    return pages.where(F.col("summary_text").isNotNull()).select(
        F.col("id").cast("string").alias("id"), F.col("summary_text").alias("text"), F.lit("").alias("labels")
    )


def write_label_map(lmap: DataFrame, path: str) -> None:
    """Label map as JSON lines ``{"label": ..., "idx": ...}``."""
    lmap.select("label", "idx").write.mode("overwrite").json(path)


def read_label_map_object(spark: SparkSession, path: str) -> DataFrame:
    """A label map stored as one JSON object ``{"label": idx, ...}``, as ``(label string, idx int)``."""
    whole = spark.read.text(path, wholetext=True)
    return whole.select(F.explode(F.from_json("value", "map<string,int>")).alias("label", "idx"))


def read_label_map(spark: SparkSession, path: str) -> DataFrame:
    """The label map back as ``(label string, idx int)``."""
    return spark.read.schema("label string, idx int").json(path)
