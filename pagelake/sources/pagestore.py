"""The page table (S3): declared schema, snapshot writes."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

PAGES_SCHEMA = T.StructType(
    [
        T.StructField("id", T.LongType(), False),
        T.StructField("url", T.StringType(), False),
        T.StructField("fetched_at", T.TimestampType(), True),
        T.StructField("status_code", T.IntegerType(), True),
        T.StructField("title", T.StringType(), True),
        T.StructField("lang", T.StringType(), True),
        T.StructField("text_excerpt", T.StringType(), True),
        T.StructField("html_path", T.StringType(), True),
        T.StructField("raw_meta", T.MapType(T.StringType(), T.StringType()), True),
        T.StructField("summary_text", T.StringType(), True),
        T.StructField("summary_keywords", T.ArrayType(T.StringType()), True),
        T.StructField("embedding", T.ArrayType(T.DoubleType()), True),
    ]
)
COLUMNS = [f.name for f in PAGES_SCHEMA.fields]
FETCHED_BY = {"fetched_by": "playwright"}  # the only raw_meta the pipeline writes


def conform(df: DataFrame) -> DataFrame:
    """Project/cast to the declared page schema (missing columns become NULL)."""
    cols = []
    for f in PAGES_SCHEMA.fields:
        c = F.col(f.name) if f.name in df.columns else F.lit(None)
        cols.append(c.cast(f.dataType).alias(f.name))
    return df.select(*cols)


def empty_pages(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([], PAGES_SCHEMA)


def write_snapshot(df: DataFrame, path: str) -> None:
    """Write a new snapshot; never overwrite the path a plan is reading from."""
    conform(df).write.mode("errorifexists").parquet(path)


def read_pages(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(PAGES_SCHEMA).parquet(path)
