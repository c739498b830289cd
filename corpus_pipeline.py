"""A training corpus from the table ``documents``, in five stages.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame with the columns of documents (the last one:
pieces of packed sequences); it is written and read again as the next stage's docs. Null or repeated ids: of copies
one row stays, whatever its id; as contaminated a row without an id is never dropped, and rows that repeat an id go
together.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.llm import decontam, langmodel, packing, simhash, suffixdedup
from pagelake.llm.common import documents, written
from pagelake.session import read_table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rejected texts go: null, without a letter, or unlike every language. A missing language is filled in."""
    found = langmodel.identify(docs, F.lit(True), keep=True)
    lang = F.coalesce(F.col("lang"), F.col("__lang_pred"))
    return found.where(~F.col("__rejected")).withColumn("lang", lang).select(*docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies one document stays: the one with the smallest id."""
    return simhash.deduplicate(docs, shingle=3, bits=3)


def suffix_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes leave the texts; a character of which only a part is left goes with them.
    A null text stays null."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    out = suffixdedup.remove_repeats(docs, length=100, carry=rest)
    kept = out.select("doc_id", F.col("kept_text").alias("text"), *[F.col(f"rest.{c}").alias(c) for c in rest])
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with ten consecutive words of a benchmark item go."""
    return decontam.decontaminate(docs, read_table(spark, sf_dir, "benchmark"), window=10).select(*docs.columns)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of at most 2048 tokens."""
    return packing.pack_documents(docs, capacity=2048)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language_id", language_id),
    ("near_dedup", near_dedup),
    ("suffix_dedup", suffix_dedup),
    ("decontamination", decontamination),
    ("packing", pack),
]

#: No SQL: language models, fingerprints and tokenizers are not expressible there. Tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole table, each result written before the next stage reads it."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
