"""Registered queries: one per operator of the inventory, each with its DuckDB oracle.

Every query reads the driver tables at ``sf_dir`` (or data Spark derives from
them) and runs over whole tables and whole texts. ``SQL[name]`` is the same
computation as ANSI SQL for DuckDB (views named after the tables); names
missing from ``SQL`` get the rows-only check.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}

# the query entry() runs
FLAGSHIP = "ingest"


def register(name: str, sql: str | None = None):
    def deco(fn):
        QUERIES[name] = fn
        if sql is not None:
            SQL[name] = sql.strip()
        return fn

    return deco


def load_all() -> None:
    """Import the modules that register queries."""
    from . import q_embed, q_extract, q_flow, q_ingest, q_labels, q_lang, q_model, q_text, q_vectors  # noqa: F401
