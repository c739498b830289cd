"""Small helpers shared by the operators of this subpackage."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pagelake.session import read_table, ship_code, spread
from pagelake.session import written as _written


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """A driver table as a bare scan, spread over the cluster when it has too few splits."""
    return spread(read_table(spark, sf_dir, name))


def id_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, under fixed names: other columns, whatever their names, never take part."""
    ship_code(docs.sparkSession)
    return docs.select(docs[id_col].alias("doc_id"), docs[text_col].cast("string").alias("text"))


def id_type(docs: DataFrame, id_col: str = "doc_id") -> str:
    return docs.select(docs[id_col].alias("x")).schema["x"].dataType.simpleString()


def integer_ids(docs: DataFrame, id_col: str) -> None:
    """Ids of other types would become null where they are compared as numbers: an error."""
    kind = id_type(docs, id_col)
    if kind not in ("tinyint", "smallint", "int", "bigint"):
        raise ValueError(f"{id_col} must be an integer column, not {kind}")


def written(df: DataFrame, name: str) -> DataFrame:
    """``session.written``, compressed well: what is written here holds texts."""
    return _written(df, name, "zstd")


#: Rows up to which one side of a join is broadcast.
FEW = 1 << 17


def side(df: DataFrame, rows: int | None = None) -> DataFrame:
    """One side of a join, broadcast if its rows are few: counted (of a written table), or ``rows`` as a bound; else merged.

    Spark by itself takes a written table for as large as its compressed files and what an explode makes for as large as
    what it is made of, so it may broadcast many times what the driver holds.
    """
    return F.broadcast(df) if (df.count() if rows is None else rows) <= FEW else df.hint("merge")


def tokenizer_path(name: str) -> str:
    """A tokenizer file: an absolute path, or the name of one of the installed public vocabularies."""
    if os.path.isabs(name):
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_rows(column: pa.Array) -> list[bytes | None]:
    """The UTF-8 bytes of a string column, None for null."""
    return column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()


_caches: dict[str, Callable[[], None]] = {}
_owner = ""


def keep_cache(owner: str, clear: Callable[[], None]) -> None:
    """Register what ``owner`` remembers between the tasks of a Python worker."""
    _caches[owner] = clear


def claim(owner: str) -> None:
    """Python workers are used again by other operators: what those remember is dropped before this one works."""
    global _owner
    if owner != _owner:
        _owner = owner
        for name, clear in _caches.items():
            if name != owner:
                clear()


def slices(batch: pa.RecordBatch, column: str, max_bytes: int, owner: str = "") -> Iterator[pa.RecordBatch]:
    """A batch cut into row runs of about ``max_bytes`` of one text column (at least one row each), for ``owner``."""
    claim(owner)
    lens = np.asarray(pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0), dtype=np.int64)
    block = np.cumsum(lens) // max_bytes
    cuts = np.flatnonzero(np.diff(block)) + 1
    for a, b in zip([0, *cuts], [*cuts, batch.num_rows], strict=True):
        if b > a:
            yield batch.slice(a, b - a)


def sql_text_crc32(text) -> F.Column:
    return F.crc32(F.encode(F.coalesce(text, F.lit("")), "utf-8"))


def arrow_schema(ddl: str) -> pa.Schema:
    """The Arrow schema of a Spark DDL string (to be called on the driver)."""
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    return to_arrow_schema(StructType.fromDDL(ddl))
