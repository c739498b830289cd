"""Lexical text vectors (V1, V2): hashed TF-IDF, L2-normalised, ``array<double>``.

The default encoder stands in for a neural sentence encoder (the model slot
below takes one). Tokens are lower-cased runs of letters, digits and ``_``;
each token falls in one of ``dim`` buckets by the first 32 bits of its md5;
a text's vector is ``tf(bucket) * idf(bucket)``, divided by its L2 norm
(texts without tokens give the zero vector, which search scores -1).
``idf = ln((n_docs + 1) / (df + 1))``, the smoothing Spark ML's ``IDF`` uses.

Plan: fitting is one aggregation - each document emits its distinct buckets,
partial aggregation leaves at most ``dim`` rows per task, and the ``dim``
document frequencies (a bound fixed by the parameter) become a literal array.
Encoding is then a per-row expression (sort the bucket ids, count runs, look
the counts up per bucket): no shuffle, no join, no Python. Fitting, and encoding for the searches and for
enrichment (``embed_batches``), count in Arrow batches instead: there the JVM splits the texts, md5 is taken of the
distinct tokens of a batch, and (row, bucket) pairs are sorted with numpy. The vectors are the same.
"""

from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..session import ship_code, spread

DIM = 256
TOKEN_SPLIT_RE = r"[^\p{L}\p{N}_]+"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def embed_tokens(text) -> Column:
    return F.filter(F.split(F.lower(F.coalesce(_c(text), F.lit(""))), TOKEN_SPLIT_RE), lambda t: t != "")


def bucket(tok: Column, dim: int) -> Column:
    return F.pmod(F.conv(F.substring(F.md5(tok), 1, 8), 16, 10).cast("bigint"), F.lit(dim)).cast("int")


def token_bucket(tok: str, dim: int) -> int:
    return int.from_bytes(hashlib.md5(tok.encode()).digest()[:4], "big") % dim


def _counts(tokens: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, bucket, count) of a column of token lists, by row and bucket; the md5 is taken of each distinct token."""
    n = np.asarray(pa.compute.fill_null(pa.compute.list_value_length(tokens), 0), dtype=np.int64)
    coded = tokens.flatten().dictionary_encode()
    buckets = np.fromiter((token_bucket(t, dim) for t in coded.dictionary.to_pylist()), dtype=np.int64, count=len(coded.dictionary))
    key = np.repeat(np.arange(len(n)), n) * dim + buckets[coded.indices.to_numpy()] if len(buckets) else np.zeros(0, dtype=np.int64)
    found, count = np.unique(key, return_counts=True)
    return found // dim, found % dim, count


def _lists(row: np.ndarray, values: np.ndarray, rows: int) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(rows + 1)), pa.int32()), pa.array(values.astype(np.int32)))


def with_bucket_counts(df: DataFrame, text_col: str, dim: int = DIM, prefix: str = "_e") -> DataFrame:
    """Adds ``{prefix}b`` (the distinct buckets of the text, ascending) and
    ``{prefix}c`` (their counts).

    No lambda here refers to anything but its own arguments: Catalyst may
    inline a projected column into a pushed-down filter, and an outer column
    inside a lambda would then be recomputed for every array element.
    """
    s, f, e = f"{prefix}s", f"{prefix}f", f"{prefix}end"
    out = df.withColumn(s, F.sort_array(F.transform(embed_tokens(text_col), lambda t: bucket(t, dim))))
    n = F.size(s)
    # next element (-1 after the last); a run of equal ids ends where the next differs
    nxt = F.slice(F.concat(F.slice(s, 2, F.greatest(n - 1, F.lit(0))), F.array(F.lit(-1))), 1, n)
    pos = F.slice(F.sequence(F.lit(1), F.greatest(n, F.lit(1))), 1, n)
    out = out.withColumn(f, F.zip_with(F.col(s), nxt, lambda a, b: a != b)).withColumn(
        e, F.array_compact(F.zip_with(F.col(f), pos, lambda x, k: F.when(x, k)))
    )
    out = out.withColumn(f"{prefix}b", F.array_compact(F.zip_with(F.col(f), F.col(s), lambda x, a: F.when(x, a))))
    prev = F.slice(F.concat(F.array(F.lit(0)), F.col(e)), 1, F.size(e))
    return out.withColumn(f"{prefix}c", F.zip_with(F.col(e), prev, lambda x, p: (x - p).cast("int"))).drop(s, f, e)


ENCODER_FILE = "n_docs long, idf array<double>"


@dataclass
class TextEncoder:
    """A fitted lexical encoder: ``idf[i]`` for bucket ``i``."""

    idf: list[float]
    n_docs: int

    @property
    def dim(self) -> int:
        return len(self.idf)

    def save(self, spark: SparkSession, path: str) -> None:
        """One JSON row, so that later runs embed into the same space."""
        spark.createDataFrame([(self.n_docs, self.idf)], ENCODER_FILE).coalesce(1).write.mode("overwrite").json(path)

    @staticmethod
    def load(spark: SparkSession, path: str) -> TextEncoder:
        r = spark.read.schema(ENCODER_FILE).json(path).first()
        return TextEncoder(idf=list(r["idf"]), n_docs=r["n_docs"])

    def embed(self, df: DataFrame, text_col: str = "text", out_col: str = "embedding") -> DataFrame:
        """V1/V2: adds the normalised ``array<double>`` vector of ``text_col``.

        The sparse ``(bucket, weight)`` pairs are scattered into the dense
        vector as runs of zeros followed by the weight, so the work per text is
        linear in its distinct buckets plus ``dim``.
        """
        dim = self.dim
        idf = F.array(*[F.lit(float(x)) for x in self.idf])
        t = with_bucket_counts(df, text_col, dim, "_e")
        t = t.withColumn("_ew", F.zip_with("_eb", "_ec", lambda b, c: c * F.get(idf, b)))
        t = t.withColumn("_en", F.sqrt(F.aggregate("_ew", F.lit(0.0), lambda acc, x: acc + x * x)))
        t = t.withColumn("_ep", F.slice(F.concat(F.array(F.lit(-1)), F.col("_eb")), 1, F.size("_eb")))
        t = t.withColumn("_enr", F.array_repeat(F.col("_en"), F.size("_eb")))
        runs = F.transform(
            F.arrays_zip("_eb", "_ep", "_ew", "_enr"),
            lambda z: F.concat(F.array_repeat(F.lit(0.0), z["_eb"] - z["_ep"] - 1), F.array(z["_ew"] / z["_enr"])),
        )
        last = F.coalesce(F.get(F.col("_eb"), F.size("_eb") - 1), F.lit(-1))
        dense = F.concat(F.flatten(runs), F.array_repeat(F.lit(0.0), F.lit(dim - 1) - last))
        vec = F.when(F.col("_en") > 0, dense).otherwise(F.array_repeat(F.lit(0.0), dim))
        keep = [F.col(c) for c in df.columns if c != out_col]
        # The vector leaves through a one-element generator: a later filter on it
        # cannot be pushed below a Generate, so it is never inlined into (and
        # repeated by) the staged projections above.
        return t.select(*keep, F.explode_outer(F.array(vec)).alias(out_col))

    def embed_batches(self, df: DataFrame, text_col: str = "text", out_col: str = "embedding") -> DataFrame:
        """``embed`` in Arrow batches: the same vectors in a fraction of the time. The sums go by ascending bucket."""
        ship_code(df.sparkSession)
        idf = np.array(self.idf, dtype=np.float64)

        @F.arrow_udf("array<double>")
        def vectors(tokens: pa.Array) -> pa.Array:
            row, b, c = _counts(tokens, len(idf))
            w = c * idf[b]
            norm = np.sqrt(np.bincount(row, weights=w * w, minlength=len(tokens)))
            out = np.zeros((len(tokens), len(idf)))
            some = norm[row] > 0
            out[row[some], b[some]] = w[some] / norm[row[some]]
            at = np.arange(len(tokens) + 1, dtype=np.int32) * len(idf)
            return pa.ListArray.from_arrays(pa.array(at, pa.int32()), pa.array(out.ravel()))

        keep = [F.col(c) for c in df.columns if c != out_col]
        return df.select(*keep, vectors(embed_tokens(text_col)).alias(out_col))


def fit_encoder(corpus: DataFrame, text_col: str = "text", dim: int = DIM) -> TextEncoder:
    """Document frequencies over the whole corpus (one row per document)."""
    if dim <= 0:
        raise ValueError("dim must be > 0")
    ship_code(corpus.sparkSession)

    @F.arrow_udf("array<int>")
    def buckets(tokens: pa.Array) -> pa.Array:
        row, b, _ = _counts(tokens, dim)
        return _lists(row, b, len(tokens))

    per_doc = spread(corpus.select(text_col)).select(buckets(embed_tokens(text_col)).alias("_eb"))
    stats = (
        # explode_outer: a plain explode would make Catalyst infer a filter on the
        # array and push it below the projections
        per_doc.select(F.explode_outer("_eb").alias("bucket"))
        .where(F.col("bucket").isNotNull())
        .groupBy("bucket")
        .agg(F.count("*").alias("df"))
        .collect()  # at most `dim` rows
    )
    n = corpus.count()
    dfreq = {r["bucket"]: r["df"] for r in stats}
    idf = [math.log((n + 1.0) / (dfreq.get(i, 0) + 1.0)) for i in range(dim)]
    return TextEncoder(idf=idf, n_docs=n)


def embed(df: DataFrame, encoder: TextEncoder, text_col: str = "text", out_col: str = "embedding") -> DataFrame:
    return encoder.embed(df, text_col, out_col)


def embed_with_model(df: DataFrame, text_col: str, encode, out_col: str = "embedding", batch_rows: int = 64) -> DataFrame:
    """Model slot for V1: ``encode(list[str]) -> list[list[float]]`` runs in Arrow
    batches inside the executors (one model load per Python worker); an empty
    batch gives an empty result, as in the original. When a call raises, its
    texts are encoded one by one and a text that still fails gets NULL (the
    original rolls that page back and goes on with the others)."""

    def _one(t):
        try:
            return [float(x) for x in encode([t])[0]]
        except Exception:  # noqa: BLE001
            return None

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def _enc(texts: pd.Series) -> pd.Series:
        out = []
        vals = texts.fillna("").tolist()
        for i in range(0, len(vals), batch_rows):
            part = vals[i : i + batch_rows]
            try:
                out.extend([[float(x) for x in v] for v in encode(part)])
            except Exception:  # noqa: BLE001 - fall back to one text at a time
                out.extend(_one(t) for t in part)
        return pd.Series(out, dtype=object)

    return df.withColumn(out_col, _enc(F.col(text_col)))
