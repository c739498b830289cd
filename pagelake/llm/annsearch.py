"""Approximate nearest neighbours by an inverted multi-index.

Both halves of the vectors are quantised by codebooks of their own (k-means on a bounded sample); a pair of
centroids is a cell. For a query, a heap walks the pairs in the order of summed dissimilarity of the halves
(the negative inner product with the centroids) until the cells passed hold enough vectors. Those vectors
are compared exactly.

Every row is indexed. How many vectors a query must pass is measured on the sample: the share that finds
``recall`` of the sample's own exact neighbours.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import integer_ids, ship_code, written

#: Rows that the codebooks and the share are fitted on.
SAMPLE_ROWS = 16_384
#: Vectors of a group, the unit of work; a cell with more is split.
GROUP_ROWS = 8192
#: Queries that a group of stored vectors meets at once (more go in further blocks).
QUERY_ROWS = 1 << 16


def kmeans(x: np.ndarray, k: int, rounds: int = 12, seed: int = 7) -> np.ndarray:
    """Centroids of the rows of ``x`` (at most ``k``; fewer if there are fewer distinct rows)."""
    distinct = np.unique(x, axis=0)
    centres = distinct[np.sort(np.random.default_rng(seed).permutation(len(distinct))[:k])]
    for _ in range(rounds):
        of = nearest(x, centres)
        n = np.bincount(of, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, of, x)
        centres = np.where(n[:, None] > 0, sums / np.maximum(n, 1)[:, None], centres)
    return centres


def nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.argmin((centres**2).sum(axis=1) - 2 * (x @ centres.T), axis=1)


class MultiIndex:
    """Two codebooks and the numbers of vectors in the cells."""

    def __init__(self, sample: np.ndarray, centroids: int):
        self.dim = sample.shape[1]
        self.half = (self.dim + 1) // 2
        self.books = [kmeans(part, centroids) if part.shape[1] else np.zeros((1, 0)) for part in self.parts(sample)]
        self.shape = tuple(len(b) for b in self.books)
        self.sizes = np.bincount(self.cell(sample), minlength=self.shape[0] * self.shape[1])

    def parts(self, x: np.ndarray) -> list[np.ndarray]:
        return [x[:, : self.half], x[:, self.half :]]

    def cell(self, x: np.ndarray) -> np.ndarray:
        a, b = (nearest(p, c) for p, c in zip(self.parts(x), self.books, strict=True))
        return a * self.shape[1] + b

    def walk(self, query: np.ndarray) -> Iterator[int]:
        """Cells by rising summed dissimilarity: the multi-sequence walk over both halves' sorted centroids."""
        far = [-(c @ p[0]) for p, c in zip(self.parts(query[None]), self.books, strict=True)]
        order = [np.argsort(f, kind="stable") for f in far]
        u, v = (f[o].tolist() for f, o in zip(far, order, strict=True))
        a, b = (o.tolist() for o in order)
        heap, passed = [(u[0] + v[0], 0, 0)], [0] * len(u)  # passed[i]: pairs of row i already taken
        while heap:
            _, i, j = heapq.heappop(heap)
            yield a[i] * self.shape[1] + b[j]
            passed[i] = j + 1
            if j + 1 < len(v) and (i == 0 or passed[i - 1] > j + 1):
                heapq.heappush(heap, (u[i] + v[j + 1], i, j + 1))
            if i + 1 < len(u) and passed[i + 1] == j:
                heapq.heappush(heap, (u[i + 1] + v[j], i + 1, j))

    def share(self, sample: np.ndarray, k: int, recall: float, queries: int = 256) -> float:
        """Of all vectors, the share to pass so that ``recall`` of the exact neighbours in the sample are met."""
        cells, need = self.cell(sample), []
        for i in np.linspace(0, len(sample) - 1, min(queries, len(sample))).astype(int):
            score = sample @ sample[i]
            score[i] = -np.inf
            best = np.argsort(-score, kind="stable")[: min(k, len(sample) - 1)]
            order = np.fromiter(self.walk(sample[i]), dtype=np.int64)
            passed = np.empty(len(order))
            passed[order] = np.cumsum(self.sizes[order])
            need.append(passed[cells[best]])
        return float(np.quantile(np.concatenate(need), recall) / len(sample)) if need and len(sample) > 1 else 1.0


def usable(col) -> F.Column:
    """Vectors that take part: not null, some component not zero, every component a finite number."""
    return (
        col.isNotNull()
        & F.forall(col, lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf")))
        & F.exists(col, lambda v: v != 0)
    )


def matrix(column: pa.Array, dim: int) -> np.ndarray:
    """A list column as a matrix of doubles, without a Python object per number."""
    return np.asarray(column.flatten(), dtype=np.float64).reshape(-1, dim)


def search(
    vectors: DataFrame,
    is_query,
    k: int = 20,
    centroids: int = 32,
    recall: float = 0.97,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    sample_rows: int = SAMPLE_ROWS,
    group_rows: int = GROUP_ROWS,
    query_rows: int = QUERY_ROWS,
) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the ``k`` nearest found for each row where ``is_query`` (a column) holds.

    Nearness is the largest inner product, in double precision on the original vectors; ties go to the
    smaller id. A query's own id is no candidate. Vectors that are null, zero, or hold null or non-finite
    components take no part, nor do rows without an id or with a length other than the sample's usual one.
    Repeated rows are candidates each; a repeated query id is searched once. With few rows all are compared.
    An empty table gives no rows.
    """
    integer_ids(vectors, id_col)
    spark = vectors.sparkSession
    ship_code(spark)
    rows = vectors.select(
        vectors[id_col].cast("long").alias("vec_id"), vectors[vector_col].cast("array<double>").alias("v"), is_query.alias("is_query")
    ).where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    taken = rows.orderBy(F.xxhash64("vec_id"), "vec_id").limit(sample_rows).select("v").toArrow().column("v")
    out = "query_id long, rank int, vec_id long, score double"
    lens = np.asarray(pa.compute.list_value_length(taken))
    if not len(lens):
        return spark.createDataFrame([], out)
    dim = int(np.bincount(lens).argmax())
    sample = matrix(taken.filter(pa.array(lens == dim)).combine_chunks(), dim)
    index = MultiIndex(sample, centroids)
    fitted = spark.sparkContext.broadcast(index)

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = matrix(b.column("v"), dim)
            yield pa.RecordBatch.from_arrays(
                [b.column("vec_id"), pa.array([r.tobytes() for r in x], pa.binary()), b.column("is_query"), pa.array(fitted.value.cell(x), pa.int64())],
                names=["vec_id", "v", "is_query", "cell"],
            )

    placed = written(
        rows.where(F.size("v") == dim).mapInArrow(place, "vec_id long, v binary, is_query boolean, cell long"), "multi-index"
    )
    # the sizes of all cells: at most centroids x centroids rows
    counts = {r.cell: r.n for r in placed.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    total = sum(counts.values())
    enough = max(64 * k, int(np.ceil(index.share(sample, k, recall) * total)))
    index.sizes = np.array([counts.get(c, 0) for c in range(len(index.sizes))], dtype=np.int64)
    first, parts, group, held = [], [], 0, 0
    for n in index.sizes.tolist():  # small neighbours share a group, large cells have several
        if held + n > group_rows and held:
            group, held = group + 1, 0
        first.append(group)
        parts.append(max(1, -(-n // group_rows)))
        held += n
        if parts[-1] > 1:
            group, held = group + parts[-1], 0
    cells = spark.createDataFrame(list(zip(range(len(first)), first, parts, strict=True)), "cell long, first int, parts int")
    plan = spark.sparkContext.broadcast((index, np.array(first), np.array(parts), enough))

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ix, first, parts, enough = plan.value
        for b in batches:
            for q, v in zip(b.column("vec_id").to_pylist(), b.column("v").to_pylist(), strict=True):
                seen, passed = [], 0
                for c in ix.walk(np.frombuffer(v)):
                    if ix.sizes[c]:
                        seen.append(c)
                        passed += ix.sizes[c]
                    if passed > enough:
                        break
                seen = np.array(seen)
                where = np.unique(np.concatenate([first[seen] + p for p in range(parts[seen].max())]))
                where = [g for g in where.tolist() if np.any((first[seen] <= g) & (g < first[seen] + parts[seen]))]
                flags = np.zeros(len(first), dtype=bool)
                flags[seen] = True
                bits = np.packbits(flags).tobytes()
                yield pa.RecordBatch.from_arrays(
                    [pa.array([q] * len(where), pa.int64()), pa.array([v] * len(where), pa.binary()), pa.array([bits] * len(where), pa.binary()), pa.array(where, pa.int32())],
                    names=["query_id", "q", "cells", "grp"],
                )

    queries = placed.where("is_query").dropDuplicates(["vec_id"]).select("vec_id", "v")
    asked = queries.mapInArrow(route, "query_id long, q binary, cells binary, grp int")
    # a group meets its queries in blocks, so neither side of a task grows with the table
    blocks = max(1, -(-placed.where("is_query").count() // query_rows))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("query_id"), F.lit(blocks)))
    stored = placed.join(F.broadcast(cells), "cell").select(
        (F.col("first") + F.pmod(F.xxhash64("vec_id", "v"), F.col("parts"))).cast("int").alias("grp"), "cell", "vec_id", "v"
    ).withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(blocks - 1).cast("long"))))

    def rerank(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        none = np.zeros(0, dtype=np.int64)
        got: list[tuple] = [(none, none, none.astype(np.float64))]
        if len(left) and len(right):
            right = right.sort_values("vec_id", kind="stable")
            x = np.frombuffer(b"".join(right["v"]), dtype=np.float64).reshape(len(right), -1)
            ids, cell = right["vec_id"].to_numpy(), right["cell"].to_numpy()
            for a in range(0, len(left), 256):
                some = left.iloc[a : a + 256]
                q = np.frombuffer(b"".join(some["q"]), dtype=np.float64).reshape(len(some), -1)
                rough = q @ x.T
                flags = np.unpackbits(np.frombuffer(b"".join(some["cells"]), dtype=np.uint8).reshape(len(some), -1), axis=1).astype(bool)
                allowed = flags[:, cell] & (some["query_id"].to_numpy()[:, None] != ids)
                for i, query in enumerate(some["query_id"].tolist()):
                    at = np.flatnonzero(allowed[i])
                    if len(at) > k:  # a little more than the k best, as the product's last digits depend on its place
                        r = rough[i, at]
                        kth = np.partition(r, len(r) - k)[len(r) - k]
                        at = at[r >= kth - 1e-9 * max(1.0, abs(kth))]
                    exact = (x[at] * q[i]).sum(axis=1)
                    best = np.lexsort((ids[at], -exact))[:k]
                    got.append((np.full(len(best), query), ids[at[best]], exact[best]))
        return pd.DataFrame({c: np.concatenate(x) for c, x in zip(("query_id", "vec_id", "score"), zip(*got, strict=True), strict=True)})

    found = asked.groupBy("grp", "block").cogroup(stored.groupBy("grp", "block")).applyInPandas(rerank, "query_id long, vec_id long, score double")
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
