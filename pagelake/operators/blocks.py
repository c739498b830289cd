"""Exact cosine search over blocks of vectors that skips blocks (V6).

The store is written once as blocks of similar vectors, each with its centre and its radius, both on the unit sphere.
For a query q and a vector x of a block with centre c and radius r, q.x = q.c + q.(x - c) <= q.c + r (Cauchy-Schwarz).
A search first scores, for each query, the blocks with the highest bounds that together hold k vectors; their k-th best
score is a threshold. Then every block is scored for those queries alone whose threshold its bound reaches. Nothing
is left out: a skipped block holds no vector among the k best.

Queries are broadcast in batches of ``QUERIES``. Bounds need the narrow columns only; block rows are scored where they
are read, so a search shuffles nothing but hits.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.vectors import as_vector
from ..session import ship_code, written

#: Vectors of a block, centres of the clustering, and vectors that the centres are fitted on, at most.
BLOCK_ROWS, CENTRES, SAMPLE_ROWS = 1024, 256, 16_384
#: Queries broadcast at once, and queries scored against a block at once.
QUERIES, SLAB = 16_384, 4096
#: What rounding may add to a bound.
SLACK = 1e-9


def _matrix(column: pa.Array) -> np.ndarray:
    """A column of vectors of one length as a matrix, from its flat values."""
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(len(column), -1)


def _unit(x: np.ndarray) -> np.ndarray:
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _centres(x: np.ndarray, k: int, rounds: int = 8) -> np.ndarray:
    """Directions of at most ``k`` clusters of unit vectors."""
    c = x[np.linspace(0, len(x) - 1, min(k, len(x))).astype(int)]
    for _ in range(rounds):
        of = (x @ c.T).argmax(axis=1)
        sums = np.zeros_like(c)
        np.add.at(sums, of, x)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        c = np.where(size > 0, sums / np.where(size > 0, size, 1), c)
    return c


def build(store: DataFrame, id_col: str = "id", vec_col: str = "embedding", centres: int = CENTRES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The blocks of a store, written: ``block, dim, n, centre, radius, ids, vectors``.

    Vectors that can never be found (null, empty, zero, with a null or non-finite component) take no part. Vectors of several lengths
    are an error, as in ``cosine_topk``. A cluster with very many vectors is dealt to several tasks.
    """
    spark = store.sparkSession
    ship_code(spark)
    finite = F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = store.select(F.col(id_col).alias("id"), as_vector(vec_col).alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0))
    rows = written(rows.where(finite & F.exists("v", lambda x: x != 0)), "vectors")
    sizes = [r.n for r in rows.groupBy(F.size("v").alias("n")).count().limit(2).collect()]
    if len(sizes) > 1:
        raise ValueError(f"vectors of several lengths: {sorted(sizes)}")
    id_type = rows.schema["id"].dataType.simpleString()
    schema = f"block long, dim int, n long, centre binary, radius double, ids array<{id_type}>, vectors binary"
    if not sizes:
        return spark.createDataFrame([], schema)
    sample = rows.orderBy(F.xxhash64("id"), "id").limit(SAMPLE_ROWS).select("v").toArrow().column("v").combine_chunks()
    fitted = spark.sparkContext.broadcast(_centres(_unit(_matrix(sample)), centres))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                x = _matrix(b.column("v"))
                cell = (_unit(x) @ fitted.value.T).argmax(axis=1)
                yield pa.RecordBatch.from_arrays([b.column("id"), pa.array([r.tobytes() for r in x], pa.binary()), pa.array(cell)], names=["id", "v", "cell"])

    placed = written(rows.mapInArrow(place, f"id {id_type}, v binary, cell long"), "cells")
    # (a row for each centre)
    parts = placed.groupBy("cell").agg(F.ceil(F.count("*") / (16 * block_rows)).alias("parts"))
    dealt = placed.join(F.broadcast(parts), "cell").withColumn("part", F.pmod(F.xxhash64("id"), F.col("parts")))
    dealt = dealt.select("cell", "part", "id", "v").repartition("cell", "part").sortWithinPartitions("cell", "part", "id")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number, group, ids, vecs = TaskContext.get().partitionId() << 40, None, [], []

        def block():
            x = np.stack([np.frombuffer(v) for v in vecs])
            u = _unit(x)
            c = u.mean(axis=0)
            radius = float(np.sqrt(((u - c) ** 2).sum(axis=1)).max())
            cols = [[number], [x.shape[1]], [len(ids)], [c.tobytes()], [radius], [list(ids)], [x.tobytes()]]
            return pa.RecordBatch.from_arrays([pa.array(v, f.type) for v, f in zip(cols, fields, strict=True)], schema=fields)

        for b in batches:
            for cell, part, i, v in zip(*(b.column(c).to_pylist() for c in ("cell", "part", "id", "v")), strict=True):
                if vecs and ((cell, part) != group or len(vecs) == block_rows):
                    yield block()
                    number, ids, vecs = number + 1, [], []
                group = (cell, part)
                ids.append(i)
                vecs.append(v)
        if vecs:
            yield block()

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType

    fields = to_arrow_schema(StructType.fromDDL(schema))
    return written(dealt.mapInArrow(cut, schema), "blocks")


@dataclass
class Hits:
    """``hits``: qid, id, score, rank; and of how many (query, block) pairs how many were scored."""

    hits: DataFrame
    pairs: int
    scored: int


def search(
    blocks: DataFrame,
    queries: DataFrame,
    k: int = 5,
    qid_col: str = "qid",
    qvec_col: str = "qvec",
    score_digits: int = 12,
    queries_at_once: int = QUERIES,
) -> Hits:
    """The ``k`` stored vectors with the highest cosine above 0 for each query; ties by id. Scores are rounded first, so
    that equal vectors tie wherever they lie. Queries that are null, zero or not finite find nothing; a length other
    than the store's is an error."""
    if k <= 0:
        raise ValueError("k must be > 0")
    spark = blocks.sparkSession
    ship_code(spark)
    q = queries.select(F.col(qid_col).alias("qid"), as_vector(qvec_col).alias("v")).where(F.col("v").isNotNull() & (F.size("v") > 0))
    q = written(q, "queries")
    shares = max(1, -(-q.count() // queries_at_once))
    total, dim = blocks.agg(F.count("*"), F.max("dim")).first()
    parts = [_search(blocks, q.where(F.pmod(F.xxhash64("qid"), F.lit(shares)) == i), k, total, dim, score_digits) for i in range(shares)]
    found = reduce(DataFrame.unionByName, [p.hits for p in parts])
    return Hits(found, sum(p.pairs for p in parts), sum(p.scored for p in parts))


def _search(blocks: DataFrame, queries: DataFrame, k: int, total: int, dim: int | None, digits: int) -> Hits:
    spark = blocks.sparkSession
    table = queries.orderBy("qid").toArrow()  # (at most about ``queries_at_once`` rows)
    qids, vecs = table.column("qid").combine_chunks(), [np.array(v, dtype=np.float64) for v in table.column("v").to_pylist()]
    usable = [i for i, v in enumerate(vecs) if np.isfinite(v).all() and v.any()]
    if dim is not None and any(len(vecs[i]) != dim for i in usable):
        raise ValueError(f"a query's length is not the store's {dim}")
    out = f"qid {queries.schema['qid'].dataType.simpleString()}, id {blocks.schema['ids'].dataType.elementType.simpleString()}, score double, rank int"
    if not usable or not total:
        return Hits(spark.createDataFrame([], out), 0, 0)
    raw = np.stack([vecs[i] for i in usable])
    sent = spark.sparkContext.broadcast((raw, _unit(raw), np.linalg.norm(raw, axis=1)))
    narrow = blocks.select("block", "n", "centre", "radius")

    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Of a batch of blocks, for each query those with the highest bounds that hold k vectors."""
        for b in batches:
            if b.num_rows:
                n, number = b.column("n").to_numpy(), b.column("block").to_numpy()
                bound = _bounds(sent.value[1], b)
                order = np.argsort(-bound, axis=1, kind="stable")
                before = np.cumsum(n[order], axis=1) - n[order]
                who, at = np.nonzero(before < k)
                chosen = order[who, at]
                cols = [who, number[chosen], bound[who, chosen], n[chosen]]
                yield pa.RecordBatch.from_arrays([pa.array(c) for c in cols], names=["q", "block", "bound", "n"])

    near = narrow.mapInArrow(first, "q long, block long, bound double, n long")
    running = Window.partitionBy("q").orderBy(F.desc("bound"), "block").rowsBetween(Window.unboundedPreceding, -1)
    near = near.withColumn("before", F.coalesce(F.sum("n").over(running), F.lit(0))).where(F.col("before") < k)
    asked = near.groupBy("block").agg(F.collect_list("q").alias("qs"))  # (a block has at most the broadcast queries)

    slack = SLACK + 10.0**-digits

    def score(x: np.ndarray, some: np.ndarray) -> np.ndarray:
        s = sent.value[0][some] @ x.T
        s /= sent.value[2][some][:, None] * np.linalg.norm(x, axis=1)
        return s

    def kth(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for v, d, qs in zip(b.column("vectors").to_pylist(), b.column("dim").to_pylist(), b.column("qs").to_pylist(), strict=True):
                x = np.frombuffer(v).reshape(-1, d)
                for i in range(0, len(qs), SLAB):
                    some = np.array(qs[i : i + SLAB])
                    s, n = score(x, some), min(k, len(x))
                    best = np.round(np.partition(s, len(x) - n, axis=1)[:, len(x) - n :], digits)
                    yield pa.RecordBatch.from_arrays([pa.array(np.repeat(some, n)), pa.array(best.ravel())], names=["q", "score"])

    scores = blocks.select("block", "dim", "vectors").join(F.broadcast(asked), "block").mapInArrow(kth, "q long, score double")
    rank = F.row_number().over(Window.partitionBy("q").orderBy(F.desc("score")))
    least = np.zeros(len(usable))
    for r in scores.withColumn("rank", rank).where(F.col("rank") == k).collect():  # (a row for each query)
        least[r.q] = max(0.0, r.score)
    floor = spark.sparkContext.broadcast(least)

    def needed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pairs = sum(int((_bounds(sent.value[1], b) >= floor.value[:, None] - SLACK).sum()) for b in batches if b.num_rows)
        yield pa.RecordBatch.from_arrays([pa.array([pairs])], names=["pairs"])

    scored = narrow.mapInArrow(needed, "pairs long").agg(F.sum("pairs")).first()[0] or 0

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            reach = _bounds(sent.value[1], b) >= floor.value[:, None] - SLACK if b.num_rows else None
            for i in range(b.num_rows):
                reached = np.flatnonzero(reach[:, i])
                if not len(reached):
                    continue
                x = np.frombuffer(b.column("vectors")[i].as_buffer()).reshape(-1, b.column("dim")[i].as_py())
                for some in (reached[j : j + SLAB] for j in range(0, len(reached), SLAB)):
                    s = score(x, some)
                    # (only what reaches the query's threshold is sorted and sent)
                    who, at = np.nonzero(s >= floor.value[some][:, None] - slack)
                    found = np.round(s[who, at], digits)
                    keep = np.isfinite(found) & (found > 0)
                    who, at, found = who[keep], at[keep], found[keep]
                    # (ids ascend within a block, so the place breaks ties by id)
                    order = np.lexsort((at, -found, who))
                    order = order[np.arange(len(order)) - np.searchsorted(who, who[order]) < k]
                    ids = b.column("ids")[i].values.take(pa.array(at[order]))
                    yield pa.RecordBatch.from_arrays([pa.array(some[who[order]]), ids, pa.array(found[order])], names=["q", "id", "score"])

    kind = blocks.schema["ids"].dataType.elementType.simpleString()
    hits = blocks.select("block", "dim", "centre", "radius", "ids", "vectors").mapInArrow(best, f"q long, id {kind}, score double")
    order = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    hits = hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    names = spark.createDataFrame([(j, qids[i].as_py()) for j, i in enumerate(usable)], f"q long, {out.split(',')[0]}")
    hits = hits.join(F.broadcast(names), "q").select("qid", "id", "score", "rank")
    return Hits(hits, total * len(usable), int(scored))


def _bounds(unit: np.ndarray, blocks: pa.RecordBatch) -> np.ndarray:
    """The bound of each query on each block."""
    centre = np.frombuffer(b"".join(blocks.column("centre").to_pylist())).reshape(blocks.num_rows, -1)
    return unit @ centre.T + blocks.column("radius").to_numpy()
