"""Ranked lexical search with hashed max-sketches.

The impact of a term in a document depends on its occurrences and on the document's length. Every document's
impacts are folded into a sketch: each term falls into one of ``buckets`` coordinates by a hash, and a
coordinate holds the largest impact that fell there. A batch of queries looks its terms up in the sketches of a
block of documents: the looked-up maxima, times the terms' weights, add up to an upper bound of the score. The
documents are then scored exactly in descending order of their bounds, until a bound is below the score of the
k-th best document found so far. A task carries that threshold through all its documents, so the bounds soon
leave few documents to score; what it returns is its k best for each query, and the k best of all tasks are
the result.

The weights come from counts over all documents. Only the counts of the queries' terms reach the driver. The
queries are broadcast in blocks of bounded size; a larger set of queries takes more passes.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_schema, id_text, id_type, slices, written
from .wordruns import coded, flat, runs

#: Fixed value: bytes of a term are digits, letters (A-Z lower-cased) and all bytes of other characters.
TERM = np.ones(256, dtype=bool)
for _a, _b in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    TERM[_a : _b + 1] = False
#: Coordinates of a sketch.
BUCKETS = 1024
#: Documents whose sketches are held at once, and query terms looked up at once.
BLOCK_DOCS, BLOCK_TERMS = 512, 2048
#: Bytes of query text broadcast at once.
BLOCK_BYTES = 4 << 20


def terms_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray, pa.Array]:
    """For the terms of a column's texts, in order: the row, the number of the distinct term; and the distinct terms."""
    data, begins = flat(column)
    starts, ends = runs(data, begins, TERM)
    codes, distinct = coded(data, starts, ends, TERM)
    return np.searchsorted(begins, starts, side="right") - 1, codes, distinct


def bucket(terms: pa.Array, buckets: int) -> np.ndarray:
    return np.fromiter((zlib.crc32(t) % buckets for t in terms.to_pylist()), dtype=np.int64, count=len(terms))


class Queries:
    """The items of one block: their distinct terms, and for each item its terms with their number of repeats."""

    def __init__(self, items: list[tuple[int, bytes]]):
        self.numbers = [n for n, _ in items]
        row, code, distinct = terms_of(pa.array([t for _, t in items], pa.binary()).cast(pa.string()))
        self.terms = distinct
        each: list[Counter] = [Counter() for _ in items]
        for r, c in zip(row.tolist(), code.tolist(), strict=True):
            each[r][c] += 1
        self.size = np.array([len(c) for c in each], dtype=np.int64)
        self.begin = np.concatenate([[0], np.cumsum(self.size)])
        self.term = np.array([t for c in each for t in c], dtype=np.int64)
        self.repeats = np.array([k for c in each for k in c.values()], dtype=np.int64)


def weights(df: np.ndarray, documents: int) -> np.ndarray:
    return np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * d + 1))) for d in df.tolist()], dtype=np.int64)


class Best:
    """The k best documents of each query among those offered so far."""

    def __init__(self, queries: int, k: int):
        self.k = k
        self.found: list[list[tuple]] = [[] for _ in range(queries)]
        #: a document with a smaller score is not among the best
        self.least = np.ones(queries, dtype=np.int64)

    def offer(self, query: int, scores: list[int], ids: list) -> None:
        some = [(-s, i is None, 0 if i is None else i, i) for s, i in zip(scores, ids, strict=True) if s >= self.least[query]]
        if some:
            best = sorted(self.found[query] + some, key=lambda x: x[:3])[: self.k]
            self.found[query] = best
            if len(best) == self.k:
                self.least[query] = -best[-1][0]


class Searcher:
    """Bounds and exact scores for blocks of documents."""

    def __init__(self, queries: Queries, weight: np.ndarray, documents: int, terms: int, k: int, buckets: int):
        self.q, self.documents, self.total, self.k, self.buckets = queries, documents, max(terms, 1), k, buckets
        self.weight = weight[queries.term] * queries.repeats if len(queries.term) else np.zeros(0, dtype=np.int64)
        self.at = bucket(queries.terms, buckets)[queries.term] if len(queries.term) else np.zeros(0, dtype=np.int64)
        self.owner = np.repeat(np.arange(len(queries.size)), queries.size)
        self.best = Best(len(queries.size), k)
        #: documents scored exactly, of all (document, query) pairs
        self.scored = 0

    def search(self, column: pa.Array, ids: list) -> None:
        row, code, distinct = terms_of(column)
        length = np.bincount(row, minlength=len(ids))
        # (exact: the product may pass 64 bits)
        m = np.array([100 - 75 + 75 * n * self.documents // self.total for n in length.tolist()], dtype=np.int64)
        pair, tf = np.unique(row * max(len(distinct), 1) + code, return_counts=True)
        row, code = np.divmod(pair, max(len(distinct), 1))
        impact = (1_000_000_000 * tf.astype(np.int64)) // (1000 * tf + 8 * m[row])
        place = bucket(distinct, self.buckets)[code]
        known = pc.index_in(distinct, value_set=self.q.terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[code]
        cuts = np.searchsorted(row, np.arange(0, len(ids) + BLOCK_DOCS, BLOCK_DOCS))
        for b, (x, y) in enumerate(zip(cuts, cuts[1:], strict=False)):
            if x < y:
                first = b * BLOCK_DOCS
                self._block(row[x:y] - first, place[x:y], known[x:y], impact[x:y], ids[first : first + BLOCK_DOCS])

    def _block(self, row: np.ndarray, place: np.ndarray, known: np.ndarray, impact: np.ndarray, ids: list) -> None:
        sketch = np.zeros((self.buckets, len(ids)), dtype=np.int64)
        np.maximum.at(sketch, (place, row), impact)
        bound = np.zeros((len(self.q.size), len(ids)), dtype=np.int64)
        for a in range(0, len(self.at), BLOCK_TERMS):
            some = slice(a, a + BLOCK_TERMS)
            owner = self.owner[some]
            begins = np.concatenate([[0], np.flatnonzero(np.diff(owner)) + 1])
            bound[owner[begins]] += np.add.reduceat(sketch[self.at[some]] * self.weight[some, None], begins, axis=0)
        asked = known >= 0
        keys = row[asked] * (len(self.q.terms) + 1) + known[asked]
        order = np.argsort(keys)
        keys, impact = keys[order], impact[asked][order]
        for query in np.flatnonzero((bound >= self.best.least[:, None]).any(axis=1)):
            self._rescore(int(query), bound[query], keys, impact, ids)

    def _rescore(self, query: int, bound: np.ndarray, keys: np.ndarray, impact: np.ndarray, ids: list) -> None:
        """Exact scores in descending order of the bounds, until they are below the k-th best score."""
        some = slice(self.q.begin[query], self.q.begin[query + 1])
        term, weight = self.q.term[some], self.weight[some]
        todo = np.flatnonzero(bound >= self.best.least[query])
        todo = todo[np.argsort(-bound[todo], kind="stable")]
        while todo.size and bound[todo[0]] >= self.best.least[query]:
            now, todo = todo[: 2 * self.k], todo[2 * self.k :]
            now = now[bound[now] >= self.best.least[query]]
            wanted = now[:, None] * (len(self.q.terms) + 1) + term
            at = np.minimum(np.searchsorted(keys, wanted), len(keys) - 1)
            score = (np.where(keys[at] == wanted, impact[at], 0) * weight).sum(axis=1) if len(keys) else np.zeros(len(now), dtype=np.int64)
            self.scored += len(now)
            self.best.offer(query, score.tolist(), [ids[i] for i in now])


def rank_documents(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    buckets: int = BUCKETS,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """item_id, rank (from 1), doc_id, score: the k highest-scoring documents of each item, scores above 0 only.

    Equal scores by ascending id, a null id last; rows that repeat an id are documents of their own. A null or
    wordless text has no term: such documents are not counted and not found, such items find nothing. Items
    that repeat an id each get their own ranks. Columns other than the id and the text take no part. Weights
    are never negative, so a bound is never below the score.
    """
    source = id_text(docs, id_col, text_col)
    spark = docs.sparkSession
    kind = id_type(docs, id_col)
    asked = items.select(F.monotonically_increasing_id().alias("item"), items[item_col].alias("item_id"), items[item_text_col].cast("string").alias("words"))
    asked = written(asked, "items")
    size = asked.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = max(1, -(-size // block_bytes))
    found = reduce(DataFrame.unionByName, [_one_block(source, asked, F.pmod(F.xxhash64("item"), F.lit(blocks)) == b, kind, k, buckets) for b in range(blocks)])
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.join(asked.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")


def _one_block(source: DataFrame, asked: DataFrame, of: Column, kind: str, k: int, buckets: int) -> DataFrame:
    sc = source.sparkSession.sparkContext
    queries = sc.broadcast(Queries([(r.item, r.words.encode()) for r in asked.where(of).toLocalIterator() if r.words]))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Documents, terms, and the documents with each of the queries' terms, of one task."""
        terms = queries.value.terms
        n = np.zeros(2 + len(terms), dtype=np.int64)
        for whole in batches:
            for b in slices(whole, "text", 4 << 20, "ranking"):
                row, code, distinct = terms_of(b.column("text"))
                n[0] += len(np.unique(row))
                n[1] += len(row)
                known = pc.index_in(distinct, value_set=terms).fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)[code]
                pair = np.unique(row[known >= 0] * max(len(terms), 1) + known[known >= 0])
                n[2:] += np.bincount(pair % max(len(terms), 1), minlength=len(terms))[: len(terms)]
        some = np.flatnonzero(n)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(n[some])], names=["key", "n"])

    counts = source.select("text").mapInArrow(count, "key long, n long").groupBy("key").agg(F.sum("n").alias("n")).collect()
    total = np.zeros(2 + len(queries.value.terms), dtype=np.int64)
    for r in counts:  # (as many rows as the block has distinct terms)
        total[r.key] = r.n
    documents, terms = int(total[0]), int(total[1])
    weight = sc.broadcast(weights(total[2:], documents))
    schema = f"item long, doc_id {kind}, score long"
    fields = arrow_schema(schema)

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        s = Searcher(queries.value, weight.value, documents, terms, k, buckets)
        for whole in batches:
            for b in slices(whole, "text", 4 << 20, "ranking"):
                s.search(b.column("text"), b.column("doc_id").to_pylist())
        rows = [(n, x[3], -x[0]) for n, best in zip(s.q.numbers, s.best.found, strict=True) for x in best]
        cols = list(zip(*rows, strict=True)) if rows else [[]] * 3
        yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, fields, strict=True)], schema=fields)

    return source.mapInArrow(search, schema)
