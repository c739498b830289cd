"""Benchmark decontamination with suffix arrays over the training words.

The training documents are taken in shards of bounded size. Each shard gets a word-level suffix array
(prefix doubling), in which every test suffix is binary-searched: the suffixes of the array that begin with
the test suffix's window give the places of verbatim matches, and runs of places on one diagonal are the
longest matches. Documents with a match are affected.

Test sets are broadcast in blocks of bounded size; a larger test set takes more passes over the documents.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, byte_rows, id_text, id_type, slices, written

#: Fixed value: words are runs of ASCII letters, digits and non-ASCII characters, in lower case.
WORD = re.compile(rb"[0-9a-z\x80-\xff]+")
#: Words of a shard's suffix array.
SHARD_WORDS = 1 << 18
#: Pairs of a place and a start in an item that are looked at once.
PAIRS = 1 << 21
#: Bytes of test text broadcast at once.
BLOCK_BYTES = 16 << 20


def words_of(text: bytes | None) -> list[bytes]:
    return WORD.findall(text.lower()) if text else []


def suffix_array(words: np.ndarray, starts: np.ndarray, depth: int) -> np.ndarray:
    """Those of the suffixes ``starts`` of a shard, in the order of their first ``depth`` words (or more).

    ``words`` are ids; 0 ends a document and is smaller than any word. Prefix doubling: ranks of 2k words
    are the ranks of pairs of ranks of k words.
    """
    rank, k = words.astype(np.int64), 1
    while k < depth:
        second = np.zeros_like(rank)
        second[:-k] = rank[k:]
        key = rank * (int(rank.max(initial=0)) + 1) + second
        _, rank = np.unique(key, return_inverse=True)
        k *= 2
    return starts[np.argsort(rank[starts], kind="stable")]


class TestSet:
    """The test items of one block: ids of their words and the distinct windows."""

    __test__ = False

    def __init__(self, items: list[tuple[object, bytes | None]], window: int):
        texts = [(item, ws) for item, t in items if (ws := words_of(t))]
        self.word_id = {w: i for i, w in enumerate(sorted({w for _, ws in texts for w in ws}), 1)}
        self.items = [item for item, _ in texts]
        self.words = [np.array([self.word_id[w] for w in ws], dtype=np.int64) for _, ws in texts]
        found: dict[tuple, list[tuple[int, int]]] = {}
        for i, ws in enumerate(self.words):
            n = min(window, len(ws))
            for s in range(len(ws) - n + 1):
                found.setdefault(tuple(ws[s : s + n].tolist()), []).append((i, s))
        #: windows by length: a matrix of ids, and for each window the items that have it with its starts there
        self.windows = {}
        for n in sorted({len(w) for w in found}):
            some = [w for w in found if len(w) == n]
            self.windows[n] = (np.array(some, dtype=np.int64), [found[w] for w in some])
        size = np.array([len(ws) for ws in self.words], dtype=np.int64)
        #: the items' words one after the other, each with a word of no document (-1) before and after it
        self.first = np.cumsum(size + 1) - size
        self.flat = np.full(int((size + 1).sum()) + 1, -1, dtype=np.int64)
        for a, ws in zip(self.first, self.words, strict=True):
            self.flat[a : a + len(ws)] = ws
        self.depth = max(self.windows, default=1)
        self.least = min(self.windows, default=1)

    def places(self, words: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
        """(window length, places, number of the window at each place) in a shard's words."""
        usable = words > 0
        run = np.cumsum(usable)
        far = np.zeros(len(words), dtype=bool)
        if len(words) >= self.least:
            before = np.concatenate([[0], run])
            far[: len(words) - self.least + 1] = before[self.least :] - before[: len(before) - self.least] == self.least
        sa = suffix_array(words, np.flatnonzero(far), self.depth)
        padded = np.concatenate([words, np.zeros(self.depth, dtype=np.int64)])
        for n, (wanted, _) in self.windows.items():
            low, high = (_bound(padded, sa, wanted, right) for right in (False, True))
            size = high - low
            which = np.repeat(np.arange(len(wanted)), size)
            at = sa[np.repeat(low - np.cumsum(size) + size, size) + np.arange(size.sum())]
            yield n, at, which


def _bound(words: np.ndarray, sa: np.ndarray, wanted: np.ndarray, right: bool) -> np.ndarray:
    """For each wanted window, the first suffix that is not below it (``right``: that is above it)."""
    low, high = np.zeros(len(wanted), dtype=np.int64), np.full(len(wanted), len(sa), dtype=np.int64)
    while (open_ := np.flatnonzero(low < high)).size:
        mid = (low[open_] + high[open_]) // 2
        order = np.zeros(len(open_), dtype=np.int8)  # of the suffix against the window
        for j in range(wanted.shape[1]):
            a, b = words[sa[mid] + j], wanted[open_, j]
            order = np.where(order == 0, np.sign(a - b).astype(np.int8), order)
        below = order <= 0 if right else order < 0
        low[open_] = np.where(below, mid + 1, low[open_])
        high[open_] = np.where(below, high[open_], mid)
    return low


def _maximal(words: np.ndarray, test: TestSet, n: int, at: np.ndarray, which: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """(place, item, start in the item, words) of the matches that begin at ``at`` with the windows ``which`` of ``n`` words
    and are not part of a longer one. Places are paired with the starts of their windows in pieces of bounded size."""
    owners = test.windows[n][1]
    begins = np.cumsum([0, *map(len, owners)])
    flat = np.array([p for o in owners for p in o], dtype=np.int64).reshape(-1, 2)
    count = np.diff(begins)[which]
    ahead = np.concatenate([[0], np.cumsum(count)])
    cut = 0
    while cut < len(at):
        stop = max(cut + 1, int(np.searchsorted(ahead, ahead[cut] + PAIRS, side="right")) - 1)
        some = slice(cut, stop)
        k = np.repeat(begins[which[some]] - ahead[some] + ahead[cut], count[some]) + np.arange(ahead[stop] - ahead[cut])
        place, item, start = np.repeat(at[some], count[some]), flat[k, 0], flat[k, 1]
        # a word further left that agrees means that a longer match begins there
        here = test.first[item] + start
        left = (place > 0) & (words[place - 1] == test.flat[here - 1])
        place, item, start, here = place[~left], item[~left], start[~left], here[~left]
        length, on = np.full(len(place), n), np.arange(len(place))
        while len(on):
            on = on[words[place[on] + length[on]] == test.flat[here[on] + length[on]]]
            length[on] += 1
        yield place, item, start, length
        cut = stop


def shard_matches(docs: list[list[bytes]], test: TestSet, every: bool = False) -> list[tuple[list, list]]:
    """For each document (its words): hit spans (start, words), and (item, words, doc start, item start) of each
    matching item's longest match (the first one), or of every maximal match."""
    sizes = np.array([len(d) for d in docs], dtype=np.int64)
    begin = np.cumsum(sizes + 1) - sizes - 1
    words = np.zeros(int((sizes + 1).sum()) + 1, dtype=np.int64)
    ids = test.word_id
    for b, d in zip(begin, docs, strict=True):
        words[b : b + len(d)] = [ids.get(w, 0) for w in d]
    cover = np.zeros(len(words) + 1, dtype=np.int64)
    found = []
    for n, at, which in test.places(words):
        np.add.at(cover, at, 1)
        np.add.at(cover, at + n, -1)
        found += [np.stack(x) for x in _maximal(words, test, n, at, which)]
    hit = np.cumsum(cover)[:-1] > 0
    edge = np.flatnonzero(np.diff(np.concatenate([[0], hit.view(np.int8), [0]])))
    spans: list[list] = [[] for _ in docs]
    items: list[list] = [[] for _ in docs]
    of = np.searchsorted(begin, edge[::2], side="right") - 1
    for d, a, e in zip(of.tolist(), edge[::2].tolist(), edge[1::2].tolist(), strict=True):
        spans[d].append((a - int(begin[d]), e - a))
    if found:
        at, item, start, length = np.concatenate(found, axis=1)
        doc = np.searchsorted(begin, at, side="right") - 1
        order = np.lexsort((start, at, *([] if every else [-length]), item, doc))
        if not every:
            lead = np.ones(len(order), dtype=bool)
            lead[1:] = (np.diff(doc[order]) != 0) | (np.diff(item[order]) != 0)
            order = order[lead]
        for d, i, size, a, s in zip(*(x[order].tolist() for x in (doc, item, length, at, start)), strict=True):
            items[d].append((test.items[i], size, a - int(begin[d]), s))
    return list(zip(spans, items, strict=True))


def _joined(matches: list[tuple]) -> list[tuple]:
    """Matches found in parts of a document: those that overlap on one diagonal of an item are one match."""
    out: list[tuple] = []
    for item, n, at, start in sorted(matches, key=lambda m: (str(m[0]), m[2] - m[3], m[2])):
        if out and out[-1][0] == item and out[-1][2] - out[-1][3] == at - start and at <= out[-1][2] + out[-1][1]:
            out[-1] = (item, max(out[-1][1], at + n - out[-1][2]), *out[-1][2:])
        else:
            out.append((item, n, at, start))
    return sorted(out, key=lambda m: (str(m[0]), m[2], m[3]))


def _document_matches(texts: list[bytes | None], test: TestSet, shard_words: int = SHARD_WORDS) -> Iterator[tuple[int, list, list]]:
    """(words, hit spans, maximal matches) of each text. A document longer than a shard goes in overlapping parts."""
    group: list[tuple[list[bytes], int]] = []

    def flush():
        out = shard_matches([ws for ws, _ in group], test, every=True)
        got = [(n, s, i) for (_, n), (s, i) in zip(group, out, strict=True)]
        group.clear()
        return got

    held = 0
    for t in texts:
        ws = words_of(t)
        if len(ws) <= shard_words:
            if held + len(ws) > shard_words and group:
                yield from flush()
                held = 0
            group.append((ws, len(ws)))
            held += len(ws)
            continue
        if group:
            yield from flush()
        held, spans, matches = 0, [], []
        for a in range(0, len(ws), shard_words):
            s, items = shard_matches([ws[a : a + shard_words + test.depth - 1]], test, every=True)[0]
            for b, n in s:
                if spans and a + b <= spans[-1][0] + spans[-1][1]:
                    spans[-1] = (spans[-1][0], max(spans[-1][1], a + b + n - spans[-1][0]))
                else:
                    spans.append((a + b, n))
            matches += [(item, n, a + at, start) for item, n, at, start in items]
        yield len(ws), spans, _joined(matches)
    if group:
        yield from flush()


def find_contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    window: int = 10,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, spans (start, words: maximal runs of hit words) and items
    (item_id as string, words, doc_start, item_start: every maximal verbatim match of ``window`` words or more).

    A word is hit when it lies in an occurrence of ``window`` consecutive words of an item (of the whole item
    where it has fewer). Null and wordless texts have no words; items without words never match; a null
    item id is the string ``''``. Repeated rows each get their own row. An empty test set hits nothing.
    One task reads a document and answers for it: no shuffle, unless the test set takes several blocks.
    """
    source = id_text(docs, id_col, text_col)
    tests = benchmark.select(
        F.coalesce(benchmark[item_col].cast("string"), F.lit("")).alias("item"), benchmark[item_text_col].cast("string").alias("words")
    )
    total = tests.agg(F.sum(F.octet_length("words"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    sc = docs.sparkSession.sparkContext
    kind = id_type(docs, id_col)
    schema = f"doc_id {kind}, n_words long, spans array<struct<start:long,words:long>>, items array<struct<item_id:string,words:long,doc_start:long,item_start:long>>"

    def one(block: int) -> DataFrame:
        part = tests if blocks == 1 else tests.where(F.pmod(F.xxhash64("item", "words"), F.lit(blocks)) == block)
        fields = arrow_schema(schema)
        test = sc.broadcast([(r.item, r.words.encode()) for r in part.toLocalIterator() if r.words])

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            ready = TestSet(test.value, window)
            for whole in batches:
                for b in slices(whole, "text", 2 << 20):
                    out = list(_document_matches(byte_rows(b.column("text")), ready))
                    cols = [b.column("doc_id").to_pylist(), *zip(*out, strict=True)]
                    named = [
                        cols[0],
                        cols[1],
                        [[{"start": s, "words": n} for s, n in d] for d in cols[2]],
                        [[dict(zip(("item_id", "words", "doc_start", "item_start"), i, strict=True)) for i in d] for d in cols[3]],
                    ]
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(named, fields, strict=True)], schema=fields)

        return source.mapInArrow(run, schema)

    if blocks == 1:
        return one(0)
    # several passes: rows of one document meet again, told apart by a number that every pass gives alike
    source = written(source.withColumn("row", F.monotonically_increasing_id()), "decontam").select(
        F.struct("doc_id", "row").alias("doc_id"), "text"
    )
    kind = id_type(source)
    schema = schema.replace(schema.split(", n_words")[0], f"doc_id {kind}", 1)
    found = reduce(DataFrame.unionByName, [one(b) for b in range(blocks)])
    merged = found.groupBy("doc_id").agg(
        F.max("n_words").alias("n_words"), F.flatten(F.collect_list("spans")).alias("spans"), F.flatten(F.collect_list("items")).alias("items")
    )
    zero = "cast(array() as array<struct<start:long,words:long>>)"
    join = f"""aggregate(array_sort(spans), {zero}, (out, x) ->
        if(size(out) > 0 and element_at(out, -1).start + element_at(out, -1).words >= x.start,
           concat(slice(out, 1, size(out) - 1), array(named_struct('start', element_at(out, -1).start, 'words',
               greatest(element_at(out, -1).words, x.start + x.words - element_at(out, -1).start)))),
           concat(out, array(x))))"""
    return merged.select("doc_id.doc_id", "n_words", F.expr(join).alias("spans"), "items")


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", **names) -> DataFrame:
    """The rows of ``docs`` without a match in ``benchmark``; all columns are kept.

    Rows whose id is null, or whose text is, stay. Repeated rows of one id go when any of them is affected.
    """
    bad = find_contamination(docs, benchmark, window, id_col=id_col, **names).where(F.size("spans") > 0)
    bad = bad.select(F.col("doc_id").alias("__bad_doc")).distinct()
    return docs.join(bad, docs[id_col] == bad["__bad_doc"], "left_anti")


def digest(found: DataFrame) -> DataFrame:
    """The digest columns of ``find_contamination``."""
    items = F.array_sort(F.array_distinct(F.transform("items", lambda x: x["item_id"])))
    hit = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["words"])
    return found.select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size(items).cast("long").alias("n_items"),
        F.sha2(F.concat_ws(",", items).cast("binary"), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )
