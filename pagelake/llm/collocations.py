"""Phrase collocation mining by best-first branch-and-bound growth.

Phrases grow word by word from their prefixes. A phrase is never more frequent than any part of it, so only
frequent phrases are grown, and a prefix bounds the scores of everything that grows from it: if ``xyz`` occurs a
times, the score for the cut after x is a*a / (f(x) * f(yz)) with a <= f(yz) and a <= f(xy), so at most
f(xy) / f(x); for the cut after xy it is at most f(yz) / f(z).

1. Words are counted, and pairs of frequent words. The pairs are the frontier, with exact scores of their own.
2. Each language has a threshold, first the score of about its ``2 * top``-th best pair. Only three-word phrases
   whose prefix and suffix are bounded at or above the threshold are counted, together with those that hold a
   pair at or above it (they decide whether that pair survives).
3. All phrases at or above the threshold are then settled, ties included. A language that has ``top`` survivors
   among them is done. For the others the threshold goes down to the next part of the frontier, at last to zero.

Counting is a pass of the tasks over the texts: words are numbered by numpy within a slice of text, and counted
phrases are summed by Spark. What the passes must know of the frontier is a table of flags by hash, at most
``SLOTS`` bytes: a collision only has a phrase counted in vain. Scores are exact (decimals).
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pagelake.session import ship_code

from .common import slices, written
from .wordruns import coded, flat, runs

# What separates pieces, and what separates words within them
PIECES, BLANKS = b".,;:!?\n\x0b\x0c\r", b" \t"
CUT = np.zeros(256, dtype=bool)
CUT[list(PIECES)] = True
WORD = ~CUT
WORD[list(BLANKS)] = False
#: Most bytes of a table of flags; a power of two.
SLOTS = 1 << 25
#: Flags of words and pairs: frequent; may begin a phrase at the threshold; may end one; is itself at the threshold.
FREQUENT, BEGINS, ENDS, SCORED = 1, 2, 4, 8
#: Bytes of text whose words are numbered at once.
SLICE = 2 << 20
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hashes(words: pa.Array) -> np.ndarray:
    return np.fromiter((xxhash.xxh64_intdigest(w) for w in words.to_pylist()), dtype=np.uint64, count=len(words))


def _join(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A hash of two hashes, in this order."""
    x = (a ^ (b * _MIX)) + _MIX
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(29))


class Words:
    """The words of a slice in order: language, number, hash, and whether the next one follows in the same piece."""

    def __init__(self, texts: pa.Array, langs: pa.Array):
        data, begins = flat(texts)
        starts, ends = runs(data, begins, WORD)
        self.code, self.words = coded(data, starts, ends, WORD)
        lang = langs.dictionary_encode()
        self.langs = lang.dictionary.cast(pa.string())
        row = np.searchsorted(begins, starts, side="right") - 1
        self.lang = lang.indices.to_numpy(zero_copy_only=False).astype(np.int64)[row] if len(starts) else np.zeros(0, dtype=np.int64)
        cuts = np.concatenate([[0], np.cumsum(CUT[data])])
        self.linked = np.zeros(len(starts), dtype=bool)
        self.linked[:-1] = (cuts[starts[1:]] == cuts[ends[:-1]]) & (row[1:] == row[:-1])

    def hash(self) -> np.ndarray:
        """For each word, the hash of its language and itself."""
        return _join(_hashes(self.langs.cast(pa.binary()))[self.lang], _hashes(self.words)[self.code]) if len(self.code) else np.zeros(0, dtype=np.uint64)

    def rows(self, key: np.ndarray, at: np.ndarray, length: int) -> Iterator[pa.RecordBatch]:
        """(lang, w1.., n) of the distinct keys of the phrases of ``length`` words that begin at ``at``."""
        _, first, n = np.unique(key, return_index=True, return_counts=True)
        at = at[first]
        words = self.words.cast(pa.large_string())
        for a in range(0, len(at), 1 << 16):
            some = at[a : a + (1 << 16)]
            cols = [self.langs.take(pa.array(self.lang[some]))]
            cols += [words.take(pa.array(self.code[some + j])).cast(pa.string()) for j in range(length)]
            names = ["lang", *[f"w{j + 1}" for j in range(length)], "n"]
            yield pa.RecordBatch.from_arrays([*cols, pa.array(n[a : a + (1 << 16)])], names=names)


def _counted(texts: DataFrame, length: int, wanted) -> DataFrame:
    """Sums of what ``wanted`` (words of a slice -> keys, places) has each slice count: lang, w1.., n."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", SLICE, "collocations"):
                words = Words(b.column("text"), b.column("lang"))
                key, at = wanted(words)
                yield from words.rows(key, at, length)

    names = [f"w{j + 1}" for j in range(length)]
    found = texts.mapInArrow(run, "lang string, " + ", ".join(f"{w} string" for w in names) + ", n long")
    if length > 1:  # a slice repeats hardly any: they are summed where they meet, not also before they are sent
        found = found.repartition("lang", *names)
    return found.groupBy("lang", *names).agg(F.sum("n").alias("n"))


def _flag_table(flags: DataFrame, words: list[str], count: int) -> np.ndarray:
    """The flags (column flag) of all words or pairs by the hash of lang and ``words``, in a table of bounded size."""
    size = 1 << 16
    while size < min(SLOTS, 32 * count):
        size *= 2

    def slot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                lang = _hashes(b.column("lang").cast(pa.string()).cast(pa.binary()))
                h = [_join(lang, _hashes(b.column(w).cast(pa.string()).cast(pa.binary()))) for w in words]
                h = h[0] if len(h) == 1 else _join(h[0], h[1])
                at = (h & np.uint64(size - 1)).astype(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(at), b.column("flag")], names=["slot", "flag"])

    def part(rows: pd.DataFrame) -> pd.DataFrame:
        table = np.zeros(1 << 16, dtype=np.uint8)
        table[rows["slot"].to_numpy() & 0xFFFF] = rows["flag"].to_numpy()
        return pd.DataFrame({"part": [int(rows["slot"].iloc[0]) >> 16], "flags": [table.tobytes()]})

    slots = flags.select("lang", *words, "flag").mapInArrow(slot, "slot long, flag int").groupBy("slot").agg(F.bit_or("flag").alias("flag"))
    parts = slots.groupBy(F.shiftright("slot", 16)).applyInPandas(part, "part long, flags binary").collect()
    table = np.zeros(size, dtype=np.uint8)
    for r in parts:  # (together ``size`` bytes at most)
        table[r.part << 16 : (r.part + 1) << 16] = np.frombuffer(r.flags, dtype=np.uint8)
    return table


def _score(a: str, left: str, right: str) -> F.Column:
    """floor(1000000 * a * a / (left * right)), exactly."""
    a, left, right = (f"cast({x} as decimal(14, 0))" for x in (a, left, right))
    return F.expr(f"((cast(1000000 as decimal(7, 0)) * ({a} * {a})) div ({left} * {right}))")


def mine(
    docs: DataFrame, top: int = 2000, least: int = 10, held_percent: int = 50, text_col: str = "text", lang_col: str = "lang"
) -> DataFrame:
    """lang, rank (from 1), phrase, a, l, r, n, score: the ``top`` best phrases of two or three words of each language.

    A phrase occurs at least ``least`` times (a); l and r are the counts of the parts at its lowest-scoring cut
    (the first of equal ones), n counts the language's words. A pair goes where a phrase of three words that
    holds it has at least ``held_percent`` of its occurrences. By score, then a (both descending), then the
    phrase. A null text is empty, a null language is ``und``; rows count as often as they occur; columns other
    than the text and the language take no part. Languages without such a phrase have no row.
    """
    spark = docs.sparkSession
    ship_code(spark)
    lang = F.coalesce(docs[lang_col].cast("string"), F.lit("und")).alias("lang")
    texts = docs.select(docs[text_col].cast("string").alias("text"), lang)

    def all_words(w: Words):
        return w.lang * max(len(w.words), 1) + w.code, np.arange(len(w.code))

    words = written(_counted(texts, 1, all_words), "words")
    frequent = words.where(F.col("n") >= least)
    number = frequent.count()
    known = spark.sparkContext.broadcast(_flag_table(frequent.withColumn("flag", F.lit(FREQUENT)), ["w1"], number))

    def frequent_pairs(w: Words):
        table = known.value
        kept = table[(w.hash() & np.uint64(len(table) - 1)).astype(np.int64)] > 0
        at = np.flatnonzero(w.linked[:-1] & kept[:-1] & kept[1:]) if len(kept) else np.zeros(0, dtype=np.int64)
        size = max(len(w.words), 1)
        return (w.lang[at] * size + w.code[at]) * size + w.code[at + 1], at

    pairs = _counted(texts, 2, frequent_pairs).where(F.col("n") >= least).withColumnRenamed("n", "a")
    pairs = pairs.join(frequent.select("lang", "w1", F.col("n").alias("l")), ["lang", "w1"])
    pairs = pairs.join(frequent.select("lang", F.col("w1").alias("w2"), F.col("n").alias("r")), ["lang", "w2"])
    pairs = written(pairs.withColumn("score", _score("a", "l", "r")), "pairs")
    total = words.groupBy("lang").agg(F.sum("n").alias("n"))

    # how many pairs each language has by score, in steps of a quarter of a power of two (a few dozen rows for each)
    step = F.floor(4 * F.log2(F.col("score") + 1)).cast("int")
    steps: dict[str, list] = {}
    for r in pairs.groupBy("lang", step.alias("step")).agg(F.count("*").alias("pairs")).orderBy("lang", F.desc("step")).collect():
        steps.setdefault(r.lang, []).append((r.step, r.pairs))

    settled, reach = [], 2 * top
    while steps:
        limit = {k: _limit(v, reach) for k, v in steps.items()}
        best = written(_round(texts, pairs, limit, least, held_percent).transform(_best, top), "phrases")
        size = {r.lang: r["count"] for r in best.groupBy("lang").count().collect()}
        over = [k for k in steps if limit[k] == 0 or size.get(k, 0) >= top]
        settled.append(best.where(F.col("lang").isin(over)))
        steps, reach = {k: v for k, v in steps.items() if k not in over}, reach * 4
    if not settled:
        return pairs.limit(0).selectExpr("lang", "0L as rank", "w1 as phrase", "a", "l", "r", "0L as n", "score")
    found = reduce(DataFrame.unionByName, settled).join(total, "lang")
    return found.select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def _limit(steps: list[tuple[int, int]], reach: int) -> int:
    """The score at the lower end of the step in which a language's pairs, best first, are ``reach``; 0 if they are fewer."""
    for step, pairs in steps:
        reach -= pairs
        if reach <= 0:
            return max(0, math.floor(2 ** (step / 4)) - 1)
    return 0


def _best(phrases: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return phrases.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)


def _round(texts: DataFrame, pairs: DataFrame, limit: dict[str, int], least: int, held_percent: int) -> DataFrame:
    """The surviving phrases at or above each language's score ``limit``: lang, phrase, a, l, r, score."""
    spark = texts.sparkSession
    limits = spark.createDataFrame(list(limit.items()), "lang string, least_score long")  # (a row for each language)
    pairs = pairs.join(F.broadcast(limits), "lang")

    def within(part: str, a: str = "a") -> F.Column:
        return F.col(a) * 1_000_000 >= F.col("least_score") * F.col(part)

    held = F.lit(FREQUENT)
    for flag, holds in ((BEGINS, within("l")), (ENDS, within("r")), (SCORED, F.col("score") >= F.col("least_score"))):
        held = held + F.when(holds, flag).otherwise(0)
    known = spark.sparkContext.broadcast(_flag_table(pairs.withColumn("flag", held), ["w1", "w2"], pairs.count()))

    def grown(w: Words):
        """Phrases of three words whose two pairs let them grow."""
        if len(w.code) < 3:
            return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
        table, h = known.value, w.hash()
        flags = np.where(w.linked[:-1], table[(_join(h[:-1], h[1:]) & np.uint64(len(table) - 1)).astype(np.int64)], 0)
        first, second = flags[:-1], flags[1:]
        bounded = (first & BEGINS > 0) & (second & ENDS > 0)
        holding = (first > 0) & (second > 0) & ((first | second) & SCORED > 0)
        at = np.flatnonzero(bounded | holding)
        size = len(w.words)
        pair = (w.lang[at] * size + w.code[at]) * size + w.code[at + 1]
        _, number = np.unique(pair, return_inverse=True)
        return number * size + w.code[at + 2], at

    triples = _counted(texts, 3, grown).where(F.col("n") >= least).withColumnRenamed("n", "a")
    first = pairs.select("lang", "w1", "w2", F.col("a").alias("xy"), F.col("l").alias("x"), "least_score")
    second = pairs.select("lang", F.col("w1").alias("w2"), F.col("w2").alias("w3"), F.col("a").alias("yz"), F.col("r").alias("z"))
    triples = written(triples.join(first, ["lang", "w1", "w2"]).join(second, ["lang", "w2", "w3"]), "triples")

    cuts = triples.withColumn("s1", _score("a", "x", "yz")).withColumn("s2", _score("a", "xy", "z"))
    later = F.col("s2") < F.col("s1")
    three = cuts.select(
        "lang",
        F.concat_ws(" ", "w1", "w2", "w3").alias("phrase"),
        "a",
        F.when(later, F.col("xy")).otherwise(F.col("x")).alias("l"),
        F.when(later, F.col("z")).otherwise(F.col("yz")).alias("r"),
        F.least("s1", "s2").alias("score"),
        "least_score",
    )
    inside = triples.select("lang", "w1", "w2", "a").union(triples.select("lang", "w2", "w3", "a"))
    longer = inside.groupBy("lang", "w1", "w2").agg(F.max("a").alias("longer"))
    two = pairs.where(F.col("score") >= F.col("least_score")).join(longer, ["lang", "w1", "w2"], "left")
    two = two.where(F.coalesce(F.col("longer") * 100 < F.col("a") * held_percent, F.lit(True)))
    two = two.select("lang", F.concat_ws(" ", "w1", "w2").alias("phrase"), "a", "l", "r", "score", "least_score")
    return two.union(three).where(F.col("score") >= F.col("least_score")).drop("least_score")
