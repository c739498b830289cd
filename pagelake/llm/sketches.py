"""Document fingerprints by threshold-scaled sketches.

A document is the set of its shingles of five words. Each shingle has a hash of 31 bits, and the sketch keeps
every hash below a fixed fraction (1/``scale``) of their range. So the sketch grows with the document, and the
sketches of a short and of a very long document are samples of the same hashes: what is common to two
sketches estimates what is common to the documents, whatever their sizes. A set of which no hash is that
small keeps its smallest one, so only a text without words has an empty sketch.

Sketches merge: ``merged`` of two sketches is the sketch of the union of both sets.

Words are lower-cased runs without white space; a character of a script that is written without spaces is a
word of its own. A text of fewer than five words is one shingle. Column expressions only: no Python in tasks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import written

SHINGLE = 5
SCALE = 4
#: Bits of a hash.
BITS = 31
#: Ranges of scripts written without spaces (Thai, Lao, Myanmar, Khmer, kana, Han).
UNSPACED = r"\x{0E00}-\x{0EFF}\x{1000}-\x{109F}\x{1780}-\x{17FF}\x{3040}-\x{30FF}\x{3400}-\x{4DBF}\x{4E00}-\x{9FFF}\x{F900}-\x{FAFF}\x{20000}-\x{3FFFF}"
WORD = rf"[{UNSPACED}]|[^\s\p{{Z}}{UNSPACED}]+"


def _let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is computed once, however often the body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _kept(hashes: Column, scale: int) -> Column:
    low = _let(
        F.filter(hashes, lambda h: h < (1 << BITS) // scale),
        lambda some: F.when((F.size(some) > 0) | (F.size(hashes) == 0), some).otherwise(F.array(F.array_min(hashes))),
    )
    return F.array_sort(F.array_distinct(low))


def sketch(text: Column, scale: int = SCALE, shingle: int = SHINGLE) -> Column:
    """The sorted hashes kept of a text (array of ints); empty for a null text or one without words."""

    def hashes(words: Column) -> Column:
        places = F.sequence(F.lit(0), F.greatest(F.size(words) - shingle, F.lit(0)))
        # words beyond the end are null and leave the hash as it is
        each = F.transform(places, lambda i: F.shiftrightunsigned(F.xxhash64(*[F.get(words, i + j) for j in range(shingle)]), 64 - BITS).cast("int"))
        return F.when(F.size(words) > 0, each).otherwise(F.array().cast("array<int>"))

    words = F.regexp_extract_all(F.lower(F.coalesce(text, F.lit(""))), F.lit(WORD), F.lit(0))
    return _let(_let(words, hashes), lambda h: _kept(h, scale))


def merged(a: Column, b: Column, scale: int = SCALE) -> Column:
    """The sketch of the union of two sets, from their sketches."""
    return _kept(F.array_union(a, b), scale)


def containment(a: Column, b: Column) -> Column:
    """Estimated share of the first set that is in the second; 1 for an empty first set."""
    return F.when(F.size(a) == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / F.size(a))


def likeness(a: Column, b: Column) -> Column:
    """Estimated share of the smaller set that is in the larger one; two empty sets are alike, one is not."""
    least = F.least(F.size(a), F.size(b))
    return (
        F.when(least > 0, F.size(F.array_intersect(a, b)) / least)
        .when(F.size(a) == F.size(b), 1.0)
        .otherwise(0.0)
    )


def resemblance(a: Column, b: Column) -> Column:
    """Estimated share of both sets that they have in common."""
    both = F.size(F.array_union(a, b))
    return F.when(both > 0, F.size(F.array_intersect(a, b)) / both).otherwise(1.0)


def as_text(hashes: Column) -> Column:
    """A sketch as text: its hashes in ascending order, four bytes each, in base 64."""
    digits = F.transform(hashes, lambda h: F.lpad(F.hex(h), 8, "0"))
    return F.translate(F.base64(F.unhex(F.array_join(digits, ""))), "\r\n", "")  # without the line ends of MIME


def _positions(rows: DataFrame, order: list[str]) -> tuple[DataFrame, int]:
    """``rows`` with their position (from 0) in the order of some columns, and their number.

    The rows are sorted by ranges and written, each with its range and its place there; the offsets of the
    ranges, as many as partitions, are added afterwards.
    """
    place = F.monotonically_increasing_id()  # the number of the partition, then that of the row in 33 bits
    placed = written(rows.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("place", place), "order")
    ranges = placed.groupBy(F.shiftright("place", 33).alias("part")).agg(F.count("*").alias("size"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = ranges.select("part", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("offset"))
    total = ranges.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    inside = F.col("place").bitwiseAND((1 << 33) - 1)
    with_offset = placed.join(F.broadcast(offsets), F.shiftright("place", 33) == F.col("part"))
    return with_offset.select(*rows.columns, (F.col("offset") + inside).alias("pos")), total


def fingerprint_documents(docs: DataFrame, scale: int = SCALE, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next,
    jaccard_edited, jaccard_next, sketch_size, next_id.

    The edited text has the last floor(n_chars/4) characters replaced by the first as many (or all) of the
    next document by ascending id; the last one is followed by the first, a single one by itself. Null ids come
    first; rows that repeat an id follow each other by a hash of their text, and equal rows are each other's
    next. A null text is empty. Other columns take no part. near_*: ``likeness``; jaccard_*: ``resemblance``.

    The texts are written once with a number of their own, so ids need not be unique; the order is found on
    narrow rows. The texts are shuffled once, by that number: there each learns how many characters the document
    before it needs, sends them with its sketch, and meets what the next one sends.
    """
    body = F.coalesce(docs[text_col].cast("string"), F.lit(""))
    base = docs.select(F.monotonically_increasing_id().alias("row"), docs[id_col].alias("doc_id"), body.alias("text"))
    base = written(base.withColumn("n", F.char_length("text")), "sketches")
    keys = base.select("row", "doc_id", F.xxhash64("text").alias("hash"), "n")
    at, total = _positions(keys, ["doc_id", "hash", "row"])
    taker = at.select(F.col("row").alias("taker"), F.floor(F.col("n") / 4).cast("int").alias("need"), ((F.col("pos") + 1) % max(total, 1)).alias("pos"))
    links = taker.join(at.select(F.col("row"), "pos"), "pos").select("row", "taker", "need")
    # (both joins take the same columns of the texts, so that the second one uses the first one's shuffle)
    heads = base.join(links, "row").select(
        F.col("taker").alias("row"),
        F.expr("substring(text, 1, least(need, n))").alias("head"),
        sketch(F.col("text"), scale).alias("next"),
        F.col("doc_id").alias("next_id"),
        "need",
    )
    edited = F.concat(F.expr("substring(text, 1, n - need)"), F.col("head"))
    both = base.join(heads, "row").select("doc_id", "n", "text", "next", "next_id", edited.alias("edited"))
    # (one row out for each row in: the sketches are computed once, below what uses them)
    sketches = F.struct(sketch(F.col("text"), scale).alias("own"), sketch(F.col("edited"), scale).alias("new"))
    both = both.select("doc_id", "n", "next", "next_id", "edited", F.inline(F.array(sketches)))
    return both.select(
        "doc_id",
        F.col("n").cast("long").alias("n_chars"),
        F.sha2(F.encode("edited", "utf-8"), 256).alias("edited_sha256"),
        as_text(F.col("own")).alias("fingerprint"),
        as_text(F.col("new")).alias("edited_fingerprint"),
        likeness(F.col("own"), F.col("new")).alias("near_edited"),
        likeness(F.col("own"), F.col("next")).alias("near_next"),
        resemblance(F.col("own"), F.col("new")).alias("jaccard_edited"),
        resemblance(F.col("own"), F.col("next")).alias("jaccard_next"),
        F.size("own").alias("sketch_size"),
        "next_id",
    )
