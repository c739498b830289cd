"""SimHash near-duplicates by multi-index hashing.

A fingerprint has 64 bits, cut into two segments of 32. If two fingerprints differ in at most 3 bits, they
differ in at most one bit of one of the segments. So every distinct fingerprint is entered in a table under
each of its two segment values, and looks the table up under all values of the Hamming ball of radius 1
around them (33 per segment). What meets in a bucket is verified at full distance.

Of two values that differ in one bit, only the one with the bit set looks the other up, so each pair meets
once per segment.

A bucket in which many fingerprints share one segment value (a large group of near copies) would give all
their pairs. Its members are dealt anew by the same method on the other 32 bits, cut into two segments of
16. A bucket of that second index fixes 48 bits, so it has at most 2^16 fingerprints besides those one bit
off; if it is still large, one task walks through it and returns a spanning forest of its links.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import byte_rows, id_text, id_type, side, slices, written
from .graph import components

SEED = 42
#: Entries of a bucket that are paired directly; larger buckets are dealt anew or walked through.
PAIRED = 32
LOW = (1 << 32) - 1


def fingerprint(text: bytes | None, shingle: int) -> int:
    """The fingerprint of a text, as an unsigned number; 0 without words."""
    words = text.lower().split() if text else []
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), dtype=np.int64, count=len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    n = max(1, len(words) - shingle + 1)
    digest = xxhash.xxh64_intdigest
    ones, last = np.zeros(64, dtype=np.int64), ends[min(shingle, len(words)) - 1 :]
    for a in range(0, n, 1 << 16):
        h = np.array(
            [digest(line[i:j], SEED) for i, j in zip(starts[a : min(n, a + (1 << 16))].tolist(), last[a : a + (1 << 16)].tolist(), strict=False)],
            dtype="<u8",
        )
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprints(docs: DataFrame, shingle: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id and fp (the 64 bits as a signed long) of every row."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for b in slices(whole, "text", 8 << 20):
                fp = np.array([fingerprint(t, shingle) for t in byte_rows(b.column("text"))], dtype=np.uint64).view(np.int64)
                yield pa.RecordBatch.from_arrays([b.column("doc_id"), pa.array(fp)], names=["doc_id", "fp"])

    return id_text(docs, id_col, text_col).mapInArrow(run, f"doc_id {id_type(docs, id_col)}, fp long")


def spanning_links(fps: np.ndarray, entered: np.ndarray, bits: int) -> list[tuple[int, int]]:
    """A spanning forest of the links (``bits`` or fewer differing bits) between entered and all members.

    Breadth first from each entered fingerprint not yet reached; every entered one is compared once with
    those that are still alone, so the work is at most entries x members and the result has fewer rows than
    the bucket has members.
    """
    fps, entered = fps.astype(np.uint64), entered.astype(bool)
    alone, free, out = np.arange(len(fps)), np.ones(len(fps), dtype=bool), []
    for first in np.flatnonzero(entered):
        if not free[first]:
            continue
        free[first], todo = False, [first]
        alone = alone[free[alone]]
        while todo:
            at = todo.pop()
            near = np.bitwise_count(fps[alone] ^ fps[at]) <= bits
            new, alone = alone[near], alone[~near]
            free[new] = False
            out += [(int(at), int(x)) for x in new]
            todo += [int(x) for x in new if entered[x]]
    # members that only look up may be near several trees: each of them joins the trees it touches
    tree = _roots(len(fps), out)
    for x in np.flatnonzero(~entered):
        near = np.flatnonzero((np.bitwise_count(fps ^ fps[x]) <= bits) & entered)
        for r in {int(tree[n]): int(n) for n in near}.values():
            if tree[r] != tree[x]:
                out.append((r, int(x)))
    return out


def _roots(n: int, links: list[tuple[int, int]]) -> np.ndarray:
    """The tree of each member of a forest whose links come parents first."""
    root = np.arange(n)
    for a, b in links:
        root[b] = root[a]
    return root


def links(fps: DataFrame, bits: int = 3, paired: int = PAIRED) -> DataFrame:
    """Pairs (a, b) of different fingerprints at ``bits`` (at most 3) or fewer differing bits, enough of them
    to connect all that are linked. ``fps`` has distinct signed longs in a column fp."""
    if not 0 <= bits <= 3:
        raise ValueError("two segments and balls of radius 1 answer for at most 3 bits")

    def index(df: DataFrame, values: list, width: int, prefix: list[str]) -> tuple[DataFrame, DataFrame]:
        """Table entries and look-ups of a two-segment index under (prefix, key)."""
        keyed = [F.shiftleft(F.lit(k).cast("long"), width) + v for k, v in enumerate(values)]
        flips = F.array(*[F.lit(m).cast("long") for m in [0, *(1 << b for b in range(width))]])
        seen = df.select(*prefix, "fp", F.explode(F.array(*keyed)).alias("value"))
        ball = seen.select(*prefix, "fp", "value", F.explode(flips).alias("flip"))
        ball = ball.where((F.col("flip") == 0) | (F.col("value").bitwiseAND(F.col("flip")) != 0))
        return seen.withColumnRenamed("value", "key"), ball.select(*prefix, "fp", F.col("value").bitwiseXOR(F.col("flip")).alias("key"))

    def verified(entries: DataFrame, ball: DataFrame, on: list[str]) -> DataFrame:
        """Table matches at full distance. Equal segment values meet twice; one of the two is enough. Always merged: a ball
        has up to 33 rows for each of its fingerprints, which Spark does not count."""
        e, p = entries.withColumnRenamed("fp", "a"), ball.withColumnRenamed("fp", "b").hint("merge")
        cond = [e[c] == p[c] for c in on] + [e["a"] != p["b"], F.bit_count(e["a"].bitwiseXOR(p["b"])) <= bits]
        both = cond[0]
        for c in cond[1:]:
            both = both & c
        return e.join(p, both).select("a", "b")

    seg = [F.shiftrightunsigned("fp", 32), F.col("fp").bitwiseAND(F.lit(LOW))]
    entries, ball = index(fps, seg, 32, [])
    large = written(entries.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") > paired).select("key"), "large-buckets")
    if large.isEmpty():
        return verified(entries, ball, ["key"])
    large = side(large)
    cold = verified(entries.join(large, "key", "left_anti"), ball, ["key"])

    # the other half of the members of large buckets, cut in two again
    def other(df: DataFrame) -> list:
        rest = F.when(F.col("bucket") < F.lit(1 << 32), seg[1]).otherwise(seg[0])
        return [F.shiftrightunsigned(rest, 16), rest.bitwiseAND(F.lit(0xFFFF))]

    hot_e = entries.join(large, "key", "left_semi").withColumnRenamed("key", "bucket")
    hot_p = ball.join(large, "key", "left_semi").withColumnRenamed("key", "bucket")
    entries2 = index(hot_e, other(hot_e), 16, ["bucket"])[0]
    # members that are one bit off in the first half come from both sides of the flipped bit here
    full = F.array(*[F.lit(m).cast("long") for m in [0, *(1 << b for b in range(16))]])
    ball2 = index(hot_p, other(hot_p), 16, ["bucket"])[0].select(
        "bucket", "fp", F.explode(F.transform(full, lambda m: F.col("key").bitwiseXOR(m))).alias("key")
    )
    entries2, ball2 = written(entries2, "entries2"), written(ball2, "ball2")
    on = ["bucket", "key"]
    large2 = written(entries2.groupBy(*on).agg(F.count("*").alias("n")).where(F.col("n") > paired).select(*on), "large-buckets2")
    large2 = side(large2)
    warm = verified(entries2.join(large2, on, "left_anti"), ball2, on)
    members = (
        entries2.join(large2, on, "left_semi")
        .withColumn("entered", F.lit(1))
        .unionByName(ball2.join(large2, on, "left_semi").withColumn("entered", F.lit(0)))
        .groupBy(*on, "fp")
        .agg(F.max("entered").alias("entered"))
    )

    def walk(pdf: pd.DataFrame) -> pd.DataFrame:
        fp = pdf["fp"].to_numpy()
        got = np.array(spanning_links(fp.view(np.uint64), pdf["entered"].to_numpy(), bits), dtype=np.int64).reshape(-1, 2)
        return pd.DataFrame({"a": fp[got[:, 0]], "b": fp[got[:, 1]]})

    return cold.unionByName(warm).unionByName(members.groupBy(*on).applyInPandas(walk, "a long, b long"))


def near_duplicates(docs: DataFrame, shingle: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, fingerprint (16 hex digits), component_id.

    Texts are lower-cased (A-Z), cut into words at ASCII white space and into shingles of ``shingle`` words
    (fewer words: the whole sequence). Null, empty and blank texts have fingerprint zero and link like any
    other. component_id is the smallest id reachable over links of ``bits`` or fewer bits, the row's own
    included; null ids take part but are never the smallest (null where a component has no other).
    Equal fingerprints are one class, so copies are never paired with each other.
    """
    seen = written(fingerprints(docs, shingle, id_col, text_col), "fingerprints")
    classes = written(seen.groupBy("fp").agg(F.min("doc_id").alias("least")), "classes")
    n = classes.count()
    root = components(links(classes.select("fp"), bits))
    c = classes.join(side(root.withColumnRenamed("node", "fp")), "fp", "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    name = c.groupBy("root").agg(F.min("least").alias("component_id"))
    named = c.join(side(name, n), "root").select("fp", "component_id")
    return seen.join(side(named, n), "fp").select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def deduplicate(docs: DataFrame, shingle: int = 3, bits: int = 3, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with exactly one of each group of near duplicates: the one with the smallest id (a null id
    is larger than any; of rows that repeat an id, the one with the smallest hash of its text, and one of equal rows).

    All columns are kept; columns other than the id and the text take no part.
    """
    id_, text = docs[id_col], docs[text_col].cast("string")
    key = F.struct(id_.isNull().alias("none"), id_.alias("id"), F.coalesce(F.xxhash64(text), F.lit(0)).alias("text"))
    groups = near_duplicates(docs.select(key.alias("key"), text.alias("text")), shingle, bits, "key", "text")
    groups = written(groups.select(F.col("doc_id").alias("key"), F.col("component_id").alias("first")), "groups")
    parts = [F.col("key.none").alias("__none"), F.col("key.id").alias("__id"), F.col("key.text").alias("__text")]
    on = ["__none", "__id", "__text"]
    gone = side(written(groups.where("key <> first").select(*parts).distinct(), "gone"))
    same = written(groups.where("key = first").groupBy("key").agg(F.count("*").alias("n")).where("n > 1").select(*parts), "repeated")
    rows = docs.select("*", key["none"].alias("__none"), key["id"].alias("__id"), key["text"].alias("__text"))

    def meets(other: DataFrame):
        both = [rows[c].eqNullSafe(other[c]) for c in on]
        return both[0] & both[1] & both[2]

    rows = rows.join(gone, meets(gone), "left_anti")
    if same.head(1):
        same = side(same)
        once = rows.join(same, meets(same), "left_semi").dropDuplicates(on)
        rows = rows.join(same, meets(same), "left_anti").unionByName(once)
    return rows.select(*docs.columns)
