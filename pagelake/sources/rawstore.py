"""The raw store (S2): pages by the digest of their bytes, kept in a table partitioned by the digest's first characters.

Inserting is insert-if-absent. What is new is decided on digests alone: those of the batch are compared with the
stored ones of the same partitions, and one row of each new digest is chosen. The pages themselves are then
written straight from the scan, by the tasks that read them. To know its chosen rows a task needs no join with the
pages: the choice travels as a cascade of small bitmaps, each holding the wrong hits of the one before, which is
exact for the rows of the batch.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written

SCHEMA = "digest string, html string, n_bytes long, prefix string"
#: Rows chosen in one pass over the pages, and bits of a bitmap for each of them (at most 8 MB a bitmap).
CHOSEN, BITS_EACH = 4_000_000, 16
PREFIX = 1


def digest(html_col: str = "html") -> Column:
    """sha256 of the UTF-8 bytes of the page, hex."""
    return F.sha2(F.encode(F.col(html_col), "UTF-8"), 256)


def _exists(spark: SparkSession, path: str) -> bool:
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(p)


def read_raw(spark: SparkSession, path: str) -> DataFrame:
    """``digest, html, n_bytes, prefix`` of every stored page; empty where nothing was stored yet."""
    if not _exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).parquet(path)


@dataclass
class Cascade:
    """Which of a known set of 64-bit numbers are chosen: (bits, words) of each bitmap."""

    levels: list[tuple[int, DataFrame]]

    def mark(self, rows: DataFrame, number: str, name: str) -> DataFrame:
        """``rows`` with a boolean ``name``: whether their ``number``, one of the known ones, is chosen."""
        for i, (bits, words) in enumerate(self.levels):
            slot = _slot(F.col(number), bits, i)
            rows = rows.withColumn(f"_at{i}", F.shiftright(slot, 6)).join(
                # (at most CHOSEN * BITS_EACH / 32 words)
                F.broadcast(words.select(F.col("word").alias(f"_at{i}"), F.col("bits").alias(f"_bits{i}"))), f"_at{i}", "left"
            )
        chosen = F.lit(False)
        for i, (bits, _) in reversed(list(enumerate(self.levels))):
            hit = F.getbit(F.coalesce(F.col(f"_bits{i}"), F.lit(0)), _slot(F.col(number), bits, i).bitwiseAND(63).cast("int")) == 1
            chosen = hit & ~chosen
        drop = [f"{n}{i}" for i in range(len(self.levels)) for n in ("_at", "_bits")]
        return rows.withColumn(name, chosen).drop(*drop)


def _slot(number: Column, bits: int, level: int) -> Column:
    return F.xxhash64(number, F.lit(level)).bitwiseAND(F.lit(bits - 1))


def cascade(chosen: DataFrame, others: DataFrame) -> Cascade:
    """A cascade that tells the numbers (column ``h``, distinct) of ``chosen`` from those of ``others``."""
    levels: list[tuple[int, DataFrame]] = []
    inside, outside, n = chosen, others, chosen.count()
    while n:
        bits = 1 << max(10, (BITS_EACH * n - 1).bit_length())
        i = len(levels)
        slot = _slot(F.col("h"), bits, i)
        # (the bit of a slot within its word of 64)
        word = F.expr(f"shiftleft(1L, cast(xxhash64(h, {i}) & 63 as int))")
        words = written(inside.groupBy(F.shiftright(slot, 6).alias("word")).agg(F.bit_or(word).alias("bits")), "bitmap")
        levels.append((bits, words))
        hits = outside.withColumn("word", F.shiftright(slot, 6)).join(F.broadcast(words), "word")
        hits = written(hits.where(F.getbit("bits", slot.bitwiseAND(63).cast("int")) == 1).select("h"), "hits")
        inside, outside, n = hits, inside, hits.count()
    return Cascade(levels)


def insert_pages(pages: DataFrame, path: str, key_col: str = "url", html_col: str = "html", chosen_at_once: int = CHOSEN) -> int:
    """Store the pages whose bytes are not stored yet; returns how many rows were written.

    Equal pages are stored once, whatever their keys; a null page is not stored. Storing the same pages again
    writes nothing. The pages are read and hashed twice and never shuffled, but for rows that repeat both key and
    page, of which one has to be picked.
    """
    spark = pages.sparkSession
    rows = pages.where(F.col(html_col).isNotNull()).select(F.col(key_col).alias("key"), F.col(html_col).alias("html"))
    rows = rows.withColumn("digest", digest("html")).withColumn("h", F.xxhash64("key", "digest"))
    known = written(rows.select("digest", "h").groupBy("digest", "h").agg(F.count("*").alias("n")), "digests")
    first = known.groupBy("digest").agg(F.min(F.struct("h", "n")).alias("at")).select("digest", "at.h", "at.n")
    prefix = F.substring("digest", 1, PREFIX)
    some = [r.prefix for r in known.select(prefix.alias("prefix")).distinct().collect()]  # (at most 16 ** PREFIX)
    stored = read_raw(spark, path).where(F.col("prefix").isin(some)).select("digest")
    new = written(first.join(stored, "digest", "left_anti"), "new")
    total = new.count()
    for i in range(-(-total // chosen_at_once)):
        part = new.where(F.pmod(F.xxhash64("digest"), F.lit(-(-total // chosen_at_once))) == i)
        others = known.join(part.select("h"), "h", "left_anti").select("h").distinct()
        mine = cascade(part.select("h").distinct(), others).mark(rows, "h", "mine").where("mine")
        repeated = part.where("n > 1").select("h").distinct()
        if repeated.head(1):
            twice = cascade(repeated, known.join(repeated, "h", "left_anti").select("h").distinct()).mark(mine, "h", "twice")
            mine = twice.where("not twice").drop("twice").unionByName(twice.where("twice").drop("twice").dropDuplicates(["digest"]))
        out = mine.select("digest", "html", F.octet_length("html").cast("long").alias("n_bytes"), prefix.alias("prefix"))
        out.write.mode("append").partitionBy("prefix").option("compression", "zstd").parquet(path)
    return total
