"""Sharding by a consistent-hash ring with virtual nodes and bounded loads.

Every shard owns ``virtual`` points of a ring; a row's key falls on a place of the ring, and the shard of the
next point clockwise takes it while it has room. Rows over a full shard's bound continue clockwise to the
next shard with room. The bounds are n/k rounded down or up, so counts are at most one apart.

Only counts per place are needed to decide who overflows where. The ring has a fixed number of places, so
that walk is done on a table of bounded size, and each place gets a list of shards with row ranges and first
slots. Rows are then numbered inside their place, in parallel over the places, and look up their range.
"""

from __future__ import annotations

from collections import deque

import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import sql_text_crc32, written

#: Places of the ring: the size of the histogram and of the broadcast table, whatever the number of rows.
PLACES = 1 << 16
#: Rows of a place from which it is numbered in chunks, and the number of those.
HOT_ROWS, CHUNKS = 1 << 20, 256


def ring_owners(shards: int, virtual: int) -> list[int]:
    """The shard that owns each place: that of the next virtual node clockwise (ties: the smaller shard).

    A shard's own points do not depend on the other shards, so adding a shard changes only the places that
    its points take over.
    """
    first: dict[int, int] = {}
    for s in range(shards):
        for v in range(virtual):
            first.setdefault(xxhash.xxh64_intdigest(f"shard {s} point {v}", 17) % PLACES, s)
    owners, own = [0] * PLACES, first[min(first)]
    for p in reversed(range(PLACES)):
        own = first.get(p, own)
        owners[p] = own
    return owners


def allocate(counts: list[int], owners: list[int], bounds: list[int]) -> list[list[tuple[int, int]]]:
    """For each place, clockwise: (shard, rows) in the order in which its rows are handed out.

    First every shard takes from its own places, in ring order, up to its bound. What is left of a place
    walks on clockwise from there, and a shard with room takes what passes its places, nearest first.
    """
    room, left = list(bounds), list(counts)
    out: list[list[tuple[int, int]]] = [[] for _ in counts]
    for p, s in enumerate(owners):
        if take := min(left[p], room[s]):
            out[p].append((s, take))
            room[s], left[p] = room[s] - take, left[p] - take
    walking: deque[list[int]] = deque()  # [place, rows], the nearest ones last
    for p, s in [*enumerate(owners)] * 2:
        if left[p]:
            walking.append([p, left[p]])
            left[p] = 0
        while walking and room[s]:
            take = min(walking[-1][1], room[s])
            out[walking[-1][0]].append((s, take))
            room[s] -= take
            walking[-1][1] -= take
            if not walking[-1][1]:
                walking.pop()
    return out


def assign_shards(
    docs: DataFrame, shards: int = 40, virtual: int = 64, id_col: str = "doc_id", text_col: str = "text", hot_rows: int = HOT_ROWS
) -> DataFrame:
    """One row per row of ``docs``: doc_id, size (UTF-8 bytes + 16), text_crc32, law (``rows``), shard, slot, grown_shard (null).

    Slots number a shard's rows from 0 without gaps. A null id hashes like any value; a null text counts as
    empty; identical rows are interchangeable and each get a slot. A place with more than ``hot_rows`` rows (one id,
    or none, in a third of the table) is split among tasks. An empty table gives no rows. The text
    is read once, for its size and checksum; what is shuffled is a few numbers per row.
    """
    if shards < 1 or virtual < 1:
        raise ValueError("shards and virtual must be at least 1")
    place = F.pmod(F.xxhash64(docs[id_col]), F.lit(PLACES)).cast("int")
    seen = {r.place: r.n for r in docs.select(place.alias("place")).groupBy("place").agg(F.count("*").alias("n")).collect()}
    counts = [seen.get(p, 0) for p in range(PLACES)]
    total = sum(counts)
    bounds = [total // shards + (s < total % shards) for s in range(shards)]
    ranges, filled = [], [0] * shards
    for p, given in enumerate(allocate(counts, ring_owners(shards, virtual), bounds)):
        at = 0
        for s, n in given:
            ranges.append((p, at, at + n, s, filled[s] - at))
            at, filled[s] = at + n, filled[s] + n
    table = docs.sparkSession.createDataFrame(ranges, "place int, low long, high long, shard int, shift long")

    text = docs[text_col].cast("string")
    rows = docs.select(
        docs[id_col].alias("doc_id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 16).cast("long").alias("size"),
        sql_text_crc32(text).alias("text_crc32"),
        place.alias("place"),
    )
    hot = [p for p, n in seen.items() if n > hot_rows]
    return (
        _numbered(rows, hot)
        .join(F.broadcast(table), "place")
        .where((F.col("nth") >= F.col("low")) & (F.col("nth") < F.col("high")))
        .select(
            "doc_id",
            "size",
            "text_crc32",
            F.lit("rows").alias("law"),
            "shard",
            (F.col("nth") + F.col("shift")).cast("long").alias("slot"),
            F.lit(None).cast("int").alias("grown_shard"),
        )
    )


def _numbered(rows: DataFrame, hot: list[int]) -> DataFrame:
    """``rows`` with their number ``nth`` within their place, in the order of id, checksum and size.

    A hot place (an id, or no id, that very many rows have) is numbered in chunks, each from the number of rows
    in the chunks before it. Chunks are dealt by a number of the rows, which are written with it first, so
    equal rows are split, too; the order within such a place is that of its chunks.
    """
    order = ["doc_id", "text_crc32", "size"]
    alone = lambda df: df.withColumn("nth", F.row_number().over(Window.partitionBy("place").orderBy(*order)) - 1)
    if not hot:
        return alone(rows)
    places = rows.sparkSession.createDataFrame([(p,) for p in hot], "place int")
    cold = rows.join(F.broadcast(places), "place", "left_anti")
    some = rows.join(F.broadcast(places), "place", "left_semi").withColumn("row", F.monotonically_increasing_id())
    some = written(some.withColumn("chunk", F.pmod(F.xxhash64("row"), F.lit(CHUNKS))), "hot-places")
    sizes = some.groupBy("place", "chunk").agg(F.count("*").alias("n"))
    before = Window.partitionBy("place").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    # (at most PLACES * CHUNKS rows)
    offsets = sizes.select("place", "chunk", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    inside = F.row_number().over(Window.partitionBy("place", "chunk").orderBy(*order, "row")) - 1
    split = some.withColumn("nth", inside).join(offsets, ["place", "chunk"]).withColumn("nth", F.col("nth") + F.col("offset"))
    return alone(cold).unionByName(split.select(*rows.columns, "nth"))
