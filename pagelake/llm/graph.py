"""Connected components of a large graph, by min-label stars on written tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import side, written


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """(node, root): the smallest node reachable from each node of ``edges`` (columns a, b; any order).

    Alternating large and small stars: in a large star every node points its larger neighbours to the
    smallest one it knows; in a small star it points its smaller neighbours there. The number of edges never
    grows, no node gathers its neighbours (a node only needs their minimum, which is combined before the
    shuffle), and each round is a written table, so a lost executor costs one round.
    """
    both = lambda e: e.select("a", "b").unionByName(e.select(F.col("b").alias("a"), F.col("a").alias("b")))

    def star(e: DataFrame, large: bool, n: int) -> DataFrame:
        """Each (a, b), b an older or younger neighbour of a, becomes (b, smallest of a and its neighbours). ``n``: edges
        at most."""
        pairs = both(e) if large else e  # e has a > b
        least = pairs.groupBy("a").agg(F.min("b").alias("least"))
        least = least.select(F.col("a").alias("k"), F.least("a", "least").alias("least"))
        met = pairs.join(side(least, 2 * n), pairs["a"] == least["k"])
        if large:
            new = met.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("least").alias("b"))
        else:
            new = met.select(F.col("b").alias("a"), F.col("least").alias("b")).unionByName(met.select("a", F.col("least").alias("b")))
        return new.where(F.col("a") > F.col("b")).distinct()

    now = written(
        edges.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    state = lambda e: e.agg(F.count("*"), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.pmod(F.xxhash64("b", "a"), F.lit(1 << 30)))).first()
    mark = state(now)
    for _ in range(max_rounds if mark[0] else 0):
        now = written(star(star(now, True, mark[0]), False, mark[0]), "star")
        new = state(now)
        if new == mark:
            break
        mark = new
    else:
        if mark[0]:
            raise RuntimeError("the components did not settle")
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))
