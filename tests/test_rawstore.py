"""The raw store: insert-if-absent without moving pages."""

import hashlib
import random

from pyspark.sql import functions as F

from pagelake.sources import rawstore as R


def _pages(spark, rows):
    return spark.createDataFrame(rows, "url string, html string").repartition(3)


def _stored(spark, path):
    return sorted((r.digest, r.html, r.n_bytes) for r in R.read_raw(spark, path).collect())


def _want(*pages):
    return sorted({(hashlib.sha256(p.encode()).hexdigest(), p, len(p.encode())) for p in pages if p is not None})


def test_insert_if_absent(spark, tmp_path):
    path = str(tmp_path / "raw")
    rows = [("a", "<p>one"), ("b", "<p>two é"), ("c", "<p>one"), ("d", None), ("a", "<p>one"), ("e", "")]
    assert R.read_raw(spark, path).count() == 0
    assert R.insert_pages(_pages(spark, rows), path) == 3
    assert _stored(spark, path) == _want("<p>one", "<p>two é", "")
    files = sorted(p.name for p in (tmp_path / "raw").rglob("*.parquet"))
    assert R.insert_pages(_pages(spark, rows), path) == 0
    assert files == sorted(p.name for p in (tmp_path / "raw").rglob("*.parquet"))  # nothing was written
    assert R.insert_pages(_pages(spark, rows + [("f", "<p>three"), (None, "<p>four"), ("g", "<p>two é")]), path) == 2
    assert _stored(spark, path) == _want("<p>one", "<p>two é", "", "<p>three", "<p>four")
    assert R.insert_pages(_pages(spark, rows).limit(0), path) == 0


def test_many_pages_in_several_passes(spark, tmp_path):
    rnd = random.Random(1)
    rows = [(f"u{i}", f"page {rnd.randrange(1500)}") for i in range(4000)]
    path = str(tmp_path / "raw")
    half = rows[:2000]
    assert R.insert_pages(_pages(spark, half), path, chosen_at_once=400) == len({h for _, h in half})
    R.insert_pages(_pages(spark, rows), path)
    assert _stored(spark, path) == _want(*[h for _, h in rows])


def test_a_cascade_is_exact(spark):
    numbers = spark.range(20_000).select(F.xxhash64("id").alias("h"), (F.col("id") % 7 == 0).alias("chosen"))
    c = R.cascade(numbers.where("chosen").select("h"), numbers.where("not chosen").select("h"))
    assert len(c.levels) > 2
    assert c.mark(numbers, "h", "found").where("found <> chosen").count() == 0
    assert R.cascade(numbers.limit(0).select("h"), numbers.select("h")).mark(numbers, "h", "found").where("found").count() == 0


def test_pages_are_not_shuffled(spark, tmp_path):
    numbers = spark.range(1000).select(F.xxhash64("id").alias("h"), F.col("id"))
    c = R.cascade(numbers.where("id < 500").select("h"), numbers.where("id >= 500").select("h"))
    numbers.write.parquet(str(tmp_path / "n"))
    marked = c.mark(spark.read.parquet(str(tmp_path / "n")), "h", "mine").where("mine")
    plan = marked._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan and "hashpartitioning" not in plan.replace("BroadcastExchange", "")
