"""Ordered numbering without a single-task window (dense_positions) and multi-file URL lists."""

import random

from pagelake.operators.indexing import broadcast_if_small, dense_positions
from pagelake.sources import urls


def test_dense_positions_equal_a_plain_sort(spark):
    keys = random.Random(3).sample(range(10_000_000), 3000)
    df = spark.createDataFrame([(k,) for k in keys], "k long").repartition(5)
    got = {r.k: r.pos for r in dense_positions(df, "k", "pos", start=10, buckets=7).collect()}
    assert got == {k: 10 + i for i, k in enumerate(sorted(keys))}


def test_broadcast_only_when_counted_small(spark):
    small = spark.range(3)
    big = spark.range(100)
    plan_small = spark.range(10).join(broadcast_if_small(small, 5), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" in plan_small.lower()
    plan_big = spark.range(10).join(broadcast_if_small(big, 5), "id")._jdf.queryExecution().analyzed().toString()
    assert "broadcast" not in plan_big.lower()


def test_url_list_across_files_keeps_file_order(spark, tmp_path):
    d = tmp_path / "lists"
    d.mkdir()
    (d / "part-0.txt").write_text("https://a/1\n\nhttps://a/2\n")
    (d / "part-1.txt").write_text("  https://b/1\nhttps://a/1\n")
    got = [r.url for r in urls.read_url_list(spark, str(d)).orderBy("seq").collect()]
    assert got == ["https://a/1", "https://a/2", "https://b/1", "https://a/1"]
    assert [r.seq for r in urls.read_url_list(spark, str(d)).orderBy("seq").collect()] == [0, 1, 2, 3]
