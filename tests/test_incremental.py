"""Incremental upsert with Structured Streaming."""

from pyspark.sql import functions as F

from pagelake.streaming import incremental as INC


def _batch(spark, rows):
    return spark.createDataFrame(rows, INC.BATCH_SCHEMA)


def test_incremental_runs_upsert_each_landed_batch(spark, tmp_path):
    landing, root, ckpt = str(tmp_path / "landing"), str(tmp_path / "pages"), str(tmp_path / "ckpt")
    INC.init_table(spark, root)
    _batch(spark, [(1, "https://a/", 200, "A", "en", "a", "raw/a.html"), (2, "https://b/", 200, "B", "de", "b", "raw/b.html")]).write.parquet(
        landing + "/batch1"
    )
    q = INC.start(spark, landing, root, ckpt)
    q.awaitTermination(120)
    t1 = {r.url: r for r in INC.latest(spark, root).collect()}
    assert set(t1) == {"https://a/", "https://b/"}
    assert sorted(r.id for r in t1.values()) == [1, 2]

    # a second run with the same checkpoint picks up only the new file
    _batch(spark, [(3, "https://a/", 404, None, "en", "a2", "raw/a2.html"), (4, "https://c/", 200, "C", "fr", "c", "raw/c.html")]).write.parquet(
        landing + "/batch2"
    )
    q = INC.start(spark, landing, root, ckpt)
    q.awaitTermination(120)
    t2 = {r.url: r for r in INC.latest(spark, root).collect()}
    assert set(t2) == {"https://a/", "https://b/", "https://c/"}
    a = t2["https://a/"]
    assert (a.id, a.status_code, a.title, a.text_excerpt) == (t1["https://a/"].id, 404, None, "a2")
    assert a.fetched_at == t1["https://a/"].fetched_at  # kept on update
    assert t2["https://c/"].id == 3
    assert INC.latest(spark, root).where(F.col("raw_meta")["fetched_by"] == "playwright").count() == 3


def test_three_runs_without_a_checkpoint_argument(spark, tmp_path):
    """Each run goes on where the last one ended; nothing is lost or done twice."""
    root, landing = str(tmp_path / "pages"), str(tmp_path / "landing")
    INC.init_table(spark, root)
    for i, url in enumerate("abc"):
        row = (i, f"https://{url}.org", 200, url, "en", "text", "raw/x.html")
        spark.createDataFrame([row], INC.BATCH_SCHEMA).write.parquet(f"{landing}/batch-{i}")
        q = INC.start(spark, landing, root)
        q.awaitTermination()
        assert q.exception() is None
    got = {r["url"]: r["id"] for r in INC.latest(spark, root).collect()}
    assert got == {"https://a.org": 1, "https://b.org": 2, "https://c.org": 3}


def _size(path):
    return sum(p.stat().st_size for p in path.rglob("*.parquet"))


def _run(spark, landing, root, **settings):
    q = INC.start(spark, landing, root, **settings)
    q.awaitTermination()
    assert q.exception() is None


def test_what_is_written_follows_the_batch(spark, tmp_path):
    root, landing = str(tmp_path / "pages"), str(tmp_path / "landing")
    base = spark.range(5000).selectExpr("id + 1 as id", "concat('https://p', id) as url", "repeat(sha2(cast(id as string), 512), 4) as text_excerpt")
    INC.init_table(spark, root, base)
    rows = [(i, f"https://p{4990 + i}", 200, "t", "en", "new", "raw/x.html") for i in range(20)]
    _batch(spark, rows).write.parquet(landing + "/one")
    _run(spark, landing, root)
    got = INC.latest(spark, root)
    assert got.count() == 5010 and got.where("text_excerpt = 'new'").count() == 20 and got.select("id").distinct().count() == 5010
    assert sorted(p.name[:2] for p in (tmp_path / "pages").iterdir() if "=" in p.name) == ["c=", "v="]
    assert _size(tmp_path / "pages" / "c=0000000001") < _size(tmp_path / "pages" / "v=0000000000") / 20


def test_changes_become_a_snapshot_and_old_ones_go(spark, tmp_path):
    root, landing = str(tmp_path / "pages"), str(tmp_path / "landing")
    INC.init_table(spark, root)
    for i in range(5):
        rows = [(2 * i, f"https://{'abc'[i % 3]}", 200 + i, None, "en", f"t{i}", "raw/x.html"), (2 * i + 1, f"https://n{i}", 200, "n", "en", "n", "raw/y.html")]
        _batch(spark, rows).write.parquet(f"{landing}/{i}")
        _run(spark, landing, root, compact_every=2)
        seen = {r.url: (r.id, r.status_code, r.text_excerpt) for r in INC.latest(spark, root).collect()}
        assert len(seen) == len({v[0] for v in seen.values()}) == min(i + 1, 3) + i + 1
        assert seen[f"https://{'abc'[i % 3]}"][1:] == (200 + i, f"t{i}")
    assert seen["https://a"][0] == 1 and seen["https://b"] == (3, 204, "t4")
    assert sorted(p.name for p in (tmp_path / "pages").iterdir() if "=" in p.name) == ["c=0000000003", "c=0000000004", "c=0000000005", "v=0000000002", "v=0000000004"]


def test_a_replayed_batch_changes_nothing(spark, tmp_path):
    root = str(tmp_path / "pages")
    INC.init_table(spark, root)
    rows = [(1, "https://a", 200, "t", "en", "x", "raw/x.html"), (2, "https://a", 404, None, "en", "y", "raw/y.html"), (3, None, 200, "n", "en", "z", None)]
    INC.append_change(spark, root, _batch(spark, rows), "m")
    first = INC.latest(spark, root).collect()
    assert [(r.id, r.url, r.status_code, r.title) for r in first] == [(1, "https://a", 404, None)]
    INC.append_change(spark, root, _batch(spark, rows), "m2")
    assert INC.latest(spark, root).collect() == first
    INC.compact(spark, root)
    assert INC.latest(spark, root).collect() == first
