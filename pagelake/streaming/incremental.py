"""Incremental ingest (I6): new upsert batches land as files in a folder; a
Structured Streaming query picks them up and upserts each micro-batch into
the page table.

The page table is a snapshot ``<root>/v=<n>`` and the changes since: each micro-batch appends its reduced batch,
one row per URL, as ``<root>/c=<n>``, so what is written follows the batch and not the table. ``latest`` resolves the
newest write of every URL when it is read. After ``compact_every`` changes the next snapshot is written (never over
one that is being read); snapshots and changes that only older readers need are then removed, the last snapshot before
it kept. A change's folder records the batch it came from: a micro-batch replayed after a failure - the streaming
checkpoint has not recorded it yet - finds its own change complete and leaves it, or finds it incomplete (no
``_SUCCESS``) and writes it again. The checkpoint belongs to the table
(``<root>/_checkpoint``), so every run goes on where the last one ended;
with another checkpoint folder its own batches are told apart by its name.
``trigger(availableNow=True)`` processes what has landed and stops, which is
how the original's re-run-by-hand scripts behave; a long-running trigger
works the same way.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.ingest import UPDATED, new_ids, new_meta, reduced_batch
from ..sources.pagestore import COLUMNS, PAGES_SCHEMA, conform, empty_pages, read_pages

BATCH_SCHEMA = T.StructType(
    [
        T.StructField("seq", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("status_code", T.IntegerType()),
        T.StructField("title", T.StringType()),
        T.StructField("lang", T.StringType()),
        T.StructField("text_excerpt", T.StringType()),
        T.StructField("html_path", T.StringType()),
    ]
)


CHANGE_SCHEMA = T.StructType(
    [
        T.StructField("change", T.LongType()),
        T.StructField("url", T.StringType()),
        T.StructField("id", T.LongType()),  # of a new URL; null for an update
        T.StructField("fetched_at", T.TimestampType()),  # likewise
        *[PAGES_SCHEMA[c] for c in UPDATED],
    ]
)
#: Changes after which a snapshot is written.
COMPACT_EVERY = 32


def snapshot_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version:010d}"


def change_path(root: str, change: int) -> str:
    return f"{root.rstrip('/')}/c={change:010d}"


def _complete(spark: SparkSession, root: str, kind: str) -> list[int]:
    """The numbers of the complete snapshots (``v``) or changes (``c``), ascending."""
    jvm = spark.sparkContext._jvm
    fs, path = _fs(spark, root)
    if not fs.exists(path):
        return []
    out = []
    for st in fs.listStatus(path):
        name = st.getPath().getName()
        if st.isDirectory() and name.startswith(f"{kind}=") and fs.exists(jvm.org.apache.hadoop.fs.Path(st.getPath(), "_SUCCESS")):
            out.append(int(name[2:]))
    return sorted(out)


def _state(spark: SparkSession, root: str) -> tuple[int, list[int]]:
    """The newest snapshot, and the changes since."""
    versions = _complete(spark, root, "v")
    if not versions:
        raise FileNotFoundError(f"no snapshot under {root}")
    return versions[-1], [c for c in _complete(spark, root, "c") if c > versions[-1]]


_MARK = "_batch-"


def _fs(spark: SparkSession, path: str):
    p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def _exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return fs.exists(p)


def _touch(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    fs.create(p, True).close()


def init_table(spark: SparkSession, root: str, pages: DataFrame | None = None) -> None:
    """Write snapshot 0 (empty unless ``pages`` is given)."""
    df = pages if pages is not None else empty_pages(spark)
    conform(df).write.mode("errorifexists").parquet(snapshot_path(root, 0))


def _changes(spark: SparkSession, root: str, numbers: list[int]) -> DataFrame:
    paths = [change_path(root, c) for c in numbers]
    return spark.read.schema(CHANGE_SCHEMA).parquet(*paths) if paths else spark.createDataFrame([], CHANGE_SCHEMA)


def latest(spark: SparkSession, root: str) -> DataFrame:
    """The page table as of the newest complete change: the snapshot with each URL's newest write."""
    version, since = _state(spark, root)
    base = read_pages(spark, snapshot_path(root, version))
    if not since:
        return base
    newest = F.max_by(F.struct(*[F.col(c).alias("_n_" + c) for c in UPDATED]), "change")
    log = _changes(spark, root, since).groupBy("url").agg(newest.alias("_last"), F.max("id").alias("_id"), F.max("fetched_at").alias("_at"))
    log = log.select("url", "_id", "_at", "_last.*", F.lit(True).alias("_changed"))
    old = base.join(log.drop("_id", "_at"), "url", "left")
    old = old.select(*[(F.when(F.col("_changed"), F.col("_n_" + c)).otherwise(F.col(c)) if c in UPDATED else F.col(c)).alias(c) for c in COLUMNS])
    new = log.where(F.col("_id").isNotNull()).select(
        F.col("_id").alias("id"), "url", F.col("_at").alias("fetched_at"), new_meta().alias("raw_meta"), *[F.col("_n_" + c).alias(c) for c in UPDATED]
    )
    return conform(old).unionByName(conform(new))


def append_change(spark: SparkSession, root: str, batch: DataFrame, mark: str) -> None:
    """I4 as a change: the reduced batch, with ids for the URLs that neither the snapshot nor a change has."""
    version, since = _state(spark, root)
    red = reduced_batch(batch)
    # (only urls and ids of the table are read)
    known = read_pages(spark, snapshot_path(root, version)).select("url", "id")
    known = known.unionByName(_changes(spark, root, since).where(F.col("id").isNotNull()).select("url", "id"))
    max_id = known.agg(F.coalesce(F.max("id"), F.lit(0)).alias("m")).first()["m"]
    number = max([version, *since]) + 1
    rows = red.join(new_ids(red, known, int(max_id)), "url", "left").select(
        F.lit(number).cast("long").alias("change"),
        "url",
        F.col("_new_id").alias("id"),
        F.when(F.col("_new_id").isNotNull(), F.current_timestamp()).alias("fetched_at"),
        *[F.col("_n_" + c).cast(PAGES_SCHEMA[c].dataType).alias(c) for c in UPDATED],
    )
    _write(spark, rows, change_path(root, number), mark)


def compact(spark: SparkSession, root: str) -> None:
    """Write the table as a snapshot; what came before the snapshot before it is removed."""
    version, since = _state(spark, root)
    if since:
        _write(spark, latest(spark, root), snapshot_path(root, since[-1]))
    keep = _complete(spark, root, "v")[-2:][0]
    fs, _ = _fs(spark, root)
    gone = [snapshot_path(root, v) for v in _complete(spark, root, "v") if v < keep] + [change_path(root, c) for c in _complete(spark, root, "c") if c <= keep]
    for path in gone:
        fs.delete(_fs(spark, path)[1], True)


def _write(spark: SparkSession, rows: DataFrame, path: str, mark: str | None = None) -> None:
    rows.write.mode("overwrite").option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false").parquet(path)
    # first the batch's mark, then the sign that the folder is complete
    for name in [*([mark] if mark else []), "_SUCCESS"]:
        _touch(spark, f"{path}/{name}")


def start(
    spark: SparkSession,
    landing_dir: str,
    root: str,
    checkpoint: str | None = None,
    available_now: bool = True,
    processing_time: str = "1 minute",
    compact_every: int = COMPACT_EVERY,
):
    """Start the incremental upsert; returns the ``StreamingQuery``.

    ``checkpoint`` defaults to a folder of the table itself. A snapshot is written after ``compact_every`` changes.
    """
    checkpoint = checkpoint or f"{root.rstrip('/')}/_checkpoint"

    def upsert_batch(batch: DataFrame, batch_id: int) -> None:
        mark = f"{_MARK}{hashlib.sha256(checkpoint.encode()).hexdigest()[:16]}-{batch_id}"
        version, since = _state(spark, root)
        folders = [change_path(root, c) for c in since[-2:]] + [snapshot_path(root, version)]
        if not any(_exists(spark, f"{f}/{mark}") for f in folders):  # else it is a replay: its change is there
            append_change(spark, root, batch, mark)
            since = [*since, 0]
        if len(since) >= compact_every:
            compact(spark, root)
            # (the changes the snapshot holds may be gone at the next replay)
            _touch(spark, f"{snapshot_path(root, _state(spark, root)[0])}/{mark}")

    reader = spark.readStream.schema(BATCH_SCHEMA).option("recursiveFileLookup", "true").parquet(landing_dir)
    w = reader.writeStream.foreachBatch(upsert_batch).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time)
    return w.start()
