"""Session and shared-storage helpers."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def local_session(cores: int | str = "*", shuffle_partitions: int = 8, app: str = "pagelake") -> SparkSession:
    """A local session for tests and the bench; on a cluster use the cluster's session."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(shuffle_partitions))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.coalescePartitions.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", os.environ.get("PAGELAKE_DRIVER_MEMORY", "16g"))
    )
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ship_code(spark: SparkSession) -> None:
    """Send this package to the executors, once per session, as a zip file that Spark distributes.

    Python functions that run in tasks are pickled by reference, so executors must be able to import the
    package even when only the driver has it on its path.
    """
    sc = spark.sparkContext
    if getattr(sc, "_pagelake_shipped", False):
        return
    here = os.path.dirname(os.path.abspath(__file__))
    out = os.path.join(tempfile.mkdtemp(prefix="pagelake-code-"), "pagelake.zip")
    with zipfile.ZipFile(out, "w", zipfile.ZIP_DEFLATED) as z:
        for folder, _, names in os.walk(here):
            for n in names:
                if n.endswith(".py"):
                    full = os.path.join(folder, n)
                    z.write(full, os.path.join("pagelake", os.path.relpath(full, here)))
    sc.addPyFile(out)
    sc._pagelake_shipped = True


def shared_dir(spark: SparkSession) -> str:
    """The cluster-shared folder named by ``spark.checkpoint.dir``.

    The setting is read from the session. Only when it is unset (local tests,
    the bench) a folder of our own is made and registered, so that
    ``DataFrame.checkpoint()`` and written intermediate tables land in the same
    place.
    """
    sc = spark.sparkContext
    d = spark.conf.get("spark.checkpoint.dir", None) or sc.getCheckpointDir()
    if not d:
        # (``spark.checkpoint.dir`` is a static setting: it cannot be set on a
        # running session, so the folder is registered with the context only)
        if not sc.master.startswith("local") or sc.master.startswith("local-cluster"):
            raise RuntimeError("set spark.checkpoint.dir to a folder that the driver and every executor can reach")
        d = tempfile.mkdtemp(prefix="pagelake-ckpt-")
    if not sc.getCheckpointDir():
        # DataFrame.checkpoint() needs the folder registered with the context
        sc.setCheckpointDir(d)
    return d


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh, unique path under the shared folder for a written intermediate table."""
    base = shared_dir(spark).rstrip("/")
    return f"{base}/pagelake-{name}-{uuid.uuid4().hex[:12]}"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


#: For tables whose rows have up to a MB: row groups and pages of a few of them. Parquet by itself looks at their size
#: only after a hundred rows, and a row group is held whole by who writes and by who reads it.
LARGE_ROWS = {"parquet.block.size": 8 << 20, "parquet.page.size.row.check.min": 1, "parquet.page.size.row.check.max": 4}


def written(df: DataFrame, name: str, compression: str = "snappy", options: dict | None = None) -> DataFrame:
    """Write an intermediate table under the shared folder and read it back: what is
    above it runs once, its columns stay prunable, and a lost executor costs nothing."""
    path = scratch_path(df.sparkSession, name)
    df.write.options(compression=compression, **(options or {})).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def arrow_bytes(spark: SparkSession, most: int) -> Iterator[None]:
    """What runs within sends Arrow batches of about ``most`` bytes at most: a batch stands in the JVM's direct memory,
    in buffers of up to twice its size, and once more in the Python worker of each task."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, before)


def materialize(df: DataFrame, spark: SparkSession | None = None) -> DataFrame:
    """Cut lineage with a reliable checkpoint in the shared folder (survives executor loss)."""
    spark = spark or df.sparkSession
    shared_dir(spark)
    return df.checkpoint(eager=True)


def _is_scan(df: DataFrame) -> bool:
    """Whether the plan only reads, filters and projects (judged from the optimised plan, without running it)."""
    nodes = [line.lstrip("+-: ") for line in df._jdf.queryExecution().optimizedPlan().toString().splitlines()]
    return all(n.startswith(("Project", "Filter", "Relation", "LogicalRDD", "LocalRelation")) for n in nodes if n)


def spread(df: DataFrame, key: str | None = None) -> DataFrame:
    """Spread CPU-heavy per-row work over the cluster.

    When the scan yields fewer partitions than the cluster's parallelism (a
    small table or one large row group), hash-partition by ``key`` (no sort)
    to the default parallelism; a large scan that already has enough splits
    is left alone, so no shuffle is added at scale. ``key`` must be unique
    per row (an id); without one the rows are dealt round-robin, so copies of
    one value never pile up in one task. Only for scans: a plan with a shuffle
    in it has its own partitioning, and asking for its number of partitions
    would run it, so such a plan is returned as it is.
    """
    if not _is_scan(df):
        return df
    target = df.sparkSession.sparkContext.defaultParallelism
    if df.rdd.getNumPartitions() >= target:
        return df
    return df.repartition(target, key) if key else df.repartition(target)
