"""Session settings and the shared staging folder."""

from __future__ import annotations

import gc
import shutil
import tempfile
import uuid
from collections.abc import Iterator, Sequence
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Runtime-settable SQL options the jobs rely on. Timestamps are UTC throughout; skewed
# shuffle partitions are split and small ones merged by AQE; a sort-merge join becomes a
# hash join only when AQE has measured every build partition below the limit.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # HTML rows are wide: bound the Arrow batches by bytes, not only by row count.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "4m",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply :data:`SQL_SETTINGS` to a running session and give its workers this package."""
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    _ship(spark)
    return spark


def _ship(spark: SparkSession) -> None:
    """Send the package to the Python workers once, as an archive that Spark distributes."""
    package = Path(__file__).resolve().parent
    if not package.is_dir() or spark.conf.get("spark.newsloom.shipped", None) == spark.sparkContext.applicationId:
        return
    archive = shutil.make_archive(f"{tempfile.mkdtemp(prefix='newsloom-')}/newsloom", "zip", package.parent, package.name)
    spark.sparkContext.addPyFile(archive)
    spark.conf.set("spark.newsloom.shipped", spark.sparkContext.applicationId)


def local_session(cpus: int | str = 8, app: str = "newsloom", **extra: str) -> SparkSession:
    """A single-machine session for tests and benchmarks."""
    builder = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", str(cpus))
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    for key, value in extra.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return configure(spark)


def staging_root(spark: SparkSession) -> str:
    """The shared folder named by ``spark.checkpoint.dir``.

    A machine-local folder is chosen only for a local master, where the setting may be unset.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if root:
        return root.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a shared folder on a cluster")
    root = tempfile.mkdtemp(prefix="newsloom-")
    spark.conf.set("spark.checkpoint.dir", root)
    return root


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage like a checkpoint, survives lost executors, and the columnar copy lets
    every later branch read only the columns it needs instead of repeating the extraction.
    """
    return _write_and_read(df, f"{staging_root(df.sparkSession)}/{name}-{uuid.uuid4().hex}", compression="zstd")


def few(df: DataFrame, bound: int = 4_000_000) -> DataFrame:
    """Narrow rows marked for broadcast if there are at most ``bound``, so the other side need not move."""
    return F.broadcast(df) if df.count() <= bound else df


def picked(rows: DataFrame, on: Sequence[str], kept: DataFrame, dropped: DataFrame, bound: int = 1_000_000) -> DataFrame:
    """The rows whose key is in ``kept``; every other key of ``rows`` is in ``dropped``.

    The side that has at most ``bound`` narrow rows is broadcast, so wide rows move only if both have more.
    """
    for keys, how in ((dropped, "left_anti"), (kept, "left_semi")):
        if keys.count() <= bound:
            whole = rows.dropna(subset=list(on))  # null keys match nothing
            return whole.join(F.broadcast(keys.select(*on)), list(on), how)
    return rows.join(kept.select(*on), list(on), "left_semi")


def collect_garbage(spark: SparkSession) -> None:
    """Drop the plans, broadcasts and shuffles of queries that nothing refers to any more."""
    gc.collect()
    spark._jvm.System.gc()


@contextmanager
def shuffles_removed(*sessions: SparkSession) -> Iterator[None]:
    """Shuffle files go when the query that wrote them ends; else they stay until the driver happens to
    collect its garbage, and those of all earlier queries lie on disk together. The driver's plans of these
    queries are collected at the end, with the broadcasts they hold."""
    key = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = [spark.conf.get(key) for spark in sessions]
    try:
        for spark in sessions:
            spark.conf.set(key, "true")
        yield
    finally:
        for spark, value in zip(sessions, before, strict=True):
            spark.conf.set(key, value)
        collect_garbage(sessions[0])


def _write_and_read(df: DataFrame, path: str, **options: str) -> DataFrame:
    df.write.mode("errorifexists").parquet(path, **options)
    return df.sparkSession.read.schema(df.schema).parquet(path)


class Staging:
    """:func:`stage` for one run: all copies lie in one folder that goes away with the run.

    ``options`` are those of the writer, such as ``compression``.
    """

    def __init__(self, spark: SparkSession, **options: str) -> None:
        self._spark = spark
        self._options = options
        self.path = f"{staging_root(spark)}/run-{uuid.uuid4().hex}"

    def __call__(self, df: DataFrame, name: str) -> DataFrame:
        return _write_and_read(df, f"{self.path}/{name}/{uuid.uuid4().hex}", **self._options)

    def __enter__(self) -> Staging:
        return self

    def __exit__(self, *_: object) -> None:
        self.remove()

    def remove(self, name: str | None = None) -> None:
        """Delete the copies, or those called ``name``; nothing may read them any more."""
        folder = self._spark._jvm.org.apache.hadoop.fs.Path(f"{self.path}/{name}" if name else self.path)
        folder.getFileSystem(self._spark._jsc.hadoopConfiguration()).delete(folder, True)


def unstaged(df: DataFrame, name: str) -> DataFrame:
    """Stand-in for :func:`stage` that keeps the plan lazy."""
    return df


def spread(scan: DataFrame) -> DataFrame:
    """Give a scan of few splits to all cores before per-row Python work.

    Looks at the splits only. A scan that already has a split per core is left as it is, so
    large tables are never moved.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    splits = scan.rdd.getNumPartitions()
    return scan if splits >= cores else scan.repartition(min(cores, 8 * splits))
