"""Session setup and the shared folder for intermediate tables."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from functools import cache
from typing import TypeVar

from pyspark.sql import DataFrame, SparkSession, functions as F

BROADCAST_BYTES = "spark.starweave.broadcastBytes"
#: Of all Parquet files: ids that are hex text take half the bytes of the default.
COMPRESSION = "zstd"
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # A shuffle join is hashed, not sorted, if each build partition is this small.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "64m",
    # Largest measured dimension that a star join broadcasts.
    BROADCAST_BYTES: str(64 << 20),
    "spark.ui.enabled": "false",
    # Recording the call site of every column expression slows plan building.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def spark_session(app_name: str = "starweave", **settings: str) -> SparkSession:
    """Session with a fixed zone, ANSI casts and adaptive execution.

    Extra settings are given with ``__`` for the dots, for example
    ``spark__sql__shuffle__partitions="2000"``. The master comes from
    spark-submit or from ``spark__master``.
    """
    builder = SparkSession.builder.appName(app_name)
    for name, value in SETTINGS.items():
        builder = builder.config(name, value)
    for name, value in settings.items():
        builder = builder.config(name.replace("__", "."), value)
    return builder.getOrCreate()


@cache
def _local_folder() -> str:
    return tempfile.mkdtemp(prefix="starweave-")


def scratch_dir(spark: SparkSession) -> str:
    """A new folder path below the one named by ``spark.checkpoint.dir``.

    Every executor must see the folder, so a temporary folder of this machine
    is used only where the setting is missing and Spark runs in local mode.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.conf.get("spark.master", "").startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
        base = _local_folder()
    _SCRATCH.append(f"{base.rstrip('/')}/starweave-{uuid.uuid4().hex}")
    return _SCRATCH[-1]


def clear_scratch(spark: SparkSession) -> None:
    """Delete all scratch folders that this process has made.

    A job deletes its own. What stands behind a lazy result cannot go before the result
    has been read; this is for afterwards.
    """
    while _SCRATCH:
        path = _SCRATCH.pop()
        # Operators put their name behind that of the folder.
        jvm, conf = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        pattern = jvm.org.apache.hadoop.fs.Path(f"{path}*")
        for found in pattern.getFileSystem(conf).globStatus(pattern) or []:
            delete_folder(spark, str(found.getPath()))


_SCRATCH: list[str] = []
T = TypeVar("T")


def concurrently(jobs: Iterable[Callable[[], T]]) -> list[T]:
    """Start independent jobs together, so that a small one does not wait for
    the last tasks of a large one. The first error is raised after all ended."""
    jobs = list(jobs)
    if not jobs:
        return []
    with ThreadPoolExecutor(max_workers=len(jobs)) as pool:
        return [f.result() for f in [pool.submit(job) for job in jobs]]


def _located(spark: SparkSession, path: str):
    """A path and the file system it is in."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where, where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def delete_folder(spark: SparkSession, path: str) -> None:
    """Delete a folder with all it holds, through the file system it is in."""
    where, files = _located(spark, path)
    files.delete(where, True)


def folder_exists(spark: SparkSession, path: str) -> bool:
    where, files = _located(spark, path)
    return files.exists(where)


def folder_names(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders in a folder, none if there is no such folder."""
    where, files = _located(spark, path)
    if not files.exists(where):
        return []
    return [str(f.getPath().getName()) for f in files.listStatus(where) if f.isDirectory()]


def folder_bytes(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder, from the file system's own summary."""
    where, files = _located(spark, path)
    return files.getContentSummary(where).getLength() if files.exists(where) else 0


def rename_folder(spark: SparkSession, path: str, to: str) -> None:
    """Rename a folder within its file system; an error if that cannot be done."""
    where, files = _located(spark, path)
    if not files.rename(where, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


#: Most files that the tasks of one write make in all, if each writes to every bucket.
MOST_FILES = 30_000
#: Buckets may be so many times larger than asked for, if there would be too many files else.
LARGER = 4
SPLIT_BYTES = "spark.sql.files.maxPartitionBytes"
#: A bucket is hot if it has this many times the mean, and more rows than a task minds.
HOT_TIMES, HOT_ROWS = 4, 2_000_000
_TOGETHER: dict[str, list[str]] = {}


@contextmanager
def settings(spark: SparkSession, values: dict[str, str]) -> Iterator[None]:
    """Set session settings for a while."""
    before = {n: spark.conf.get(n, None) for n in values}
    for name, value in values.items():
        spark.conf.set(name, value)
    try:
        yield
    finally:
        for name, value in before.items():
            if value is None:
                spark.conf.unset(name)
            else:
                spark.conf.set(name, value)


def split_bytes(spark: SparkSession) -> int:
    """Bytes of files that a task reads at most."""
    text = spark.conf.get(SPLIT_BYTES)
    return spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(text)


def short_tasks(spark: SparkSession, size: int) -> dict[str, str]:
    """A setting that lets a task read no more than this: what it sorts on the way to its buckets stays in memory."""
    return {SPLIT_BYTES: str(min(size, split_bytes(spark)))}


def few_files(spark: SparkSession, size: int, buckets: int) -> bool:
    """Whether tasks that read this many bytes can each write to every bucket."""
    tasks = max(spark.sparkContext.defaultParallelism, -(-size // split_bytes(spark)))
    return tasks * buckets <= MOST_FILES


def bucket_number(spark: SparkSession, size: int, each: int) -> int:
    """Buckets of ``each`` to twice as many bytes, one a core at least, up to ``LARGER`` times larger ones if there would be
    too many files.

    A power of two: of rows that lie in buckets by a key, those of one go to few buckets of another number.
    """
    least = buckets = 1 << (spark.sparkContext.defaultParallelism - 1).bit_length()
    while buckets * 2 * each <= size:
        buckets *= 2
    while buckets > least and size * 2 <= LARGER * each * buckets and not few_files(spark, size, buckets):
        buckets //= 2
    return buckets


def stored_together(
    df: DataFrame,
    key: Sequence[str],
    buckets: int,
    label: str,
    folder: str,
    partition_by: str | None = None,
    shuffle: bool = False,
) -> tuple[DataFrame, bool]:
    """``materialize`` into buckets hashed by a key, so that what groups or joins by it needs no shuffle.

    Rows go to their buckets as they are written, without a shuffle unless ``shuffle`` is set, which
    makes one file a bucket. The second value is False if a bucket is hot: the rows are then
    read as plain files, whose shuffles adaptive execution can split. ``drop_together``
    takes the tables of a folder out of the catalog.
    """
    spark, path = df.sparkSession, f"{folder}/{label}"
    name = f"starweave_{uuid.uuid4().hex}"
    rows = df.repartition(buckets, *key) if shuffle else df
    writer = rows.write.format("parquet").option("compression", COMPRESSION).option("path", path)
    writer = writer.partitionBy(partition_by) if partition_by else writer
    _TOGETHER.setdefault(folder, []).append(name)
    writer.bucketBy(buckets, *key).saveAsTable(name)
    if not even_buckets(spark.table(name), key, buckets):
        return spark.read.schema(df.schema).parquet(path), False
    return spark.table(name), True


def even_buckets(df: DataFrame, key: Sequence[str], buckets: int) -> bool:
    """Whether no bucket of the rows by a key is hot."""
    sizes = df.groupBy(F.pmod(F.hash(*key), F.lit(buckets)).alias("b")).agg(F.count("*").alias("n"))
    found = sizes.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    most, mean = found["most"] or 0, (found["all"] or 0) / buckets
    return most <= max(HOT_TIMES * mean, HOT_ROWS)


def drop_together(spark: SparkSession, folder: str) -> None:
    """Forget the tables that ``stored_together`` made in a folder; the files go with the folder."""
    for name in _TOGETHER.pop(folder, []):
        spark.sql(f"DROP TABLE IF EXISTS {name}")


def materialize(
    df: DataFrame, label: str, folder: str | None = None, partition_by: str | None = None
) -> DataFrame:
    """Write ``df`` to a Parquet table in the shared folder and read it back.

    ``folder`` is the scratch folder of a run, for the run to delete at its end.

    Cuts the lineage: later readers scan only the columns they need, and a lost
    executor costs a re-read, not a recomputation.
    """
    path = f"{folder or scratch_dir(df.sparkSession)}/{label}"
    writer = df.write.option("compression", COMPRESSION)
    (writer.partitionBy(partition_by) if partition_by else writer).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
