"""Intermediate tables of one run, in the folder that all executors share."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starweave.session import delete_folder, scratch_dir

BATCH_ROWS = "spark.sql.execution.arrow.maxRecordsPerBatch"
#: Rows that go to Python at a time: whole texts make large batches.
MOST_ROWS = 1000
#: Narrow rows of a file, where their number is known.
FILE_ROWS = 500_000
#: Rows up to which tables are put into one partition each.
TASK_ROWS = 20_000


def gathered(*tables: DataFrame, most: int = TASK_ROWS) -> tuple[DataFrame, ...]:
    """Stored tables, in one partition each if none has more than ``most`` rows: what joins and sums
    them then needs no shuffle. Their numbers of rows come from the files' footers.
    """
    if all(t.count() <= most for t in tables):
        return tuple(t.coalesce(1) for t in tables)
    return tables


class Scratch:
    """A folder of Parquet tables that belongs to one run of an operator.

    A written table cuts the lineage: a lost executor costs a re-read. Tables that
    the result no longer needs are dropped with ``drop``; those behind a lazy result
    stay until ``close`` is called.

    Lowers the session's Arrow batches to ``MOST_ROWS`` rows if they are larger, so that
    a task's memory is bounded by texts and not by their number.
    """

    def __init__(self, spark: SparkSession, label: str):
        self.spark = spark
        self.path = f"{scratch_dir(spark)}-{label}"
        rows = int(spark.conf.get(BATCH_ROWS, "0"))
        if rows <= 0 or rows > MOST_ROWS:
            spark.conf.set(BATCH_ROWS, str(MOST_ROWS))

    def keep(
        self, df: DataFrame, name: str, partition_by: str | None = None, rows: int | None = None
    ) -> DataFrame:
        """Write a table and return the stored one.

        ``rows`` tells about how many narrow rows there are, so that a small table does not
        become a file for each partition of the shuffle before it.
        """
        if rows is not None:
            df = df.coalesce(1 + rows // FILE_ROWS)
        writer = df.write.option("compression", "zstd")
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.parquet(f"{self.path}/{name}")
        return self.spark.read.schema(df.schema).parquet(f"{self.path}/{name}")

    def sub(self, name: str) -> Scratch:
        """A folder inside this one, for steps that name their tables alike."""
        inner = object.__new__(Scratch)
        inner.spark, inner.path = self.spark, f"{self.path}/{name}"
        return inner

    def drop(self, *names: str) -> None:
        """Delete tables, or the whole folder if none is named."""
        for path in [f"{self.path}/{n}" for n in names] or [self.path]:
            delete_folder(self.spark, path)

    def close(self) -> None:
        self.drop()
