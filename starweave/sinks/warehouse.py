"""Typed catalog tables: create, truncate, load, statistics."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession

from starweave.operators.dedup import latest_per_key, latest_version_rows
from starweave.operators.layout import bucketed, range_sorted, z_ordered
from starweave.operators.quality import Measured
from starweave.session import (
    COMPRESSION,
    bucket_number,
    delete_folder,
    drop_together,
    few_files,
    folder_bytes,
    scratch_dir,
    stored_together,
)
from starweave.sources.staged import RUN_DATE, read_stage, staged_days

#: Staged bytes of a table for each bucket that its days are brought together in.
BUCKET_BYTES = 32 << 20


@dataclass(frozen=True)
class TableSpec:
    """A warehouse table and where its rows come from.

    ``columns`` is the DDL column list. ``sort`` orders the files for data
    skipping. ``buckets`` hashes rows by ``bucket_by`` into that many buckets,
    for joins without a shuffle; choose a key that is unique or evenly spread,
    as a bucket is one task. ``partition_by`` names last columns that make a folder each, for
    pruning; few values. ``zorder`` clusters by several columns at once, so that a range
    of any of them skips most of the files. ``replicate`` marks a table meant to be copied to
    every executor in joins, which happens while its measured size allows it.
    ``key`` tells which rows of several days are the same thing; ``unique`` whether a
    day has one row of each. ``direct`` sends rows to their buckets as they are written, without a
    shuffle: a bucket then has a file of each task that has rows of it.
    """

    name: str
    columns: str
    source: str = ""
    sort: tuple[str, ...] = ()
    bucket_by: tuple[str, ...] = ()
    buckets: int = 0
    partition_by: tuple[str, ...] = ()
    zorder: tuple[str, ...] = ()
    replicate: bool = False
    key: tuple[str, ...] = ()
    unique: bool = True
    direct: bool = False

    def ddl(self, database: str) -> str:
        layout = f" PARTITIONED BY ({', '.join(self.partition_by)})" if self.partition_by else ""
        if self.buckets:
            layout += f" CLUSTERED BY ({', '.join(self.bucket_by)})"
            if self.sort:
                layout += f" SORTED BY ({', '.join(self.sort)})"
            layout += f" INTO {self.buckets} BUCKETS"
        return (
            f"CREATE TABLE IF NOT EXISTS {database}.{self.name} ({self.columns})"
            f" USING parquet OPTIONS (compression '{COMPRESSION}'){layout}"
        )


def create_tables(
    spark: SparkSession, specs: Sequence[TableSpec], database: str, location: str | None = None
) -> None:
    """Create the database and the missing tables; existing ones stay."""
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    for spec in specs:
        spark.sql(spec.ddl(database))


def truncate(spark: SparkSession, database: str, table: str) -> None:
    """Remove all rows."""
    spark.sql(f"TRUNCATE TABLE {database}.{table}")


def load(
    df: DataFrame,
    spec: TableSpec,
    database: str,
    mode: str = "replace",
    measure: Sequence[str] = (),
) -> Measured:
    """Load rows, columns by position, in the layout of the table.

    ``replace`` is one statement that overwrites the table, ``append`` adds.
    Text longer than its VARCHAR and a wrong number of columns are errors. Nulls of the
    ``measure`` columns are counted on the way.
    """
    if mode not in ("replace", "append"):
        raise ValueError(f"unknown load mode: {mode}")
    spark = df.sparkSession
    target = f"{database}.{spec.name}"
    names = spark.table(target).columns
    if len(names) != len(df.columns):
        raise ValueError(f"{target} has {len(names)} columns, the rows have {len(df.columns)}")
    df = df.toDF(*names)
    if spec.buckets and spec.direct:
        pass
    elif spec.buckets:
        df = bucketed(df, list(spec.bucket_by), spec.buckets)
    elif spec.zorder:
        df = z_ordered(df, list(spec.zorder))
    elif spec.sort or spec.partition_by:
        df = range_sorted(df, [*spec.partition_by, *spec.sort])
    measured = Measured(tuple(measure))
    rows = measured.on(df) if measure else df
    rows.write.insertInto(target, overwrite=mode == "replace")
    return measured


def load_staged(
    spark: SparkSession,
    spec: TableSpec,
    database: str,
    root: str,
    run_date: str = "latest",
    mode: str = "replace",
    named: bool = True,
    newest: bool = False,
    measure: Sequence[str] = (),
    table: str | None = None,
) -> Measured:
    """Load a warehouse table from its staged table.

    ``newest`` keeps of each key only what the last day that has it says, which
    matters where several days are loaded. ``table`` is the name in the database, if it is not
    that of the spec. Where only one day is staged there is nothing to choose from. The rows of
    several days are stored in buckets by their key first, so the newest are found without a shuffle.
    """
    source = spec.source or spec.name
    target = replace(spec, name=table or spec.name)
    if newest and named and run_date == "all" and len(days := staged_days(spark, root, source)) == 1:
        newest, run_date = False, days[0]
    if not newest:
        rows = read_stage(spark, root, source, run_date, named)
        return load(rows, target, database, mode, measure)
    days = read_stage(spark, root, source, run_date, named, with_run_date=True)
    folder = scratch_dir(spark)
    size = folder_bytes(spark, f"{root.rstrip('/')}/{source}")
    buckets = spec.buckets or bucket_number(spark, size, BUCKET_BYTES)
    try:
        shuffle = not few_files(spark, size, buckets)
        days, together = stored_together(days, spec.key, buckets, "days", folder, shuffle=shuffle)
        if spec.unique:
            rows = latest_per_key(days, spec.key, RUN_DATE)
        else:
            rows = latest_version_rows(days, spec.key, RUN_DATE, folder, together)
        return load(rows.drop(RUN_DATE), target, database, mode, measure)
    finally:
        drop_together(spark, folder)
        delete_folder(spark, folder)


def merge_day(loaded: DataFrame, day: DataFrame, key: Sequence[str]) -> DataFrame:
    """What is loaded, with the rows of a later day in place of those of its keys.

    The loaded rows are the merged state of all days before: of each key what the last
    of them said. So no earlier day is read again. Keys hold no null.
    """
    names = loaded.columns
    day = day.toDF(*names)
    return loaded.join(day.select(*key), list(key), "left_anti").select(*names).unionAll(day)


def analyze(spark: SparkSession, database: str, table: str) -> None:
    """Collect size and row count for the optimizer."""
    spark.sql(f"ANALYZE TABLE {database}.{table} COMPUTE STATISTICS")
