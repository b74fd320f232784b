"""Row cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from starweave.operators.dedup import alone_and_several, repeated_digests


def distinct_rows(df: DataFrame) -> DataFrame:
    """Whole-row distinct: a partial hash aggregate runs before the shuffle."""
    return df.dropDuplicates()


def distinct_rows_late(df: DataFrame, folder: str | None = None) -> DataFrame:
    """Whole-row distinct that shuffles whole rows only where a digest repeats.

    A pass over the rows shuffles a 64-bit digest of each. Rows whose digest is met once are
    different from all others and stay where they are; the others are compared by
    equality, so digests that are equal by chance do no harm. Repeated digests are broadcast to
    tell the two apart. If they are too many for that (``spark.starweave.broadcastBytes``), much of the
    table is repeated and ``distinct_rows`` does the work. The rows are read three times.
    """
    repeated = repeated_digests(df, df.columns, folder)
    if repeated is None:
        return distinct_rows(df)
    alone, several = alone_and_several(df, df.columns, repeated)
    return alone.unionAll(several.dropDuplicates())


def complete(df: DataFrame, columns: list[str] | None = None) -> str:
    """The test that no column is null, or NaN in a float column.

    Written as one test per column, so that the null tests reach the Parquet
    reader.
    """
    types = dict(df.dtypes)
    tests = []
    for name in columns or df.columns:
        tests.append(f"`{name}` IS NOT NULL")
        if types[name] in ("float", "double"):
            tests.append(f"NOT isnan(`{name}`)")
    return " AND ".join(tests)


def drop_null_rows(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Drop rows with a null, or a NaN in a float column, in any column."""
    return df.filter(complete(df, columns))


def clean(df: DataFrame) -> DataFrame:
    """Complete rows, each once."""
    return distinct_rows(drop_null_rows(df))
