"""Physical order of rows before a write."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

#: Bits of a Z-order key: what a long holds without its sign.
KEY_BITS = 62


def range_sorted(df: DataFrame, columns: list[str], spread: list[str] | None = None) -> DataFrame:
    """Global sort for data skipping: ranges over tasks, sorted within each.

    ``spread`` (default: all other columns) continues the range key, so that a
    value shared by a large part of the rows is split over several tasks.
    """
    if spread is None:
        spread = [c for c in df.columns if c not in columns]
    ranged = df.repartitionByRange(*columns, *spread)
    return ranged.sortWithinPartitions(*columns)


def bucketed(df: DataFrame, columns: list[str], buckets: int) -> DataFrame:
    """Rows hashed like the buckets of a table: one task and file per bucket.

    For keys that are unique, or known to be spread evenly.
    """
    return df.repartition(buckets, *columns)


def z_key(columns: list[Column], bits: int) -> Column:
    """Bits of whole numbers below 2^bits, interleaved: the highest ones first."""
    parts = [
        F.shiftleft(F.shiftright(c, b).bitwiseAND(F.lit(1).cast("long")), b * len(columns) + i)
        for i, c in enumerate(reversed(columns))
        for b in range(bits)
    ]
    return reduce(Column.bitwiseOR, parts)


def z_ordered(df: DataFrame, columns: list[str]) -> DataFrame:
    """Rows along a Z-order curve over numeric columns: ranges over tasks, sorted in each.

    A file or row group then covers a small box, so a range of any one of the columns skips
    most of them; a compound sort does that for its first column only. Columns are
    scaled between their least and largest value, found in one pass over these columns
    alone. Nulls and NaN come first; a column of one value has no weight.
    """
    bits = KEY_BITS // len(columns)
    number = [F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in columns]
    ends = df.select(*(n.alias(f"c{i}") for i, n in enumerate(number))).agg(
        *(f(f"c{i}").alias(f"{a}{i}") for i in range(len(columns)) for f, a in ((F.min, "lo"), (F.max, "hi")))
    ).first()
    scaled = []
    top = float((1 << bits) - 1)
    for i, n in enumerate(number):
        low, high = ends[f"lo{i}"], ends[f"hi{i}"]
        if low is None or low == high:
            continue
        # Halves first, so that the width of the range is finite too.
        share = (n / 2 - F.lit(low / 2)) / F.lit(high / 2 - low / 2)
        scaled.append(F.coalesce(F.least(F.greatest(share, F.lit(0.0)), F.lit(1.0)) * top, F.lit(0.0)).cast("long"))
    if not scaled:
        return range_sorted(df, columns)
    keyed = df.withColumn("_z", z_key(scaled, bits))
    return range_sorted(keyed, ["_z"], columns).drop("_z")
