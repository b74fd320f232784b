"""Row ids."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window, functions as F

from starweave.functions.keys import digest_key
from starweave.session import materialize

# Documented layout of monotonically_increasing_id: partition number above,
# row number within the partition in the low 33 bits.
ROW_BITS = 33


def add_surrogate(
    df: DataFrame, name: str, kind: str = "monotonic", columns: Sequence[str] = ()
) -> DataFrame:
    """Put an id column in front.

    ``monotonic``: unique 64-bit, without a shuffle, differs from run to run.
    ``digest``: 128-bit digest of the natural key ``columns`` (all if none given), stable.
    ``dense``: 0..n-1 in the order of ``columns`` (all columns if none given).
    """
    if kind == "monotonic":
        return df.select(F.monotonically_increasing_id().alias(name), "*")
    if kind == "digest":
        return df.select(digest_key(*(columns or df.columns)).alias(name), "*")
    if kind == "dense":
        return _dense(df, name, list(columns) or df.columns)
    raise ValueError(f"unknown kind of id: {kind}")


def _dense(df: DataFrame, name: str, order: list[str]) -> DataFrame:
    # The first written table fixes the tie-break, so that a hot value is split
    # over several ranges and a retried task sees the same rows. The second one
    # fixes the place of each row. No step needs all rows in one task.
    fixed = materialize(df.withColumn("_tie", F.monotonically_increasing_id()), "dense-input")
    ordered = fixed.repartitionByRange(*order, "_tie").sortWithinPartitions(*order, "_tie")
    placed = materialize(
        ordered.drop("_tie").withColumn("_place", F.monotonically_increasing_id()), "dense-order"
    )
    part = F.shiftrightunsigned("_place", ROW_BITS)
    sizes = placed.groupBy(part.alias("_part")).agg(F.count("*").alias("_rows"))
    # One row per range partition: the bound is spark.sql.shuffle.partitions.
    before = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start")
    )
    position = F.col("_place").bitwiseAND(F.lit((1 << ROW_BITS) - 1))
    return (
        placed.withColumn("_part", part)
        .join(F.broadcast(starts), "_part")
        .select((F.col("_start") + position).alias(name), *df.columns)
    )
