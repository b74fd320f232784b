"""One row per key."""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from starweave.session import BROADCAST_BYTES, materialize


#: Whether several natural keys share a key.
SEVERAL = "_several"
#: Bytes that a digest takes in a broadcast table.
DIGEST_BYTES = 32


def repeated_digests(
    df: DataFrame, columns: Sequence[str], folder: str | None = None, within: Sequence[str] = ()
) -> DataFrame | None:
    """Stored 64-bit digests (``_digest``) that several rows have over some columns, for a
    broadcast; None if they are too many for it (``spark.starweave.broadcastBytes``).

    Only digests are shuffled. Rows that are equal in the columns share a digest, so a row
    whose digest is met once has no equal; others may share it by chance. ``within`` names some
    of the columns that the rows are bucketed by: nothing is shuffled then.
    """
    digest = row_digest(columns).alias("_digest")
    met = df.select(*_quoted(within), digest).groupBy(*_quoted(within), "_digest")
    several = met.agg(F.count("*").alias("_n")).filter("_n > 1")
    repeated = materialize(several.select("_digest"), f"repeated-{uuid.uuid4().hex}", folder)
    most = int(df.sparkSession.conf.get(BROADCAST_BYTES, str(64 << 20))) // DIGEST_BYTES
    return None if repeated.count() > most else repeated  # from the files' footers


def row_digest(columns: Sequence[str]) -> Column:
    return F.xxhash64(*_quoted(columns))


def alone_and_several(
    df: DataFrame, columns: Sequence[str], repeated: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Rows that have no equal in the columns, and those that may; both stay where they are."""
    met = row_digest(columns) == F.col("_digest")
    return tuple(df.join(F.broadcast(repeated), met, how) for how in ("left_anti", "left_semi"))


def zero_floats(df: DataFrame) -> DataFrame:
    """The rows with -0.0 as 0.0, the same number."""
    zeros = {n: F.lit(0.0).cast(t) for n, t in df.dtypes if t in ("float", "double")}
    return df.select(
        *((F.col(f"`{c}`") + zeros[c]).alias(c) if c in zeros else f"`{c}`" for c in df.columns)
    )


def _names(key: str | Sequence[str]) -> list[str]:
    return [key] if isinstance(key, str) else list(key)


def one_per_key(
    df: DataFrame,
    key: str | Sequence[str],
    order: Sequence[str] = (),
    repeats: bool = False,
    among: DataFrame | None = None,
    rare: str | None = None,
    natural: Sequence[str] = (),
    within: Sequence[str] = (),
) -> DataFrame:
    """Keep the lowest row of each key, the same one in every run.

    Rows are compared by ``order``, then by the remaining columns from left to
    right. The minimum is taken in each input partition first, so a key holding
    a large share of the rows sends one row per partition to its reducer.

    ``repeats=True`` states that there are few different rows per key. They are
    then found by hash aggregation, without sorting the whole input. ``among``
    keeps only the keys it holds; the rows come down to one per key before they are
    joined with it. 0.0 and -0.0 are the same number and come out as 0.0.

    ``rare`` states that few keys repeat, and names the folder of the run. Only digests of the keys are
    then shuffled, and the rows of those that repeat; the others stay where they are. It
    does no harm if many keys repeat: all rows are shuffled then.

    With ``natural`` columns a last column, ``SEVERAL``, tells whether the rows of the key differ in them,
    by 64-bit digests: two that differ are taken for equal once in 2^64.

    ``within`` names columns that the rows are bucketed by, and few keys occur with several values of
    them. Rows come down to one per key and value where they are, without a shuffle; then ``rare`` holds.
    Without ``rare`` a key tells these columns, so that is all.
    A ``SEVERAL`` column that the rows have already is carried on.
    """
    keys = _names(key)
    columns = [c for c in df.columns if c != SEVERAL]
    df = zero_floats(df)
    if within:
        near = one_per_key(df, [*keys, *within], order, repeats, natural=natural)
        repeated = None if rare is None else repeated_digests(near, keys, rare)
        if rare is None:
            unique = near
        elif repeated is None:
            unique = one_per_key(near, keys, order, repeats, natural=natural)
        elif repeated.isEmpty():
            unique = near
        else:
            alone, several = alone_and_several(near, keys, repeated)
            unique = alone.unionAll(one_per_key(several, keys, order, repeats, natural=natural))
        return unique if among is None else unique.join(among, keys, "left_semi")
    if rare is not None and (repeated := repeated_digests(df, keys, rare)) is not None:
        alone, several = alone_and_several(df, keys, repeated)
        if natural:
            alone = alone.withColumn(SEVERAL, F.lit(False))
        unique = alone.unionAll(one_per_key(several, keys, order, repeats, natural=natural))
        return unique if among is None else unique.join(among, keys, "left_semi")
    rest = [*order, *(c for c in columns if c not in keys and c not in order)]
    if not rest:
        unique = df.dropDuplicates()
        if natural:
            unique = unique.withColumn(SEVERAL, F.lit(False))
    else:
        if repeats:
            # The count keeps Spark from taking this aggregate for one that the minimum
            # makes needless.
            rows = df.groupBy(*_quoted(columns)).agg(F.count("*").alias("_repeats"))
            df = rows.filter("_repeats > 0").drop("_repeats")
        told, flag = [], []
        if natural:
            one = row_digest(natural)
            differ = F.min(one) != F.max(one)
            told = [(differ | F.max(SEVERAL) if SEVERAL in df.columns else differ).alias(SEVERAL)]
            flag = [SEVERAL]
        if len(rest) == 1 and _fixed_width(df, rest[0]):
            # A plain minimum is hash aggregated; null is lowest, as in a struct.
            value = F.col(f"`{rest[0]}`")
            lowest = F.when(F.count_if(value.isNull()) == 0, F.min(value)).alias(rest[0])
            unique = df.groupBy(*_quoted(keys)).agg(lowest, *told).select(*_quoted(columns), *flag)
        else:
            lowest = F.min(F.struct(*_quoted(rest))).alias("_row")
            unique = df.groupBy(*_quoted(keys)).agg(lowest, *told).select(
                *(f"`{c}`" if c in keys else f"_row.`{c}`" for c in columns), *flag
            )
    return unique if among is None else unique.join(among, keys, "left_semi")


def _quoted(names: Sequence[str]) -> list[str]:
    return [f"`{n}`" for n in names]


def _fixed_width(df: DataFrame, name: str) -> bool:
    return dict(df.dtypes)[name] in (
        "tinyint", "smallint", "int", "bigint", "float", "double", "date", "timestamp", "timestamp_ntz",
    )


def latest_version_rows(
    df: DataFrame,
    key: str | Sequence[str],
    version: str,
    folder: str | None = None,
    together: bool = False,
) -> DataFrame:
    """All rows of each key's highest ``version``, as often as they are there.

    The highest versions are stored before the join, so that adaptive execution can
    split a hot key. Rows that are bucketed by the key (``together``) are joined where they are.
    """
    keys = _names(key)
    newest = df.groupBy(*_quoted(keys)).agg(F.max(f"`{version}`").alias(version))
    if together:
        joined = df.join(newest.withColumnRenamed(version, "_newest"), keys)
        # Not an equation, which would become a join key that the rows are not bucketed by.
        return joined.filter(F.col(f"`{version}`") >= F.col("_newest")).select(*_quoted(df.columns))
    return df.join(materialize(newest, "newest", folder), [*keys, version]).select(*_quoted(df.columns))


def latest_per_key(df: DataFrame, key: str | Sequence[str], version: str) -> DataFrame:
    """Keep the row with the highest ``version`` of each key."""
    keys = _names(key)
    rest = [version, *(c for c in df.columns if c not in keys and c != version)]
    highest = df.groupBy(*_quoted(keys)).agg(F.max(F.struct(*_quoted(rest))).alias("_row"))
    return highest.select(*(f"`{c}`" if c in keys else f"_row.`{c}`" for c in df.columns))
