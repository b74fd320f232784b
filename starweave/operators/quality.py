"""Checks on loaded tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame, Observation, SparkSession, functions as F


def null_fractions(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Share of nulls per column, all columns in one pass over the table.

    An empty table gives null.
    """
    names = list(columns or df.columns)
    missing = [
        F.sum(F.when(F.col(f"`{c}`").isNull(), 1).otherwise(0)).cast("double") / F.count("*")
        for c in names
    ]
    rows = [
        F.struct(F.lit(c).alias("column"), m.alias("data_missing")) for c, m in zip(names, missing)
    ]
    return df.agg(F.array(*rows).alias("rows")).select(F.inline("rows"))


def gate_report(
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, Sequence[str]],
    expected: float = 0.0,
) -> DataFrame:
    """One row per checked column: table, column, data_missing, passed."""
    unknown = [t for t in checks if t not in tables]
    if unknown:
        raise KeyError(f"checks name unknown tables: {unknown}")
    reports = [
        null_fractions(tables[t], columns).select(F.lit(t).alias("table"), "*")
        for t, columns in checks.items()
    ]
    passed = F.coalesce(F.col("data_missing") == F.lit(expected), F.lit(False))
    return reduce(DataFrame.unionAll, reports).withColumn("passed", passed)


def gate(
    tables: Mapping[str, DataFrame],
    checks: Mapping[str, Sequence[str]],
    expected: float = 0.0,
) -> None:
    """Raise ``ValueError`` naming every check that did not pass."""
    failed = [
        f"{r['table']}.{r['column']}: {r['data_missing']}"
        for r in gate_report(tables, checks, expected).filter("not passed").collect()
    ]
    if failed:
        raise ValueError(f"missing values, expected {expected}: " + "; ".join(failed))


@dataclass(frozen=True)
class Measured:
    """Nulls per column, true flags and rows, counted while rows are on their way to somewhere."""

    columns: tuple[str, ...]
    flags: tuple[str, ...] = ()
    observation: Observation = field(default_factory=Observation)

    def on(self, df: DataFrame) -> DataFrame:
        """The same rows, counted when they are written. Put it last, in the stage that
        writes: a stage before a shuffle may be run more than once."""
        nulls = [F.count_if(F.col(f"`{c}`").isNull()).alias(f"nulls_{i}") for i, c in enumerate(self.columns)]
        true = [F.count_if(F.col(f"`{c}`")).alias(f"true_{i}") for i, c in enumerate(self.flags)]
        return df.observe(self.observation, F.count(F.lit(1)).alias("rows"), *nulls, *true)

    def told(self, flag: str) -> int:
        """Rows with a true flag, after the write."""
        return self.observation.get.get(f"true_{self.flags.index(flag)}", 0)

    def missing(self) -> dict[str, float | None]:
        """Share of nulls per column after the write; null for no rows, as ``null_fractions``."""
        found = self.observation.get
        rows = found.get("rows", 0)
        return {c: found[f"nulls_{i}"] / rows if rows else None for i, c in enumerate(self.columns)}


def measured_report(
    spark: SparkSession, missing: Mapping[str, Mapping[str, float | None]], expected: float = 0.0
) -> DataFrame:
    """The rows of ``gate_report`` from shares that were measured during a write."""
    rows = [(t, c, share, share is not None and share == expected) for t, columns in missing.items() for c, share in columns.items()]
    return spark.createDataFrame(rows, "`table` string, `column` string, data_missing double, passed boolean")


def gate_measured(missing: Mapping[str, Mapping[str, float | None]], expected: float = 0.0) -> None:
    """The gate over shares by table and column that were measured during a write."""
    failed = [
        f"{t}.{c}: {share}"
        for t, columns in missing.items()
        for c, share in columns.items()
        if share != expected
    ]
    if failed:
        raise ValueError(f"missing values, expected {expected}: " + "; ".join(failed))


def repeated_keys(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with the number of rows."""
    return df.groupBy(*key).agg(F.count("*").alias("rows")).filter("rows > 1")


def fanout_report(df: DataFrame, key: Sequence[str]) -> DataFrame:
    """Join keys that multiply the rows of the other side.

    One row: keys, repeated keys, largest number of rows of one key.
    """
    sizes = df.groupBy(*key).agg(F.count("*").alias("rows"))
    return sizes.agg(
        F.count("*").alias("keys"),
        F.count_if(F.col("rows") > 1).alias("repeated"),
        F.max("rows").alias("largest"),
    )


def join_size(left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]]) -> DataFrame:
    """How many rows an inner join will have, without joining the rows.

    Rows are counted per key on each side (with partial sums, so a hot key is one row per
    task), and the products of the counts are summed. One row: keys that
    meet, their rows on each side, rows of the join, and the most that one key gives.
    """
    names = [f"k{i}" for i in range(len(on))]
    sides = []
    for df, columns, count in ((left, [a for a, _ in on], "n"), (right, [b for _, b in on], "m")):
        keys = df.select(*(F.col(f"`{c}`").alias(k) for c, k in zip(columns, names)))
        # A null key meets nothing.
        sides.append(keys.dropna().groupBy(*names).agg(F.count("*").alias(count)))
    product = F.col("n").cast("decimal(19,0)") * F.col("m").cast("decimal(18,0)")
    return sides[0].join(sides[1], names).agg(
        F.count("*").alias("keys"),
        *(F.coalesce(F.sum(c), F.lit(0)).alias(a) for c, a in (("n", "left_rows"), ("m", "right_rows"))),
        F.coalesce(F.sum(product), F.lit(0)).cast("decimal(38,0)").alias("join_rows"),
        F.max(product).cast("decimal(38,0)").alias("largest"),
    )


def check_join_size(
    left: DataFrame, right: DataFrame, on: Sequence[tuple[str, str]], most: int
) -> int:
    """The rows of an inner join, known before it is made; more than ``most`` are an error."""
    found = join_size(left, right, on).first()
    if found["join_rows"] > most:
        raise ValueError(
            f"the join on {list(on)} would have {found['join_rows']} rows, more than {most};"
            f" one key gives {found['largest']}"
        )
    return int(found["join_rows"])


def key_collisions(df: DataFrame, key: str, natural: Sequence[str]) -> DataFrame:
    """Keys that stand for more than one natural key, with the number."""
    pairs = df.select(key, *natural).dropDuplicates()
    return pairs.groupBy(key).agg(F.count("*").alias("natural_keys")).filter("natural_keys > 1")


def orphan_keys(fact: DataFrame, fact_key: str, dim: DataFrame, dim_key: str) -> DataFrame:
    """Fact keys without a dimension row, with the number of fact rows.

    The fact is counted per key before the join, so a hot key is one row there.
    """
    used = fact.groupBy(F.col(fact_key).alias("key")).agg(F.count("*").alias("rows"))
    known = dim.select(F.col(dim_key).alias("key"))
    return used.join(known, "key", "left_anti")
