"""Quality checks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starweave.functions import prefix_key
from starweave.operators import quality
from starweave.queries.roles import table
from starweave.queries.values import labelled
from starweave.session import scratch_dir
from starweave.sinks.stage import stage_all


def null_fraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.null_fractions(labelled(spark, sf_dir))


CHECKS = {
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey"],
    "documents": ["doc_id", "quality"],
    "returns": ["l_orderkey"],
}


def _checked(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    lineitem = table(spark, sf_dir, "lineitem")
    return {
        "orders": table(spark, sf_dir, "orders"),
        "lineitem": lineitem,
        "documents": labelled(spark, sf_dir),
        "returns": lineitem.filter("l_quantity < 0"),  # no such rows
    }


def quality_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.gate_report(_checked(spark, sf_dir), CHECKS)


def quality_gate_observed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report, counted while the tables are staged: nothing is read for it."""
    measured = {t: quality.Measured(tuple(columns)) for t, columns in CHECKS.items()}
    tables = {t: measured[t].on(df) for t, df in _checked(spark, sf_dir).items()}
    stage_all(tables, scratch_dir(spark), "20240101")
    return quality.measured_report(spark, {t: m.missing() for t, m in measured.items()})


def join_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the join of all line items with all line items of the same part, not joined."""
    items = table(spark, sf_dir, "lineitem")
    found = quality.join_size(items, items, [("l_partkey", "l_partkey")])
    return found.select(
        "keys", "left_rows", "right_rows",
        F.col("join_rows").cast("long").alias("join_rows"),
        F.col("largest").cast("long").alias("largest"),
    )


def repeated_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.repeated_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


def orphan_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders without items."""
    return quality.orphan_keys(
        table(spark, sf_dir, "orders"), "o_orderkey", table(spark, sf_dir, "lineitem"), "l_orderkey"
    )


def fanout_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.fanout_report(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linestatus"])


def key_collisions(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").withColumn(
        "performance_id", prefix_key("o_orderkey", "o_custkey", prefix_len=1, sep="-")
    )
    return quality.key_collisions(orders, "performance_id", ["o_orderkey", "o_custkey"])


QUERIES = {
    "null_fraction": null_fraction,
    "quality_gate": quality_gate,
    "quality_gate_observed": quality_gate_observed,
    "join_fanout": join_fanout,
    "repeated_keys": repeated_keys,
    "orphan_keys": orphan_keys,
    "fanout_report": fanout_report,
    "key_collisions": key_collisions,
}


def _missing(name: str, source: str) -> str:
    """One minus the share of values that are there; null for a table without rows."""
    return f"1 - count({name}) / nullif(count(*), 0)::DOUBLE AS data_missing FROM {source}"


_LABELLED = "documents LEFT JOIN labels USING (doc_id)"
_GATE = (
    ("orders", "o_orderkey", "orders"),
    ("orders", "o_custkey", "orders"),
    ("lineitem", "l_orderkey", "lineitem"),
    ("documents", "doc_id", _LABELLED),
    ("documents", "quality", _LABELLED),
    ("returns", "l_orderkey", "lineitem WHERE l_quantity < 0"),
)

_GATE_SQL = (
    'SELECT "table", "column", data_missing,'
    " coalesce(data_missing = 0.0, false) AS passed FROM ("
    + "\nUNION ALL ".join(
        f"SELECT '{t}' AS \"table\", '{c}' AS \"column\", {_missing(c, s)}" for t, c, s in _GATE
    )
    + ")"
)

ORACLES = {
    "null_fraction": "\nUNION ALL ".join(
        f"SELECT '{c}' AS \"column\", {_missing(c, _LABELLED)}"
        for c in ("doc_id", "text", "lang", "source", "n_chars", "quality", "toxic")
    ),
    "quality_gate": _GATE_SQL,
    "quality_gate_observed": _GATE_SQL,
    "join_fanout": """SELECT count(DISTINCT a.l_partkey) AS keys,
  (SELECT count(*) FROM lineitem) AS left_rows, (SELECT count(*) FROM lineitem) AS right_rows,
  count(*) AS join_rows,
  (SELECT max(n * n)::BIGINT FROM (SELECT count(*) AS n FROM lineitem GROUP BY l_partkey)) AS largest
FROM lineitem a JOIN lineitem b ON a.l_partkey = b.l_partkey""",
    "repeated_keys": """SELECT l_orderkey, l_linenumber, count(*) AS rows FROM lineitem
GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
    "orphan_keys": """SELECT o_orderkey AS key, count(*) AS rows FROM orders
WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem) GROUP BY o_orderkey""",
    "fanout_report": """SELECT count(*) AS keys, count(*) FILTER (rows > 1) AS repeated,
  max(rows) AS largest
FROM (SELECT count(*) AS rows FROM lineitem GROUP BY l_orderkey, l_linestatus)""",
    "key_collisions": """SELECT performance_id, count(*) AS natural_keys
FROM (SELECT DISTINCT concat_ws('-', substring(CAST(o_orderkey AS VARCHAR), 1, 1),
    CAST(o_custkey AS VARCHAR)) AS performance_id, o_orderkey, o_custkey FROM orders)
GROUP BY performance_id HAVING count(*) > 1""",
}
