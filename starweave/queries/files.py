"""CSV scans and staged Parquet tables, written from the given tables first."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from starweave.functions import parse_timestamp
from starweave.operators.clean import clean
from starweave.operators.dedup import latest_per_key
from starweave.queries.roles import table
from starweave.session import scratch_dir
from starweave.sinks.stage import stage
from starweave.sources.csv import REJECT, read_csv, read_csv_once, rejected_rows, schema_by_name
from starweave.sources.staged import RUN_DATE, read_stage

LINEITEM = (
    "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int,"
    " l_quantity double, l_extendedprice double, l_discount double, l_tax double,"
    " l_returnflag string, l_linestatus string, l_shipdate string"
)
PARTS = "l_orderkey bigint, l_partkey bigint, l_linenumber int, l_returnflag string"


def _text_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("l_shipdate", "yyyy-MM-dd'T'HH:mm:ss'+0000'")
    return table(spark, sf_dir, "lineitem").withColumn("l_shipdate", text)


def _write_csv(df: DataFrame, header: bool = True) -> str:
    path = f"{scratch_dir(df.sparkSession)}/csv"
    df.write.option("header", header).csv(path)
    return path


def _typed(df: DataFrame) -> DataFrame:
    return df.withColumn("l_shipdate", parse_timestamp("l_shipdate"))


def csv_schema_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _typed(read_csv(spark, _write_csv(_text_dates(spark, sf_dir)), LINEITEM))


def csv_infer_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_csv(_text_dates(spark, sf_dir))
    found = read_csv(spark, path, types={"l_shipdate": "string"})
    # Small 64-bit ids are inferred as int.
    ids = {c: F.col(c).cast("bigint") for c in ("l_orderkey", "l_partkey", "l_suppkey")}
    return _typed(found.withColumns(ids))


def csv_infer_once(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types inferred while the text is stored, in one scan of the file."""
    found = read_csv_once(spark, _write_csv(_text_dates(spark, sf_dir)), {"l_shipdate": "string"})
    ids = {c: F.col(c).cast("bigint") for c in ("l_orderkey", "l_partkey", "l_suppkey")}
    return _typed(found.withColumns(ids))


def csv_by_name(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Types by name, for a file whose columns come in another order."""
    lines = _text_dates(spark, sf_dir)
    path = _write_csv(lines.select(*sorted(lines.columns)))
    types = dict(c.split() for c in LINEITEM.split(", "))
    return _typed(read_csv(spark, path, schema_by_name(spark, path, types)))


def csv_no_header(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = _write_csv(_text_dates(spark, sf_dir), header=False)
    return _typed(read_csv(spark, path, LINEITEM, header=False))


def _damaged(spark: SparkSession, sf_dir: str) -> str:
    """Lines with a fault that depends on the line number of the item."""
    number = F.col("l_linenumber")
    field = (
        F.when(number == 1, F.lit("x"))
        .when(number == 2, F.lit("9.0"))
        .when(number == 3, F.lit(""))
        .otherwise(number.cast("string"))
    )
    short = F.concat_ws(",", "l_orderkey", "l_partkey")
    whole = F.concat_ws(",", "l_orderkey", "l_partkey", field, "l_returnflag")
    line = (
        F.when(number == 4, short)
        .when(number == 5, F.concat(whole, F.lit(",more")))
        .otherwise(whole)
    )
    path = f"{scratch_dir(spark)}/lines"
    table(spark, sf_dir, "lineitem").select(line.alias("value")).write.text(path)
    return path


def csv_malformed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(read_csv(spark, _damaged(spark, sf_dir), PARTS, header=False))


def csv_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = read_csv(spark, _damaged(spark, sf_dir), PARTS, header=False, rejects=True)
    return rejected_rows(rows).withColumnRenamed(REJECT, "line")


def _two_days(spark: SparkSession, sf_dir: str, named: bool = True) -> str:
    """Day 1 is the whole table, day 2 the open items, staged over the closed ones."""
    root = scratch_dir(spark)
    lineitem = table(spark, sf_dir, "lineitem")
    stage(lineitem, root, "items", "20240101", named)
    for status in ("F", "O"):
        stage(lineitem.filter(F.col("l_linestatus") == status), root, "items", "20240102", named)
    return root


def stage_overwrite(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = read_stage(spark, _two_days(spark, sf_dir), "items", "all", with_run_date=True)
    return days.groupBy(RUN_DATE).agg(F.count("*").alias("rows"), F.sum("l_quantity").alias("quantity"))


def stage_multi_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_stage(spark, _two_days(spark, sf_dir), "items", "all")


def stage_day_folders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_stage(spark, _two_days(spark, sf_dir, named=False), "items", "all", named=False)


def stage_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_stage(spark, _two_days(spark, sf_dir), "items", with_run_date=True)


def stage_latest_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the latest day, which was staged without any."""
    root = _two_days(spark, sf_dir)
    stage(table(spark, sf_dir, "lineitem").filter("l_quantity < 0"), root, "items", "20240103")
    latest = read_stage(spark, root, "items", with_run_date=True)
    everything = read_stage(spark, root, "items", "all")
    return latest.agg(F.count("*").alias("rows")).crossJoin(
        everything.agg(F.count("*").alias("all_rows"))
    )


def stage_latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    days = read_stage(spark, _two_days(spark, sf_dir), "items", "all", with_run_date=True)
    return latest_per_key(days, ["l_orderkey", "l_linenumber"], RUN_DATE)


QUERIES = {
    f.__name__: f
    for f in (
        csv_schema_scan,
        csv_infer_scan,
        csv_infer_once,
        csv_by_name,
        csv_no_header,
        csv_malformed,
        csv_rejects,
        stage_overwrite,
        stage_multi_day,
        stage_day_folders,
        stage_latest,
        stage_latest_empty,
        stage_latest_per_key,
    )
}

_BOTH_DAYS = """(SELECT *, '20240101' AS run_date FROM lineitem
  UNION ALL SELECT *, '20240102' AS run_date FROM lineitem WHERE l_linestatus = 'O')"""

ORACLES = {
    "csv_schema_scan": "SELECT * FROM lineitem",
    "csv_infer_scan": "SELECT * FROM lineitem",
    "csv_infer_once": "SELECT * FROM lineitem",
    "csv_by_name": "SELECT * FROM lineitem",
    "csv_no_header": "SELECT * FROM lineitem",
    "csv_malformed": """SELECT DISTINCT l_orderkey, l_partkey, l_linenumber, l_returnflag
FROM lineitem WHERE l_linenumber >= 5""",
    "csv_rejects": """SELECT l_orderkey, l_partkey,
  CASE WHEN l_linenumber = 5 THEN 5 END AS l_linenumber,
  CASE WHEN l_linenumber <> 4 THEN l_returnflag END AS l_returnflag,
  concat_ws(',', l_orderkey, l_partkey,
    CASE l_linenumber WHEN 1 THEN 'x' WHEN 2 THEN '9.0' WHEN 5 THEN '5' END,
    CASE WHEN l_linenumber <> 4 THEN l_returnflag END,
    CASE WHEN l_linenumber = 5 THEN 'more' END) AS line
FROM lineitem WHERE l_linenumber IN (1, 2, 4, 5)""",
    "stage_overwrite": f"""SELECT run_date, count(*) AS rows, sum(l_quantity) AS quantity
FROM {_BOTH_DAYS} GROUP BY run_date""",
    "stage_multi_day": f"SELECT * EXCLUDE (run_date) FROM {_BOTH_DAYS}",
    "stage_day_folders": f"SELECT * EXCLUDE (run_date) FROM {_BOTH_DAYS}",
    "stage_latest": f"SELECT * FROM {_BOTH_DAYS} WHERE run_date = '20240102'",
    "stage_latest_empty": f"SELECT 0::BIGINT AS rows, count(*) AS all_rows FROM {_BOTH_DAYS}",
    "stage_latest_per_key": f"""SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY run_date DESC,
    l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC, l_discount DESC,
    l_tax DESC, l_returnflag DESC, l_linestatus DESC, l_shipdate DESC) AS rn
  FROM {_BOTH_DAYS}) WHERE rn = 1""",
}
