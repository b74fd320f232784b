"""The given tables in the roles of the raw tables.

Orders stand for stats (an order is a match, its customer the player), line
items for kills. A kill and its stats meet on order and status.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from starweave.operators.clean import clean, distinct_rows, distinct_rows_late, drop_null_rows
from starweave.operators.star import Star
from starweave.plans import match_star as ms

SAME_STATUS = (("match_id", "match_id"), ("map", "game_size"))


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


# The column names of the raw tables, for the given ones.


def as_stats(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "o_orderkey AS match_id",
        "o_custkey AS player_name",
        "o_orderdate AS date",
        "o_orderstatus AS game_size",
        "o_orderpriority AS match_mode",
        "length(o_orderpriority) AS player_dbno",
        "o_totalprice / 2 AS player_dist_ride",
        "o_totalprice / 4 AS player_dist_walk",
        "o_totalprice AS player_dmg",
        "o_custkey AS player_kills",
        "o_totalprice / 8 AS player_survive_time",
        "day(o_orderdate) AS player_assists",
    )


def as_kills(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "l_returnflag AS killed_by",
        "l_suppkey AS killer_name",
        "l_quantity AS killer_placement",
        "l_extendedprice AS killer_position_x",
        "l_quantity AS killer_position_y",
        "l_linestatus AS map",
        "l_orderkey AS match_id",
        "l_linenumber AS time",
        "l_partkey AS victim_name",
        "l_extendedprice AS victim_placement",
        "l_discount AS victim_position_x",
        "l_tax AS victim_position_y",
    )


def stats(spark: SparkSession, sf_dir: str, distinct: bool = True) -> DataFrame:
    """Cleaned stats. Dimensions keep one row per key and need no distinct."""
    orders = table(spark, sf_dir, "orders")
    return as_stats(clean(orders) if distinct else drop_null_rows(orders))


def kills(spark: SparkSession, sf_dir: str, distinct: bool = True) -> DataFrame:
    lineitem = table(spark, sf_dir, "lineitem")
    return as_kills(clean(lineitem) if distinct else drop_null_rows(lineitem))


PREFIX = 5


def star(
    spark: SparkSession,
    sf_dir: str,
    prefix_len: int | None = PREFIX,
    late: bool = False,
    **options: object,
) -> Star:
    """The five tables, not stored: the fact from distinct rows, dimensions not.

    Keys have a prefix of the match id unless ``prefix_len`` is None. ``late`` finds the
    distinct rows by their digests, see ``distinct_rows_late``.
    """
    distinct = distinct_rows_late if late else distinct_rows
    orders = drop_null_rows(table(spark, sf_dir, "orders"))
    lineitem = drop_null_rows(table(spark, sf_dir, "lineitem"))
    fact_rows = as_kills(distinct(lineitem)), as_stats(distinct(orders))
    return ms.match_star(
        as_kills(lineitem),
        as_stats(orders),
        prefix_len,
        on=SAME_STATUS,
        fact_rows=fact_rows,
        **options,
    )


# The same roles and tables in SQL.

STATS_SQL = """stats AS (
  SELECT DISTINCT o_orderkey AS match_id, o_custkey AS player_name, o_orderdate AS date,
    o_orderstatus AS game_size, o_orderpriority AS match_mode,
    CAST(length(o_orderpriority) AS INTEGER) AS player_dbno,
    o_totalprice / 2 AS player_dist_ride, o_totalprice / 4 AS player_dist_walk,
    o_totalprice AS player_dmg, o_custkey AS player_kills,
    o_totalprice / 8 AS player_survive_time,
    CAST(day(o_orderdate) AS INTEGER) AS player_assists
  FROM orders)"""

KILLS_SQL = """kills AS (
  SELECT l_returnflag AS killed_by, l_suppkey AS killer_name,
    l_quantity AS killer_placement, l_extendedprice AS killer_position_x,
    l_quantity AS killer_position_y, l_linestatus AS map, l_orderkey AS match_id,
    l_linenumber AS time, l_partkey AS victim_name, l_extendedprice AS victim_placement,
    l_discount AS victim_position_x, l_tax AS victim_position_y
  FROM (SELECT DISTINCT * FROM lineitem))"""


def match_sql(column: str, prefix: int | None) -> str:
    """The match part of a key: its text, or the leading characters of it."""
    whole = f"CAST({column} AS VARCHAR)"
    return whole if prefix is None else f"substring({whole}, 1, {prefix})"


def whole_sql(*columns: str) -> str:
    """Parts with their lengths, null as a mark."""
    texts = [f"CAST({c} AS VARCHAR)" for c in columns]
    return " || ".join(f"coalesce(length({t}) || ':' || {t}, 'n')" for t in texts)


def performance_sql(prefix: int | None, row: str = "", whole: bool = False) -> str:
    """The key of a player in a match."""
    match, player = f"{row}match_id", f"{row}player_name"
    if whole:
        return whole_sql(match, player)
    return f"concat_ws('-', {match_sql(match, prefix)}, CAST({player} AS VARCHAR))"


def detail_sql(prefix: int | None, row: str = "", whole: bool = False) -> str:
    """The key of a kill."""
    match, time, killer = f"{row}match_id", f"{row}time", f"{row}killer_name"
    if whole:
        return whole_sql(match, time, killer, f"{row}victim_name")
    return f"concat({match_sql(match, prefix)}, CAST({time} AS VARCHAR), CAST({killer} AS VARCHAR))"


def performances_sql(prefix: int | None = PREFIX, whole: bool = False) -> str:
    return f"""performances AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY performance_id ORDER BY name, match_id, dbno,
      dist_ride, dist_walk, dmg, kills, survive_time, assists) AS rn
    FROM (SELECT {performance_sql(prefix, whole=whole)} AS performance_id,
          player_name AS name, match_id, player_dbno AS dbno, player_dist_ride AS dist_ride,
          player_dist_walk AS dist_walk, player_dmg AS dmg, player_kills AS kills,
          player_survive_time AS survive_time, player_assists AS assists
          FROM stats)) WHERE rn = 1)"""


DATE_PARTS_SQL = """CAST(year(game_time) AS INTEGER) AS year,
    CAST(month(game_time) AS INTEGER) AS month, CAST(hour(game_time) AS INTEGER) AS hour,
    CAST(weekofyear(game_time) AS INTEGER) AS week,
    CAST(dayofweek(game_time) + 1 AS INTEGER) AS weekday"""

DATES_SQL = f"""dates AS (
  SELECT game_time, match_id, {DATE_PARTS_SQL}
  FROM (SELECT date AS game_time, min(match_id) AS match_id FROM stats GROUP BY date))"""


def details_sql(prefix: int | None = PREFIX, whole: bool = False) -> str:
    return f"""details AS (
  SELECT * EXCLUDE (rn) FROM (
    SELECT *, row_number() OVER (PARTITION BY detail_id ORDER BY match_id, killer_name,
      killer_placement, victim_name, victim_placement, weapon, time) AS rn
    FROM (SELECT {detail_sql(prefix, whole=whole)} AS detail_id,
          match_id, killer_name, CAST(trunc(killer_placement) AS INTEGER) AS killer_placement,
          victim_name, CAST(trunc(victim_placement) AS INTEGER) AS victim_placement,
          killed_by AS weapon, time
          FROM kills)) WHERE rn = 1)"""


MATCHES_SQL = """matches AS (
  SELECT match_id, game_size, match_mode, map FROM (
    SELECT s.match_id, s.game_size, s.match_mode, k.map,
      row_number() OVER (PARTITION BY s.match_id
        ORDER BY s.game_size, s.match_mode, k.map) AS rn
    FROM kills k JOIN stats s ON k.match_id = s.match_id) WHERE rn = 1)"""

def digest_sql(*columns: str) -> str:
    """A digest of parts with their lengths, null as a mark."""
    return f"md5({whole_sql(*columns)})"


def locations_sql(prefix: int | None = PREFIX) -> str:
    return f"""locations AS (
  SELECT {digest_sql('k.match_id', 'k.time', 'k.killer_name', 'k.victim_name')} AS location_id,
    k.killer_position_x, k.killer_position_y, k.victim_position_x, k.victim_position_y,
    k.match_id,
    {detail_sql(prefix, 'k.')} AS detail_id,
    s.date AS date_id,
    {performance_sql(prefix, 's.')} AS performance_id
  FROM kills k JOIN stats s ON k.match_id = s.match_id AND k.map = s.game_size)"""

def star_sql(prefix: int | None = PREFIX) -> str:
    return ",\n".join(
        [
            STATS_SQL,
            KILLS_SQL,
            performances_sql(prefix),
            DATES_SQL,
            details_sql(prefix),
            MATCHES_SQL,
            locations_sql(prefix),
        ]
    )


STAR_SQL = star_sql()

JOINED_SQL = """locations
  JOIN dates ON dates.game_time = date_id
  JOIN matches ON matches.match_id = locations.match_id
  JOIN details ON details.detail_id = locations.detail_id
  JOIN performances ON performances.performance_id = locations.performance_id"""
