"""The star and its tables."""

from __future__ import annotations

import uuid
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession, functions as F

from starweave.operators.dedup import one_per_key
from starweave.operators.star import Star
from starweave.operators.surrogate import add_surrogate
from starweave.plans import match_star as ms
from starweave.queries import roles
from starweave.session import scratch_dir
from starweave.sinks.warehouse import TableSpec, create_tables, load

LOW, HIGH, MONTH, ROWS = 2000.0, 60000.0, 10, 50
LARGE = 5000
WEEKS = 36, 38
NATURAL = ("match_id", "time", "killer_name", "victim_name")


def flagship_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    # The other dimensions are only looked up for the rows of the report.
    star = roles.star(spark, sf_dir).stored("dates")
    return ms.area_report(star, LOW, HIGH, MONTH, ROWS)


def star_top_large(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same report with more rows, of every month."""
    star = ms.for_report(roles.star(spark, sf_dir).stored("dates"))
    others = ["matches", "details", "performances"]
    rows = star.top(ms.REPORT_ORDER, LARGE, ["dates"], others, stored=True)
    return rows.select(
        F.col("locations_killer_position_x").alias("killer_position_x"),
        F.col("locations_detail_id").alias("detail_id"),
        F.col("dates_month").alias("month"),
        F.col("details_weapon").alias("weapon"),
        F.col("performances_dmg").alias("dmg"),
    )


def star_top_bound(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first report again: the last position is found before the other columns are read."""
    star = ms.in_area_and_month(ms.for_report(roles.star(spark, sf_dir).stored("dates")), LOW, HIGH, MONTH)
    rows = star.bounded("killer_position_x", ROWS, ["dates"])
    others = ["matches", "details", "performances"]
    return ms.report_columns(rows.top(ms.REPORT_ORDER, ROWS, ["dates"], others, stored=True))


def star_pruned(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Kills of some weeks, from a fact with a folder for each month."""
    star = roles.star(spark, sf_dir, ids="digest", id_columns=NATURAL)
    return _by_month(spark, star).join(["dates"]).select(
        F.col("locations_location_id").alias("location_id"),
        F.col("locations_killer_position_x").alias("killer_position_x"),
        F.col("dates_game_time").alias("game_time"),
        F.col("dates_week").alias("week"),
    )


def _by_month(spark: SparkSession, star: Star) -> Star:
    """The star with its fact in a folder for each month, read where the dates of the weeks lie."""
    fact = star.fact.select("location_id", "killer_position_x", "date_id").withColumn("date_month", F.month("date_id"))
    spec = TableSpec(
        "locations",
        ", ".join(f"{n} {t}" for n, t in fact.dtypes),
        sort=("killer_position_x",),
        partition_by=("date_month",),
    )
    name = f"starweave_{uuid.uuid4().hex}"
    create_tables(spark, [spec], name, f"{scratch_dir(spark)}/{name}")
    load(fact, spec, name)
    star = replace(star.stored("dates"), fact=spark.table(f"{name}.locations"))
    return star.filtered(dates=F.col("week").between(*WEEKS)).pruned("dates", "date_month", "month")


def star_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = roles.star(spark, sf_dir, where=ms.area_and_month(LOW, HIGH, MONTH))
    star = ms.for_report(star)
    return ms.area_report(star.stored(*star.dims), LOW, HIGH, MONTH)


def star_sql(spark: SparkSession, sf_dir: str) -> DataFrame:
    prefix = f"star_{uuid.uuid4().hex}_"
    star = ms.for_report(roles.star(spark, sf_dir))
    star = star.stored(*star.dims)
    star.register(prefix)
    found = spark.sql(
        f"""
        SELECT weapon, details.time, matches.match_id, dmg, kills, killer_position_x,
          locations.detail_id
        FROM {prefix}locations AS locations
        JOIN {prefix}dates AS dates ON game_time = date_id
        JOIN {prefix}matches AS matches ON matches.match_id = locations.match_id
        JOIN {prefix}details AS details ON details.detail_id = locations.detail_id
        JOIN {prefix}performances AS performances
          ON performances.performance_id = locations.performance_id
        WHERE killer_position_x BETWEEN {LOW} AND {HIGH} AND dates.month = {MONTH}
        """
    )
    star.unregister(prefix)  # the query holds the tables, not their names
    return found


def _wide(star: Star) -> DataFrame:
    """The wide star. Ids are made from the natural keys after the joins: digests, which do not
    compress, would go through all shuffles. Details and performances are used once, and their keys are a
    kill's and a player's: they are joined where they were aggregated."""
    rows = star.stored("dates", "matches").join()
    natural = [f"{star.name}_id_{c}" for c in NATURAL]
    return add_surrogate(rows, f"{star.name}_location_id", "digest", natural).drop(*natural)


def wide_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _wide(roles.star(spark, sf_dir, late=True, ids="late", id_columns=NATURAL))


def wide_star_full_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The wide star with whole match ids in the keys."""
    return _wide(roles.star(spark, sf_dir, prefix_len=None, late=True, ids="late", id_columns=NATURAL))


def star_integrity(spark: SparkSession, sf_dir: str) -> DataFrame:
    star = _keys(roles.star(spark, sf_dir)).stored()
    facts = star.fact.agg(F.count("*").alias("fact_rows"), F.lit(0).alias("star_rows"))
    joined = star.join().agg(F.lit(0).alias("fact_rows"), F.count("*").alias("star_rows"))
    both = facts.unionAll(joined)
    return both.agg(F.sum("fact_rows").alias("fact_rows"), F.sum("star_rows").alias("star_rows"))


def star_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _keys(roles.star(spark, sf_dir)).stored().integrity()


def _keys(star: Star) -> Star:
    """Only the key columns, which are all that counts of rows need."""
    dims = {link.dim: [link.dim_key] for link in star.links}
    return star.narrowed(**{star.name: [link.fact_key for link in star.links]}, **dims)


def performance_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ms.performance_dim(roles.stats(spark, sf_dir, False), roles.PREFIX)


def performance_dim_short(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prefix of one character, so that keys of different matches are equal."""
    return ms.performance_dim(roles.stats(spark, sf_dir, False), prefix_len=1)


def date_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ms.date_dim(roles.stats(spark, sf_dir, False))


def date_dim_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+0000'")
    events = roles.table(spark, sf_dir, "events")
    return ms.date_dim(events.select(text.alias("date"), F.col("user_id").alias("match_id")))


def detail_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A prefix of two characters, so that keys of different matches are equal."""
    return ms.detail_dim(roles.kills(spark, sf_dir, False), prefix_len=2)


def match_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ms.match_dim(roles.kills(spark, sf_dir, False), roles.stats(spark, sf_dir, False))


def location_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ms.location_fact(
        roles.kills(spark, sf_dir),
        roles.stats(spark, sf_dir),
        roles.PREFIX,
        on=roles.SAME_STATUS,
        ids="digest",
        id_columns=NATURAL,
    )


def keyed_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_per_key(roles.table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])


QUERIES = {
    f.__name__: f
    for f in (
        flagship_star,
        star_top_large,
        star_top_bound,
        star_pruned,
        star_rows,
        star_sql,
        wide_star,
        wide_star_full_keys,
        star_integrity,
        star_links,
        performance_dim,
        performance_dim_short,
        date_dim,
        date_dim_events,
        detail_dim,
        match_dim,
        location_fact,
        keyed_dedup,
    )
}

_REPORT = f"""SELECT weapon, details.time, matches.match_id, dmg, kills, killer_position_x,
  locations.detail_id
FROM {roles.JOINED_SQL}
WHERE killer_position_x BETWEEN {LOW} AND {HIGH} AND dates.month = {MONTH}"""

# The columns of the five tables.
WIDE = {
    "locations": "location_id killer_position_x killer_position_y victim_position_x"
    " victim_position_y match_id detail_id date_id performance_id",
    "dates": "game_time match_id year month hour week weekday",
    "details": "detail_id match_id killer_name killer_placement victim_name victim_placement"
    " weapon time",
    "matches": "match_id game_size match_mode map",
    "performances": "performance_id name match_id dbno dist_ride dist_walk dmg kills"
    " survive_time assists",
}
_WIDE_COLUMNS = ", ".join(
    f"{t}.{c} AS {t}_{c}" for t, names in WIDE.items() for c in names.split()
)


def _link_sql(link: ms.Link) -> str:
    return f"""SELECT '{link.dim}' AS dim,
  (SELECT count(*) FROM {link.dim}) AS dim_rows,
  (SELECT count(*) FROM (SELECT {link.dim_key} FROM {link.dim} GROUP BY 1
    HAVING count(*) > 1)) AS repeated_keys,
  (SELECT count(*) FROM locations) AS fact_rows,
  (SELECT count(*) FROM locations WHERE {link.fact_key} NOT IN
    (SELECT {link.dim_key} FROM {link.dim})) AS orphan_rows,
  (SELECT count(*) FROM locations l JOIN {link.dim} d
    ON l.{link.fact_key} = d.{link.dim_key}) AS joined_rows"""


_FLAGSHIP = (
    f"WITH {roles.STAR_SQL}\n{_REPORT}\n"
    f"ORDER BY {', '.join('locations.' + c for c in ms.REPORT_ORDER)} LIMIT {ROWS}"
)

ORACLES = {
    "flagship_star": _FLAGSHIP,
    "star_top_bound": _FLAGSHIP,
    "star_pruned": f"""WITH {roles.STAR_SQL}
SELECT location_id, killer_position_x, game_time, week
FROM locations JOIN dates ON game_time = date_id WHERE week BETWEEN {WEEKS[0]} AND {WEEKS[1]}""",
    "star_top_large": f"WITH {roles.STAR_SQL}\nSELECT killer_position_x, locations.detail_id, month,"
    f" weapon, dmg FROM {roles.JOINED_SQL}\n"
    f"ORDER BY {', '.join('locations.' + c for c in ms.REPORT_ORDER)} LIMIT {LARGE}",
    "star_rows": f"WITH {roles.STAR_SQL}\n{_REPORT}",
    "star_sql": f"WITH {roles.STAR_SQL}\n{_REPORT}",
    "wide_star": f"WITH {roles.STAR_SQL}\nSELECT {_WIDE_COLUMNS} FROM {roles.JOINED_SQL}",
    "wide_star_full_keys": f"WITH {roles.star_sql(None)}\n"
    f"SELECT {_WIDE_COLUMNS} FROM {roles.JOINED_SQL}",
    "star_integrity": f"""WITH {roles.STAR_SQL}
SELECT (SELECT count(*) FROM locations) AS fact_rows,
  (SELECT count(*) FROM {roles.JOINED_SQL}) AS star_rows""",
    "star_links": f"WITH {roles.STAR_SQL}\n" + "\nUNION ALL\n".join(map(_link_sql, ms.LINKS)),
    "performance_dim": f"WITH {roles.STATS_SQL}, {roles.performances_sql()} SELECT * FROM performances",
    "performance_dim_short": f"WITH {roles.STATS_SQL}, {roles.performances_sql(1)}"
    " SELECT * FROM performances",
    "date_dim": f"WITH {roles.STATS_SQL}, {roles.DATES_SQL} SELECT * FROM dates",
    "date_dim_events": f"""SELECT game_time, match_id, {roles.DATE_PARTS_SQL}
FROM (SELECT date_trunc('second', ts) AS game_time, min(user_id) AS match_id
  FROM events GROUP BY 1)""",
    "detail_dim": f"WITH {roles.KILLS_SQL}, {roles.details_sql(2)} SELECT * FROM details",
    "match_dim": f"WITH {roles.STATS_SQL}, {roles.KILLS_SQL}, {roles.MATCHES_SQL}"
    " SELECT * FROM matches",
    "location_fact": f"WITH {roles.STATS_SQL}, {roles.KILLS_SQL}, {roles.locations_sql()}"
    " SELECT * FROM locations",
    "keyed_dedup": """SELECT * EXCLUDE (rn) FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey,
    l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax, l_returnflag, l_linestatus,
    l_shipdate) AS rn
  FROM lineitem) WHERE rn = 1""",
}
