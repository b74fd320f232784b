"""The match star: four dimensions and one fact from two raw tables.

``stats`` holds one row per player and match, ``kills`` one row per kill.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from starweave.functions import date_parts, parse_timestamp, prefix_key, trunc_int, whole_key
from starweave.operators.star import Link, Star, build_dimension, build_fact
from starweave.operators.surrogate import add_surrogate
from starweave.session import materialize
from starweave.sinks.warehouse import TableSpec

# File layout, column names and types of the raw tables.
STATS_PATH = "aggregate/agg_match_mil"
KILLS_PATH = "kill/kill_match_mil"
STATS_TYPES = {
    "date": "string",
    "game_size": "int",
    "match_id": "string",
    "match_mode": "string",
    "player_assists": "int",
    "player_dbno": "int",
    "player_dist_ride": "double",
    "player_dist_walk": "double",
    "player_dmg": "int",
    "player_kills": "int",
    "player_name": "string",
    "player_survive_time": "double",
}
# Whole numbers that the raw file may write with a fraction.
STATS_NUMBERS = [n for n, t in STATS_TYPES.items() if t == "int"]
KILLS_SCHEMA = (
    "killed_by string, killer_name string, killer_placement float,"
    " killer_position_x float, killer_position_y float, map string, match_id string,"
    " time int, victim_name string, victim_placement float,"
    " victim_position_x float, victim_position_y float"
)

# The warehouse tables. The two composite keys are wide enough for all their
# parts whole, with lengths.
TABLES = (
    TableSpec(
        name="matches",
        source="match",
        columns="match_id VARCHAR(256), game_size INT, match_mode VARCHAR(64), map VARCHAR(64)",
        sort=("match_id",),
        key=("match_id",),
        replicate=True,
    ),
    TableSpec(
        name="details",
        source="detail",
        columns="detail_id VARCHAR(1024), match_id VARCHAR(256), killer_name VARCHAR(64),"
        " killer_placement INT, victim_name VARCHAR(64), victim_placement INT,"
        " weapon VARCHAR(64), time INT",
        sort=("detail_id",),
        key=("detail_id",),
    ),
    TableSpec(
        name="dates",
        source="date",
        columns="game_time TIMESTAMP_NTZ, match_id VARCHAR(256), year INT, month INT,"
        " hour INT, week INT, weekday INT",
        sort=("game_time",),
        key=("game_time",),
    ),
    TableSpec(
        name="performances",
        source="performance",
        columns="performance_id VARCHAR(512), name VARCHAR(64), match_id VARCHAR(256),"
        " dbno INT, dist_ride DOUBLE, dist_walk DOUBLE, dmg INT, kills INT,"
        " survive_time DOUBLE, assists INT",
        sort=("performance_id",),
        key=("performance_id",),
    ),
    TableSpec(
        name="locations",
        source="location",
        columns="location_id BIGINT, killer_position_x DOUBLE, killer_position_y DOUBLE,"
        " victim_position_x DOUBLE, victim_position_y DOUBLE, match_id VARCHAR(256),"
        " detail_id VARCHAR(1024), date_id TIMESTAMP_NTZ, performance_id VARCHAR(512)",
        sort=("killer_position_x", "killer_position_y"),
        key=("match_id",),
        unique=False,
    ),
)
FACT = "locations"
LINKS = (
    Link("dates", "date_id", "game_time"),
    Link("details", "detail_id", "detail_id"),
    Link("matches", "match_id", "match_id"),
    Link("performances", "performance_id", "performance_id"),
)

# Columns that must hold no null after a load.
NULL_CHECKS = {
    "details": ["detail_id"],
    "dates": ["game_time"],
    "locations": ["location_id"],
    "performances": ["performance_id"],
    "matches": ["match_id"],
}

# Total order of the report: position and detail, then all but the row id.
REPORT_ORDER = (
    "killer_position_x",
    "detail_id",
    "killer_position_y",
    "victim_position_x",
    "victim_position_y",
    "match_id",
    "date_id",
    "performance_id",
)

KILLER_IS_PLAYER = (("match_id", "match_id"), ("killer_name", "player_name"))


#: What tells one kill from another.
KILL = ("match_id", "time", "killer_name", "victim_name")
PLAYER = ("match_id", "player_name")


def whole_match(key: str) -> Column:
    """Whether a whole key begins with the match that the row has."""
    match = F.col("match_id")
    return F.col(key).startswith(F.concat(F.length(match).cast("string"), F.lit(":"), match))


def performance_key(prefix_len: int | None = None, whole: bool = False) -> Column:
    """Match and player. A prefix of the match id can merge matches, and a dash in the
    names can merge players: see ``quality.key_collisions``. ``whole`` keys cannot."""
    if whole:
        return whole_key(*PLAYER)
    return prefix_key(*PLAYER, prefix_len=prefix_len, sep="-")


def detail_key(
    prefix_len: int | None = None, sep: str | None = None, *more: str, whole: bool = False
) -> Column:
    """Match (or a prefix of its id), second and killer, and any further columns. Two
    kills by one player in a second share the key unless ``more`` tells them apart, and
    parts without a separator can run together. ``whole`` keys have the victim and the
    length of each part: no two kills share one."""
    if whole:
        return whole_key(*KILL, *more)
    return prefix_key("match_id", "time", "killer_name", *more, prefix_len=prefix_len, sep=sep)


def game_time(stats: DataFrame, column: str = "date") -> Column:
    """Start of the match: parsed from text, or a time stamp taken as it is."""
    if isinstance(stats.schema[column].dataType, T.StringType):
        return parse_timestamp(column)
    return F.col(column).cast("timestamp_ntz")


def performance_dim(
    stats: DataFrame,
    prefix_len: int | None = None,
    among: DataFrame | None = None,
    whole: bool = False,
    rare: str | None = None,
    several: bool = False,
    within: Sequence[str] = (),
) -> DataFrame:
    return build_dimension(
        stats,
        "performance_id",
        {
            "performance_id": performance_key(prefix_len, whole),
            "name": F.col("player_name"),
            "match_id": F.col("match_id"),
            "dbno": F.col("player_dbno"),
            "dist_ride": F.col("player_dist_ride"),
            "dist_walk": F.col("player_dist_walk"),
            "dmg": F.col("player_dmg"),
            "kills": F.col("player_kills"),
            "survive_time": F.col("player_survive_time"),
            "assists": F.col("player_assists"),
        },
        among=among,
        rare=rare,
        natural=("match_id", "name") if several else (),
        within=within,
    )


def date_dim(stats: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """One row per start time. It names one match only: never join on that."""
    starts = stats.select("date", "match_id").dropDuplicates()
    days = build_dimension(
        starts,
        "game_time",
        {"game_time": game_time(starts), "match_id": F.col("match_id")},
        among=among,
    )
    return days.withColumns(date_parts("game_time"))


def detail_dim(
    kills: DataFrame,
    prefix_len: int | None = None,
    sep: str | None = None,
    more: Sequence[str] = (),
    among: DataFrame | None = None,
    whole: bool = False,
    rare: str | None = None,
    several: bool = False,
    within: Sequence[str] = (),
) -> DataFrame:
    return build_dimension(
        kills,
        "detail_id",
        {
            "detail_id": detail_key(prefix_len, sep, *more, whole=whole),
            "match_id": F.col("match_id"),
            "killer_name": F.col("killer_name"),
            "killer_placement": trunc_int("killer_placement"),
            "victim_name": F.col("victim_name"),
            "victim_placement": trunc_int("victim_placement"),
            "weapon": F.col("killed_by"),
            "time": F.col("time"),
        },
        among=among,
        rare=rare,
        natural=KILL if several else (),
        within=within,
    )


def match_dim(kills: DataFrame, stats: DataFrame, among: DataFrame | None = None) -> DataFrame:
    """Matches known to both tables.

    Both sides come down to one row per match before the join: joining first
    would pair every kill of a match with each of its players.
    """
    played = build_dimension(
        stats,
        "match_id",
        {c: F.col(c) for c in ("match_id", "game_size", "match_mode")},
        repeats=True,
        among=among,
    )
    maps = build_dimension(
        kills,
        "match_id",
        {c: F.col(c) for c in ("match_id", "map")},
        repeats=True,
        among=among,
    )
    return played.join(maps, "match_id").select("match_id", "game_size", "match_mode", "map")


def location_fact(
    kills: DataFrame,
    stats: DataFrame,
    prefix_len: int | None = None,
    sep: str | None = None,
    more: Sequence[str] = (),
    on: Sequence[tuple[str, str]] = KILLER_IS_PLAYER,
    where: Column | None = None,
    ids: str = "monotonic",
    id_columns: Sequence[str] = (),
    whole: bool = False,
) -> DataFrame:
    """One row per kill and matching stats row of the killer.

    Kills without stats are left out; several stats rows multiply a kill. Both
    inputs must be cleaned (distinct), as repeated rows would multiply too.
    ``ids`` is a kind of ``add_surrogate``; ``id_columns`` are kill columns. ``late`` leaves them
    in the rows, as ``id_`` and their names, for an id that is made after the joins.
    """
    # Only what the keys are made of goes through the shuffle.
    positions = ["killer_position_x", "killer_position_y", "victim_position_x", "victim_position_y"]
    left = dict.fromkeys([*positions, *KILL, *more, *id_columns])
    right = dict.fromkeys(["date", *PLAYER])
    columns = {f"_k_{c}": ("left", c) for c in left} | {f"_s_{c}": ("right", c) for c in right}
    joined = build_fact(kills, stats, on, columns)
    of_kill = joined.withColumnsRenamed({f"_k_{c}": c for c in left})
    keyed = of_kill.withColumn("detail_id", detail_key(prefix_len, sep, *more, whole=whole))
    of_player = keyed.withColumnsRenamed({"match_id": "_k_match_id", **{f"_s_{c}": c for c in right}})
    keyed = of_player.withColumns(
        {"date_id": game_time(of_player), "performance_id": performance_key(prefix_len, whole)}
    )
    columns = [*positions, "match_id", "detail_id", "date_id", "performance_id"]
    natural = {f"id_{c}": c for c in id_columns}
    joined = keyed.drop("match_id").withColumnRenamed("_k_match_id", "match_id")
    joined = joined.select(*columns, *(F.col(c).alias(n) for n, c in natural.items()))
    if where is not None:
        # Before the ids: a predicate does not pass them on its way to the scan.
        joined = joined.filter(where)
    if ids == "late":
        return joined
    return add_surrogate(joined, "location_id", ids, list(natural) or columns).drop(*natural)


def match_star(
    kills: DataFrame,
    stats: DataFrame,
    prefix_len: int | None = None,
    on: Sequence[tuple[str, str]] = KILLER_IS_PLAYER,
    fact_rows: tuple[DataFrame, DataFrame] | None = None,
    where: Column | None = None,
    whole: bool = False,
    rare: str | None = None,
    several: bool = False,
    within: Sequence[str] = (),
    **ids: object,
) -> Star:
    """All five tables from cleaned inputs.

    The star is complete: each fact key comes from a row its dimension has too. That is so
    of keys; with keys that are not ``whole``, the row of a key may be another
    kill's or player's.
    ``fact_rows`` gives distinct kills and stats where the first two may repeat
    rows, which only the fact minds. ``where`` is a predicate on the fact: the
    matching facts are stored, and dimensions are built for their keys only. ``rare`` is for
    keys of kills and players that hardly repeat, ``several`` marks the keys of those dimensions that stand for several kills
    or players, ``within`` names columns of both inputs that they are bucketed by, see ``one_per_key``.
    """
    rows = fact_rows or (kills, stats)
    fact = location_fact(*rows, prefix_len, on=on, where=where, whole=whole, **ids)
    used = dict.fromkeys(link.dim for link in LINKS)
    if where is not None:
        fact = materialize(fact, FACT)
        used = {link.dim: link.used(fact) for link in LINKS}
    return Star(
        name=FACT,
        fact=fact,
        dims={
            "dates": date_dim(stats, used["dates"]),
            "details": detail_dim(kills, prefix_len, among=used["details"], whole=whole, rare=rare, several=several, within=within),
            "matches": match_dim(kills, stats, used["matches"]),
            "performances": performance_dim(stats, prefix_len, used["performances"], whole, rare, several, within),
        },
        links=LINKS,
        complete=True,
    )


def area_and_month(low: float, high: float, month: int) -> Column:
    """Facts in a strip of the map, in one month of any year."""
    return F.col("killer_position_x").between(low, high) & (F.month("date_id") == month)


def in_area_and_month(star: Star, low: float, high: float, month: int) -> Star:
    """Star of the kills in an area and month.

    The month follows from the fact's own time, so the fact is cut down before
    any join, and not only by the join with the dates.
    """
    return star.filtered(area_and_month(low, high, month), dates=F.col("month") == month)


def for_report(star: Star) -> Star:
    """Only the columns of ``area_report``. Without row ids, which are made after
    the join, predicates on the fact reach the scan."""
    return star.narrowed(
        locations=REPORT_ORDER,
        dates=["game_time", "month"],
        details=["detail_id", "weapon", "time"],
        matches=["match_id"],
        performances=["performance_id", "dmg", "kills"],
    )


def area_report(star: Star, low: float, high: float, month: int, n: int | None = None) -> DataFrame:
    """Weapon, time, match, damage and kills for kills in an area and month.

    With ``n`` the first rows by position and detail, else all rows.
    """
    part = in_area_and_month(for_report(star), low, high, month)
    others = ["matches", "details", "performances"]
    if n is None:
        rows = part.join(["dates", *others])
    else:
        rows = part.top(REPORT_ORDER, n, ["dates"], others, stored=True)
    return report_columns(rows)


def report_columns(rows: DataFrame) -> DataFrame:
    """The columns of the report from rows of the star join."""
    return rows.select(
        F.col("details_weapon").alias("weapon"),
        F.col("details_time").alias("time"),
        F.col("matches_match_id").alias("match_id"),
        F.col("performances_dmg").alias("dmg"),
        F.col("performances_kills").alias("kills"),
        F.col("locations_killer_position_x").alias("killer_position_x"),
        F.col("locations_detail_id").alias("detail_id"),
    )
