"""Loads and stagings that happen whole or not at all, and days that are merged."""

from __future__ import annotations

import uuid
from dataclasses import replace
from importlib import import_module
from pathlib import Path

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starweave.plans import etl, match_star as ms
from starweave.sinks import TableSpec, adopt, create_tables, load, publish, published, stage, stage_all
from starweave.sinks.publish import POINTER, Edition, create_part, part_spec, show
from starweave.sinks.warehouse import merge_day
from starweave.sources import read_stage
from tests.conftest import plan, rows
from tests.test_match_star import (  # noqa: F401
    KILLS,
    KILLS_HEADER,
    KNOWN_KILL,
    KNOWN_ROW,
    KNOWN_STATS,
    MATCH,
    STATS,
    config,
)


def wide(spark, made):
    return rows(etl.open_star(spark, made.database).join().drop("locations_location_id"))


def tables(spark, database):
    return {t.name for t in spark.catalog.listTables(database)}


LONG = KILLS.replace(",v4,", f",{'v' * 70},")


def test_a_failed_load_leaves_the_old_star_whole(spark, config):
    made = config(STATS, KILLS)
    etl.run(spark, made, "20240101")
    before, names = wide(spark, made), tables(spark, made.database)
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH"):
        etl.run(spark, config(STATS, LONG), "20240102")
    assert wide(spark, made) == before and len(before) == 5
    assert tables(spark, made.database) == names
    etl.run(spark, config(STATS, KILLS.replace(",v4,", ",w4,")), "20240103")
    assert wide(spark, made) != before


def test_readers_see_one_edition_while_the_next_is_half_shown(spark, config, monkeypatch):
    """The driver is lost right after the pointer changed, before the views did."""
    made = config(STATS, KILLS)
    etl.run(spark, made, "20240101")
    later = config(STATS.replace(",100,1,p1,", ",777,1,p1,"), KILLS)

    def lost(session, specs, database, edition):
        if "20240102" in edition.parts[0]:
            raise KeyboardInterrupt

    with monkeypatch.context() as patch:
        patch.setattr(import_module("starweave.sinks.publish"), "show", lost)
        with pytest.raises(KeyboardInterrupt):
            etl.run(spark, later, "20240102")
    star = etl.open_star(spark, made.database)
    damage = "max(performances_dmg)"
    assert star.join().agg(F.expr(damage)).first()[0] == 999
    assert 777 in [r["dmg"] for r in star.dims["performances"].collect()]
    assert 777 not in [r["dmg"] for r in spark.table(f"{made.database}.performances").collect()]
    adopt(spark, ms.TABLES, made.database)  # what the next load begins with
    assert 777 in [r["dmg"] for r in spark.table(f"{made.database}.performances").collect()]


def test_a_load_that_another_one_overtook_is_refused(spark, config):
    made = config(STATS, KILLS)
    etl.run(spark, made, "20240101")
    stale = published(spark, made.database)
    etl.run(spark, made, "20240102")
    with pytest.raises(RuntimeError, match="meanwhile"):
        publish(spark, ms.TABLES, made.database, ["x"], stale)
    assert published(spark, made.database).before == stale.parts


def test_editions_before_the_last_are_dropped(spark, config):
    made = config(STATS, KILLS)
    for day in ("20240101", "20240102", "20240103"):
        etl.run(spark, made, day)
    edition = published(spark, made.database)
    assert edition.last_day == "20240103" and len(edition.parts) == len(edition.before) == 1
    parts = {n.split("__", 1)[1] for n in tables(spark, made.database) if "__" in n}
    assert parts == {*edition.parts, *edition.before}


def test_appended_parts_are_read_together(spark, config):
    made = config(STATS, KILLS, mode="append")
    for day in ("20240101", "20240102"):
        etl.run(spark, made, day)
    edition = published(spark, made.database)
    assert len(edition.parts) == 2 and edition.last_day == "20240102"
    assert spark.table(f"{made.database}.locations").count() == 10
    assert etl.open_star(spark, made.database).fact.count() == 10
    with pytest.raises(PySparkException):
        etl.run(spark, config(STATS, LONG, mode="append"), "20240103")
    assert spark.table(f"{made.database}.locations").count() == 10


def test_tables_that_were_loaded_in_place_become_a_part(spark, config):
    made = config(STATS, KILLS)
    create_tables(spark, ms.TABLES[:1], made.database, made.database_location)
    old = spark.createDataFrame([("m", 1, "tpp", "ERANGEL")], "a string, b int, c string, d string")
    load(old, ms.TABLES[0], made.database)
    with pytest.raises(PySparkException):
        etl.run(spark, config(STATS, LONG), "20240101")
    assert rows(spark.table(f"{made.database}.matches")) == [("m", 1, "tpp", "ERANGEL")]
    etl.run(spark, config(STATS, KILLS), "20240101")
    assert spark.table(f"{made.database}.matches").count() == 2


def test_an_empty_load_and_a_null_key_fail_the_gate_before_publication(spark, config):
    made = config(STATS, KILLS)
    etl.run(spark, made, "20240101")
    before = wide(spark, made)
    stage(read_stage(spark, made.stage_root, "match", "20240101").limit(0), made.stage_root, "match", "20240101")
    with pytest.raises(ValueError, match="matches.match_id: None"):
        etl.load_warehouse(spark, made, "20240101")
    null = read_stage(spark, made.stage_root, "date", "20240101").withColumn("game_time", F.lit(None).cast("timestamp_ntz"))
    stage(null, made.stage_root, "date", "20240101")
    with pytest.raises(ValueError, match="dates.game_time: 1.0"):
        etl.load_warehouse(spark, made, "20240101")
    assert wide(spark, made) == before


def test_a_failed_staging_leaves_every_table_of_the_day(spark, tmp_path):
    root = str(tmp_path / "s")
    stage_all({"a": spark.range(3), "b": spark.range(4)}, root, "20240101")
    wrong = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(PySparkException, match="no"):
        stage_all({"a": spark.range(9), "b": wrong}, root, "20240101")
    assert [read_stage(spark, root, t, "20240101").count() for t in "ab"] == [3, 4]
    assert [p.name for p in sorted(Path(root).rglob("*")) if p.is_dir()] == ["a", "run_date=20240101", "b", "run_date=20240101"]


def test_a_swap_that_fails_or_is_cut_off_is_undone(spark, tmp_path, monkeypatch):
    module = import_module("starweave.sinks.stage")
    root = str(tmp_path / "s")
    stage_all({"a": spark.range(3), "b": spark.range(4)}, root, "20240101")
    real = module.rename_folder

    def failing(session, path, to):
        if "/b/.new" in path:
            raise OSError("lost")
        real(session, path, to)

    with monkeypatch.context() as patch:
        patch.setattr(module, "rename_folder", failing)
        with pytest.raises(OSError, match="lost"):
            stage_all({"a": spark.range(9), "b": spark.range(9)}, root, "20240101")
    assert [read_stage(spark, root, t, "20240101").count() for t in "ab"] == [3, 4]
    # As a driver leaves it that was lost between two renames.
    day = Path(root) / "a" / "run_date=20240101"
    day.rename(day.parent / ".old-run_date=20240101-x")
    wrong = spark.range(5).select(F.raise_error(F.lit("no")).cast("long").alias("id"))
    with pytest.raises(PySparkException):
        stage(wrong, root, "a", "20240101")
    assert read_stage(spark, root, "a", "20240101").count() == 3


def test_a_merged_day_reads_only_that_day_and_the_loaded_tables(spark, config, monkeypatch):
    made = config(STATS, KILLS, load_days="incremental")
    etl.run(spark, made, "20240101")
    later = STATS.replace(",100,1,p1,", ",777,1,p1,")
    read: list[str] = []

    def listed(loaded, day, key):
        merged = merge_day(loaded, day, key)
        read.extend(merged.inputFiles())
        return merged

    monkeypatch.setattr(etl, "merge_day", listed)
    etl.run(spark, replace(config(later, KILLS, load_days="incremental")), "20240102")
    assert read
    staged = [f for f in read if "/staged/" in f]
    assert staged and all("run_date=20240102" in f for f in staged)
    assert all("/staged/" in f or "__20240101_" in f for f in read)
    star = etl.verified(etl.open_star(spark, made.database))
    assert star.fact.count() == 5
    assert 777 in [r["dmg"] for r in star.dims["performances"].collect()]
    # An earlier day, once more: all days are read, the last still counts.
    etl.run(spark, config(STATS, KILLS, load_days="incremental"), "20240101")
    star = etl.verified(etl.open_star(spark, made.database))
    assert 777 in [r["dmg"] for r in star.dims["performances"].collect()]
    assert published(spark, made.database).last_day == "20240102"


def test_merge_day_keeps_keys_that_the_day_does_not_have(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2), ("b", 3)], "k string, v int")
    day = spark.createDataFrame([("b", 9), ("c", 4), ("c", 5)], "key string, value int")
    assert rows(merge_day(old, day, ["k"])) == [("a", 1), ("b", 9), ("c", 4), ("c", 5)]
    assert rows(merge_day(old, day.limit(0), ["k"])) == rows(old)


def test_facts_and_details_lie_in_the_same_buckets(spark, config):
    made = config(STATS, KILLS, buckets=4)
    etl.run(spark, made, "20240101")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        star = etl.open_star(spark, made.database)
        assert star.colocated == ("details",)
        text = plan(star.join(["details"]))
        whole = plan(star.join())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in text and "Exchange" not in text
    # In the whole star only the other joins shuffle.
    assert whole.count("SelectedBucketsCount: 4 out of 4") == 2
    assert star.join().count() == 5


def test_buckets_follow_the_staged_bytes(spark, config, monkeypatch):
    made = config(STATS, KILLS)
    etl.run(spark, made, "20240101")
    cores = spark.sparkContext.defaultParallelism
    assert {s.buckets for s in etl.layouts(spark, made, "20240101")} == {0, cores}
    monkeypatch.setattr(etl, "BUCKET_BYTES", 50)
    (many,) = {s.buckets for s in etl.layouts(spark, made, "20240101")} - {0}
    assert many > cores
    assert max(s.buckets for s in etl.layouts(spark, made, None)) == many


def test_a_join_that_would_be_too_large_is_not_made(spark, config):
    """A hot pair of match and player: 30 kills meet 20 stats rows."""
    kills = "".join(f"AK,p1,1.0,{i}.0,1.0,ERANGEL,AAAAA1,{i},v{i},9.0,1.0,1.0\n" for i in range(30))
    stats = "".join(f"2017-10-01T10:00:00+0000,50,AAAAA1,tpp,0,0,1.0,2.0,{i},1,p1,10.0\n" for i in range(20))
    with pytest.raises(ValueError, match="600 rows, more than 599"):
        etl.run(spark, config(stats, kills, most_facts=599), "20240101")
    made = config(stats, kills, most_facts=600)
    etl.run(spark, made, "20240101")
    assert spark.table(f"{made.database}.locations").count() == 600


def test_the_known_row_loads_by_default(spark, config):
    made = config(KNOWN_STATS, KNOWN_KILL)
    report = etl.run(spark, made, "20240101")
    assert not any(report.merged_rows.values())
    (row,) = etl.open_star(spark, made.database).join().collect()
    detail = f"{len(MATCH)}:{MATCH}3:9179:Derrick_h11:Nautilus101"
    assert row["locations_detail_id"] == row["details_detail_id"] == detail
    assert row["performances_performance_id"] == f"{len(MATCH)}:{MATCH}9:Derrick_h"
    assert (row["details_weapon"], row["details_victim_name"]) == (KNOWN_ROW["details"][6], KNOWN_ROW["details"][4])


KILL = "{weapon},{killer},1.0,{x}.0,1.0,ERANGEL,{match},{time},{victim},9.0,1.0,1.0\n"
MADE = "2017-10-01T10:00:00+0000,50,{match},tpp,0,0,1.0,2.0,{dmg},1,{player},10.0\n"


def test_two_kills_in_a_second_stay_apart(spark, config):
    """Both facts show their own victim; plain keys merge them, and the report says so."""
    kills = "".join(KILL.format(weapon="AK", killer="p1", x=i, match="M1", time=5, victim=f"v{i}") for i in range(2))
    stats = MADE.format(match="M1", player="p1", dmg=1)
    made = config(stats, kills)
    report = etl.run(spark, made, "20240101")
    assert report.merged_keys["details"] == report.merged_rows["details"] == 0
    found = etl.open_star(spark, made.database).join().select("locations_killer_position_x", "details_victim_name")
    assert rows(found) == [(0.0, "v0"), (1.0, "v1")]
    plain = config(stats, kills, keys="plain")
    with pytest.warns(UserWarning, match="merged keys"):
        report = etl.run(spark, plain, "20240102")
    assert report.merged_keys["details"] == report.merged_rows["details"] == 1
    assert rows(etl.open_star(spark, made.database).join().select("details_victim_name")) == [("v0",), ("v0",)]


def test_parts_of_a_key_cannot_run_together(spark, config):
    """(M1, 17, x) and (M17, 1... ) share a plain key: M117x."""
    kills = "".join(KILL.format(weapon=w, killer="x", x=1, match=m, time=t, victim="v") for w, m, t in (("AK", "M1", 17), ("M4", "M11", 7)))
    stats = "".join(MADE.format(match=m, player="x", dmg=1) for m in ("M1", "M11"))
    made = config(stats, kills)
    assert not any(etl.run(spark, made, "20240101").merged_rows.values())
    weapons = rows(etl.open_star(spark, made.database).join().select("locations_match_id", "details_weapon"))
    assert weapons == [("M1", "AK"), ("M11", "M4")]
    with pytest.warns(UserWarning, match="merged keys"):
        report = etl.run(spark, config(stats, kills, keys="plain"), "20240102")
    assert report.merged_keys == {"performances": 0, "details": 1}


def test_rows_that_share_a_whole_key_are_counted(spark, config):
    """The same victim twice in a second, by two weapons: one natural key, two rows."""
    kills = "".join(KILL.format(weapon=w, killer="x", x=1, match="M1", time=1, victim="v") for w in ("AK", "M4"))
    report = etl.run(spark, config(MADE.format(match="M1", player="x", dmg=1), kills), "20240101")
    assert report.merged_keys["details"] == 0 and report.merged_rows["details"] == 1


def test_settings_that_contradict_each_other_are_errors():
    for wrong in ({"keys": "whole", "prefix_len": 5}, {"keys": "other"}, {"mode": "other"}):
        with pytest.raises(ValueError):
            etl.EtlConfig("a", "b", "c", **wrong)


def test_published_tables_have_one_pointer(spark, tmp_path):
    database = f"db_{uuid.uuid4().hex}"
    specs = [TableSpec("t", "k BIGINT"), TableSpec("u", "k BIGINT")]
    create_tables(spark, (), database, str(tmp_path / database))
    try:
        assert published(spark, database) == Edition()
        for part, n in (("p1", 2), ("p2", 3)):
            create_part(spark, specs, database, part)
            for spec in specs:
                load(spark.range(n), part_spec(spec, part), database)
            edition = publish(spark, specs, database, [part], published(spark, database), "20240101")
            assert published(spark, database) == edition
            assert [spark.table(f"{database}.{s.name}").count() for s in specs] == [n, n]
        show(spark, specs, database, Edition())  # nothing published: nothing to show
        assert POINTER in tables(spark, database)
    finally:
        spark.sql(f"DROP DATABASE {database} CASCADE")
