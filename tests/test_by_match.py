"""Whole keys tell their match: what is staged, loaded and joined lies by match, in few bytes and short tasks."""

from __future__ import annotations

from dataclasses import replace

import pytest
from pyspark.sql import functions as F

from starweave import session
from starweave.operators.dedup import one_per_key
from starweave.plans import etl, match_star as ms
from starweave.queries import loads
from starweave.session import SPLIT_BYTES, bucket_number, drop_together, few_files, settings, short_tasks, stored_together
from starweave.sources import read_stage
from tests.conftest import plan, rows
from tests.test_match_star import KILLS, STATS, config  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture
def no_broadcast(spark):
    off = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.starweave.broadcastBytes": "0"}
    with settings(spark, off):
        yield


def wide(spark, made):
    return rows(etl.open_star(spark, made.database).join().drop("locations_location_id"))


def bucketed_by(spark, made):
    (part,) = etl.published(spark, made.database).parts
    return {s.name: etl._bucketed_by(spark, f"{made.database}.{s.name}__{part}") for s in ms.TABLES}


def test_a_key_that_tells_its_bucket_needs_no_shuffle(spark, tmp_path):
    data = [("m1", "m1a", 2.0, "x"), ("m1", "m1a", 1.0, "y"), ("m2", "m2a", -0.0, None), (None, None, 1.0, "z"), ("m3", None, None, "u")]
    df = spark.createDataFrame(data, "m string, k string, v double, w string").repartition(3)
    stored, _ = stored_together(df, ["m"], 4, "rows", str(tmp_path))
    got = one_per_key(stored, "k", within=["m"])
    assert "Exchange" not in plan(got)
    # Keys without a null are the same as those found in all rows.
    want = one_per_key(df.filter("k IS NOT NULL"), "k")
    assert got.columns == want.columns and rows(got.filter("k IS NOT NULL")) == rows(want)
    drop_together(spark, str(tmp_path))


def test_a_star_by_match_is_joined_without_a_shuffle(spark, config, no_broadcast):  # noqa: F811
    made = config(STATS, KILLS)
    etl.run(spark, made, "20240101")
    lying = bucketed_by(spark, made)
    assert {n for n, by in lying.items() if by == ("match_id",)} == {"locations", "details", "matches", "performances"}
    star = etl.open_star(spark, made.database)
    assert star.beside == ("match_id",) and set(star.colocated) == {"details", "matches", "performances"}
    assert "Exchange" not in plan(star.join(list(star.colocated)))
    other = config(STATS, KILLS, buckets=4)
    etl.run(spark, other, "20240101")
    assert bucketed_by(spark, other)["details"] == ("detail_id",)
    assert wide(spark, made) == wide(spark, other) and len(wide(spark, made)) == 5
    narrow = star.narrowed(locations=["detail_id"], details=["detail_id", "weapon"])
    assert rows(narrow.join(["details"])) == rows(replace(narrow, beside=()).join(["details"]))


def test_keys_that_do_not_tell_their_match_are_joined_by_key(spark, config):  # noqa: F811
    """A day staged with plain keys, and loaded by a job with whole ones."""
    plain = config(STATS, KILLS, keys="plain")
    etl.run(spark, plain, "20240101")
    want = wide(spark, plain)
    whole = replace(plain, keys=None, database=f"{plain.database}_whole", database_location=f"{plain.stage_root}-db")
    etl.load_warehouse(spark, whole, "20240101")
    assert bucketed_by(spark, whole)["details"] == ("detail_id",)
    assert wide(spark, whole) == want and want


def test_a_hot_match_is_loaded_by_key(spark, config, monkeypatch):  # noqa: F811
    hot = "".join(f"AK,p1,1.0,{i}.0,1.0,ERANGEL,AAAAA1,{i},v{i},9.0,1.0,1.0\n" for i in range(60))
    made = config(STATS, KILLS + hot)
    etl.run(spark, made, "20240101")
    assert bucketed_by(spark, made)["locations"] == ("match_id",)
    want = wide(spark, made)
    monkeypatch.setattr(session, "HOT_ROWS", 20)
    etl.run(spark, made, "20240102")
    assert bucketed_by(spark, made)["locations"] == ("detail_id",)
    assert wide(spark, made) == want and len(want) >= 60


def test_buckets_and_tasks_are_short_at_size(spark):
    """6 GB of tables stage some 3 GB with short ids and 11 GB with long ones; 216 million kills."""
    kills, least = 216_000_000, spark.sparkContext.defaultParallelism
    for staged in (3_060 << 20, 11_000 << 20):
        buckets = bucket_number(spark, staged, etl.BUCKET_BYTES)
        assert kills / buckets < 4_000_000 and buckets & (buckets - 1) == 0
    raw = 12_500 << 20
    with settings(spark, short_tasks(spark, etl.RAW_TASK_BYTES)):
        buckets = bucket_number(spark, raw, etl.RAW_BUCKET_BYTES)
        assert kills / buckets < 4_000_000 and few_files(spark, raw, buckets)
    assert bucket_number(spark, 0, 1) == 1 << (least - 1).bit_length()


def test_settings_of_a_load_are_put_back(spark, config, monkeypatch):  # noqa: F811
    seen = []
    inner = etl._load_warehouse
    monkeypatch.setattr(etl, "_load_warehouse", lambda *a: (seen.append(session.split_bytes(a[0])), inner(*a))[1])
    before = spark.conf.get(SPLIT_BYTES)
    etl.run(spark, config(STATS, KILLS), "20240101")
    assert seen == [etl.TASK_BYTES] and spark.conf.get(SPLIT_BYTES) == before
    with settings(spark, {SPLIT_BYTES: "1m"}):
        assert short_tasks(spark, etl.TASK_BYTES) == {SPLIT_BYTES: str(1 << 20)}
    assert spark.conf.get(SPLIT_BYTES) == before


def test_kills_of_a_match_are_staged_side_by_side(spark, monkeypatch):
    made = []
    config = loads._config
    monkeypatch.setattr(loads, "_config", lambda *a, **o: made.append(config(*a, **o)) or made[-1])
    result = loads.etl_long_ids(spark, SF)
    (job,) = made
    details = read_stage(spark, job.stage_root, "detail", "20240101")
    place = details.select("match_id", F.input_file_name().alias("f"), F.monotonically_increasing_id().alias("i"))
    spread = place.groupBy("match_id").agg(F.count_distinct("f").alias("files"), (F.max("i") - F.min("i") + 1).alias("wide"), F.count("*").alias("n"))
    assert spread.filter("files > 1 OR wide > n").isEmpty() and spread.filter("n > 1").count() > 100
    # The raw files have been loaded and are gone, the result is still there.
    assert not session.folder_exists(spark, job.input_root) and result.count() > 0


@pytest.mark.parametrize("query", ["etl_long_ids", "etl_failed_load", "etl_failed_restage"])
def test_long_ids_are_hardly_shuffled(event_log, query):
    events = event_log(f"""
        from starweave.queries import loads
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "100k")
        spark.conf.set("spark.starweave.broadcastBytes", "100000")
        loads.{query}(spark, "{SF}").write.format("noop").mode("overwrite").save()
    """)
    tasks = [e["Task Metrics"]["Shuffle Write Metrics"] for e in events if e["Event"] == "SparkListenerTaskEnd" and e.get("Task Metrics")]
    # The dates, but no kill: of 6000 line items before, each several times.
    assert sum(t["Shuffle Records Written"] for t in tasks) < 6000
