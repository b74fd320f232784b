"""What reaches the scan, and what is shuffled."""

from __future__ import annotations

import uuid

import pytest
from pyspark.sql import functions as F

from starweave import __main__ as job
from starweave.operators import clean, drop_null_rows
from starweave.plans import etl, match_star as ms
from starweave.queries import roles
from tests.conftest import plan
from tests.test_match_star import KILLS, KILLS_HEADER, STATS, STATS_HEADER

SF = "/root/testdata/sf0.001"


@pytest.fixture
def database(spark, tmp_path, write):
    name = f"plans_{uuid.uuid4().hex}"
    write(f"in/{ms.STATS_PATH}", STATS_HEADER + STATS)
    write(f"in/{ms.KILLS_PATH}", KILLS_HEADER + KILLS)
    places = [str(tmp_path / "in"), str(tmp_path / "staged"), name]
    job.main([*places, "--database-location", str(tmp_path / "w"), "--run-date", "20240101"], spark)
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


def test_job_entry_loads_the_star(spark, database):
    assert spark.table(f"{database}.locations").count() == 5


def test_range_predicate_reaches_the_fact_scan(spark, database):
    star = etl.open_star(spark, database)
    text = plan(ms.area_report(star, 2000.0, 600000.0, 10))
    assert "GreaterThanOrEqual(killer_position_x,2000.0)" in text
    assert "LessThanOrEqual(killer_position_x,600000.0)" in text
    assert "EqualTo(month,10)" in text


def test_report_reads_only_its_columns(spark, database):
    star = etl.open_star(spark, database)
    text = plan(ms.area_report(star, 2000.0, 600000.0, 10))
    for unused in ("victim_name", "dist_ride", "survive_time", "location_id", "weekday"):
        assert f"{unused}:" not in text


def test_marked_dimension_is_broadcast_when_small(spark, database):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(etl.open_star(spark, database).join())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("BroadcastHashJoin") == 1 and text.count("SortMergeJoin") == 3


def test_null_tests_reach_the_scan_and_stay_below_the_distinct(spark):
    orders = roles.table(spark, SF, "orders")
    text = plan(clean(orders))
    assert "IsNotNull(o_orderkey)" in text
    assert text.rindex("HashAggregate") < text.index("Filter")
    assert text.count("Exchange") == 1


def test_filters_pass_the_row_ids_when_these_are_not_read(spark):
    star = ms.for_report(roles.star(spark, SF))
    text = plan(star.filtered(ms.area_and_month(1.0, 2.0, 10)).fact)
    assert "GreaterThanOrEqual(l_extendedprice,1.0)" in text
    assert "monotonically_increasing_id" not in text


def test_dimensions_need_one_shuffle(spark):
    orders = drop_null_rows(roles.table(spark, SF, "orders"))
    assert plan(ms.performance_dim(roles.as_stats(orders))).count("Exchange") == 1


def test_dimensions_of_few_rows_are_hashed_below_the_shuffle(spark):
    kills, stats = roles.kills(spark, SF, False), roles.stats(spark, SF, False)
    for dim in (ms.date_dim(stats), ms.match_dim(kills, stats)):
        text = plan(dim)
        lowest = text[text.rindex("Exchange hashpartitioning") :]
        assert "HashAggregate" in lowest and "SortAggregate" not in lowest


def test_bucketed_star_tables_join_without_a_shuffle(spark):
    from starweave.queries.loads import layout_bucket_join

    text = plan(layout_bucket_join(spark, SF))
    assert "SortMergeJoin" in text and "Exchange" not in text


def test_month_of_the_key_agrees_with_the_dimension(spark):
    dates = ms.date_dim(roles.stats(spark, SF, False))
    assert dates.filter(F.month("game_time") != F.col("month")).count() == 0
