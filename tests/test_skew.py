"""A third of the rows on one key: whole results, and split or reduced groups."""

from __future__ import annotations

import re

import pytest
from pyspark.sql import functions as F

from starweave.operators import Link, Star, build_fact, latest_per_key, one_per_key, orphan_keys
from tests.conftest import plan

ROWS = 300_000
SMALL = {
    "spark.sql.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "64k",
    "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "128k",
    "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    "spark.sql.shuffle.partitions": "16",
}


@pytest.fixture
def tight(spark):
    before = {k: spark.conf.get(k, None) for k in SMALL}
    for name, value in SMALL.items():
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def hot(spark):
    """Fact rows; key 0 holds a third of them."""
    rows = spark.range(0, ROWS, 1, 8)
    return rows.select(
        F.col("id"),
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 5000).alias("k"),
        F.sha2(F.col("id").cast("string"), 256).alias("v"),
    )


def executed(df) -> str:
    df.collect()
    return plan(df)


def test_fact_join_splits_a_hot_key(spark, tight):
    right = spark.range(5000).select(F.col("id").alias("k"), F.col("id").cast("string").alias("name"))
    fact = build_fact(hot(spark), right, [("k", "k")], {"id": ("left", "id"), "v": ("left", "v"), "n": ("right", "name")})
    assert "skew=true" in executed(fact)
    assert fact.count() == ROWS


def test_star_join_splits_a_hot_key(spark, tight):
    dim = one_per_key(hot(spark).select("k", "v"), "k")
    star = Star("f", hot(spark), {"d": dim}, (Link("d", "k", "k"),), complete=True)
    joined = star.stored("d").join()
    assert "skew=true" in executed(joined)
    assert joined.count() == ROWS


@pytest.mark.parametrize("pick", [lambda df: one_per_key(df, "k"), lambda df: latest_per_key(df, "k", "id")])
def test_a_hot_key_is_reduced_before_the_shuffle(spark, tight, pick):
    picked = pick(hot(spark))
    text = executed(picked)
    assert picked.count() == hot(spark).select("k").distinct().count()
    # Below the exchange: a partial aggregate, at most one row per key and task.
    below = text[text.index("Exchange hashpartitioning") :]
    assert re.search(r"SortAggregate\(key=\[.*functions=\[partial_", below)


def test_keys_to_keep_are_joined_after_the_reduction(spark, tight):
    among = spark.range(100).select(F.col("id").alias("k"))
    text = executed(one_per_key(hot(spark), "k", among=among))
    # The raw rows meet a partial aggregate before any exchange or join.
    raw = text[text.rindex("Range (0, 300000") - 2500 : text.rindex("Range (0, 300000")]
    assert raw.rindex("partial_min") > raw.rindex("Exchange")


def test_orphans_of_a_hot_key_are_counted_before_the_join(spark, tight):
    dim = spark.range(1, 5000).select(F.col("id").alias("k"))
    found = orphan_keys(hot(spark), "k", dim, "k")
    expected = hot(spark).filter("k = 0").count()
    assert [tuple(r) for r in found.collect()] == [(0, expected)]
    text = plan(found)
    assert text.index("Join") < text.index("HashAggregate")
