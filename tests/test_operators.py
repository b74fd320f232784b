from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from starweave.operators import (
    Link,
    Star,
    add_surrogate,
    broadcast_if_small,
    build_fact,
    clean,
    distinct_rows,
    drop_null_rows,
    latest_per_key,
    one_per_key,
    range_sorted,
)
from starweave.session import concurrently, materialize, scratch_dir
from tests.conftest import plan, rows

NAN = float("nan")


def test_drop_null_rows_also_drops_nan(spark):
    df = spark.createDataFrame([(1, 1.0), (2, None), (3, NAN), (None, 1.0)], "a int, b double")
    assert rows(drop_null_rows(df)) == [(1, 1.0)] == rows(df.dropna())
    assert rows(drop_null_rows(df, ["a"]).select("a")) == [(1,), (2,), (3,)]


def test_distinct_merges_nan_and_signed_zero(spark):
    df = spark.createDataFrame([(NAN,), (NAN,), (0.0,), (-0.0,)], "a double")
    assert distinct_rows(df).count() == 2


def test_clean(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, None), (1, "y")], "a int, b string")
    assert rows(clean(df)) == [(1, "x"), (1, "y")]


def test_one_per_key_takes_lowest_row(spark):
    data = [(1, "b", 1.0), (1, "a", 9.0), (1, "a", 2.0), (2, None, 3.0), (2, "a", 3.0), (None, "z", 0.0)]
    df = spark.createDataFrame(data, "k int, s string, v double")
    expected = sorted([(1, "a", 2.0), (2, None, 3.0), (None, "z", 0.0)], key=repr)
    for parts in (1, 3, 7):
        assert rows(one_per_key(df.repartition(parts), "k")) == expected
        assert rows(one_per_key(df.repartition(parts), "k", repeats=True)) == expected
    assert (1, "b", 1.0) in rows(one_per_key(df, "k", order=["v"]))
    assert one_per_key(df, "k").columns == df.columns
    assert rows(one_per_key(df.select("s"), "s")) == rows(df.select("s").distinct())


def test_one_per_key_reduces_before_the_shuffle(spark):
    df = spark.range(10000).select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("v"))
    text = plan(one_per_key(df, "k"))
    assert text.index("partial_min") > text.index("Exchange hashpartitioning")
    assert text.count("Exchange") == 1


def test_latest_per_key(spark):
    df = spark.createDataFrame([(1, "a", "20240101"), (1, "b", "20240102"), (2, "c", "20240101")], "k int, v string, d string")
    assert rows(latest_per_key(df, "k", "d")) == [(1, "b", "20240102"), (2, "c", "20240101")]


def test_monotonic_ids_are_unique(spark):
    df = add_surrogate(spark.range(0, 1000, 1, 7), "row")
    assert df.columns == ["row", "id"]
    assert df.select("row").distinct().count() == 1000


def test_dense_ids_follow_the_order(spark):
    df = spark.range(0, 1000, 1, 7).select((F.col("id") * 7919 % 1000).alias("v"))
    found = add_surrogate(df, "row", "dense", ["v"]).collect()
    assert all(r["row"] == r["v"] for r in found) and len(found) == 1000


def test_dense_ids_with_a_hot_value(spark):
    df = spark.range(0, 9000, 1, 5).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("v"))
    dense = add_surrogate(df, "row", "dense", ["v"])
    assert sorted(r[0] for r in dense.select("row").collect()) == list(range(9000))
    assert [r["v"] for r in dense.orderBy("row").collect()] == sorted(r["v"] for r in df.collect())


def test_unknown_id_kind(spark):
    with pytest.raises(ValueError):
        add_surrogate(spark.range(1), "row", "other")


def test_range_sorted_splits_a_hot_value(spark):
    df = spark.range(0, 40000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, 0.0).otherwise(F.col("id").cast("double")).alias("x"), "id"
    )
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        parts = range_sorted(df, ["x"]).withColumn("part", F.spark_partition_id()).cache()
        sizes = [r["count"] for r in parts.groupBy("part").count().collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert parts.filter("x = 0").select("part").distinct().count() > 1
    assert max(sizes) < 2 * 40000 / len(sizes)
    ranges = parts.groupBy("part").agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("part").collect()
    assert all(a["high"] <= b["low"] for a, b in zip(ranges, ranges[1:]))
    parts.unpersist()


def test_build_fact_qualifies_columns(spark):
    left = spark.createDataFrame([(1, "p", 10), (2, "q", 20)], "m int, n string, v int")
    right = spark.createDataFrame([(1, "p", 7), (1, "p", 8), (1, "x", 9)], "m int, n string, v int")
    fact = build_fact(left, right, [("m", "m"), ("n", "n")], {"m": ("left", "m"), "a": ("left", "v"), "b": ("right", "v")})
    assert rows(fact) == [(1, 10, 7), (1, 10, 8)]


def test_broadcast_only_after_measuring(spark):
    df = spark.range(1000).select(F.col("id"), F.lit("x" * 100).alias("t"))
    other = spark.range(10)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "BroadcastHashJoin" in plan(other.join(broadcast_if_small(df), "id"))
        assert "BroadcastHashJoin" not in plan(other.join(broadcast_if_small(df, 1000), "id"))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert broadcast_if_small(df.limit(0)).count() == 0


@pytest.fixture
def star(spark):
    fact = spark.createDataFrame([(1, 10, "a"), (2, 20, "a"), (3, 10, "b")], "id int, x int, d string")
    dim = spark.createDataFrame([("a", "A"), ("b", "B"), ("c", "C")], "d string, v string")
    return Star("f", fact, {"dim": dim}, (Link("dim", "d", "d"),), complete=True)


def test_star_join_names_columns_by_table(star):
    assert star.join().columns == ["f_id", "f_x", "f_d", "dim_d", "dim_v"]
    assert rows(star.join().select("f_id", "dim_v")) == [(1, "A"), (2, "A"), (3, "B")]


def test_star_top_with_and_without_completeness(star):
    from dataclasses import replace

    for s in (star, replace(star, complete=False)):
        found = s.top(["x", "id"], 2, dims=["dim"])
        assert [(r["f_id"], r["dim_v"]) for r in found.collect()] == [(1, "A"), (3, "B")]
    assert star.top(["x"], 5000, dims=["dim"]).count() == 3


def test_incomplete_star_joins_before_the_limit(star, spark):
    from dataclasses import replace

    less = replace(star, dims={"dim": spark.createDataFrame([("a", "A")], "d string, v string")}, complete=False)
    assert [r["f_id"] for r in less.top(["x", "id"], 2, dims=["dim"]).collect()] == [1, 2]


def test_star_integrity(star, spark):
    from dataclasses import replace

    assert rows(star.integrity()) == [("dim", 3, 0, 3, 0, 3)]
    bad = spark.createDataFrame([("a", "A"), ("a", "B")], "d string, v string")
    assert rows(replace(star, dims={"dim": bad}).integrity()) == [("dim", 2, 1, 3, 1, 4)]


def test_scratch_is_below_the_named_folder(spark):
    assert scratch_dir(spark).startswith(spark.conf.get("spark.checkpoint.dir") + "/")
    assert scratch_dir(spark) != scratch_dir(spark)


def test_materialize_keeps_rows_and_types(spark):
    df = spark.createDataFrame([(1, "a", 1.5), (None, None, NAN)], "i int, s string, d double")
    back = materialize(df, "t")
    assert back.dtypes == df.dtypes and repr(rows(back)) == repr(rows(df))


class FakeSession:
    def __init__(self, **settings):
        self.conf = {k.replace("__", "."): v for k, v in settings.items()}


def test_scratch_without_a_named_folder():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        scratch_dir(FakeSession(spark__master="yarn"))
    first, second = (scratch_dir(FakeSession(spark__master="local[2]")) for _ in range(2))
    assert first != second and first.rsplit("/", 1)[0] == second.rsplit("/", 1)[0]


def test_concurrently_keeps_order_and_raises():
    assert concurrently(lambda i=i: i for i in range(5)) == list(range(5))
    with pytest.raises(ZeroDivisionError):
        concurrently([lambda: 1, lambda: 1 // 0])


def test_concurrently_without_jobs():
    assert concurrently([]) == []


def test_one_per_key_zeros_nulls_and_dotted_names(spark):
    for data in ([(1, 0.0), (1, -0.0)], [(1, -0.0), (1, 0.0)]):
        df = spark.createDataFrame(data, "`a.b` int, v double")
        assert repr(rows(one_per_key(df, "a.b"))) == repr([(1, 0.0)])
        assert repr(rows(one_per_key(df.withColumn("w", F.lit("x")), "a.b", repeats=True))) == repr([(1, 0.0, "x")])
    df = spark.createDataFrame([(1, 5), (1, None), (2, 3), (2, 4), (3, None)], "k int, v int")
    assert rows(one_per_key(df, "k")) == [(1, None), (2, 3), (3, None)]


def test_digest_keeps_parts_apart(spark):
    data = [("a|b", "c"), ("a", "b|c"), (None, "x"), ("", "x"), ("1:x", ""), ("", "1:x"), ("n", None), (None, "n")]
    df = spark.createDataFrame(data, "a string, b string")
    for columns in ((), ("a", "b")):
        assert add_surrogate(df, "id", "digest", columns).select("id").distinct().count() == len(data)


def test_star_top_runs_nothing_while_it_is_built(star, spark):
    tracker = spark.sparkContext.statusTracker()
    before = len(tracker.getJobIdsForGroup(None))
    small, large = (star.top(["x"], n, dims=["dim"]) for n in (2, 100_000))
    assert len(tracker.getJobIdsForGroup(None)) == before
    shapes = [[line.strip(" +-:*()0123456789").split(" ")[0].split("(")[0] for line in plan(s).splitlines()] for s in (small, large)]
    assert shapes[0] == shapes[1]


def test_clear_scratch_deletes_what_was_made(spark):
    from pathlib import Path

    from starweave.session import clear_scratch

    kept = materialize(spark.range(3), "t")
    folder = Path(scratch_dir(spark)).parent
    assert kept.count() == 3 and any(folder.glob("starweave-*/t"))
    clear_scratch(spark)
    assert not any(folder.glob("starweave-*"))
