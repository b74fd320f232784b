from __future__ import annotations

import uuid

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from starweave.operators.clean import clean
from starweave.sinks import TableSpec, analyze, create_tables, load, load_staged, stage, truncate
from starweave.sources import read_csv, read_stage, rejected_rows, schema_by_name, stage_path
from tests.conftest import plan, rows

SCHEMA = "a string, n int, x float"


def test_declared_schema_and_bad_fields(spark, write):
    path = write("t.csv", "a,n,x\nok,1,2.5\nbad,x,1\nfraction,9.0,1\nempty,,1\nshort,3\nlong,4,1,extra\n")
    found = read_csv(spark, path, SCHEMA)
    assert dict(found.dtypes) == {"a": "string", "n": "int", "x": "float"}
    assert [r["a"] for r in found.collect()] == ["ok", "bad", "fraction", "empty", "short", "long"]
    assert rows(clean(found)) == [("long", 4, 1.0), ("ok", 1, 2.5)]


def test_rejected_rows(spark, write):
    path = write("t.csv", "a,n,x\nok,1,2.5\nbad,x,1\nempty,,1\nshort,3\n")
    found = rejected_rows(read_csv(spark, path, SCHEMA, rejects=True))
    assert rows(found.select("a", "_corrupt_record")) == [("bad", "bad,x,1"), ("short", "short,3")]


def test_header_check(spark, write):
    path = write("t.csv", "n,a,x\n1,ok,2.5\n")
    with pytest.raises(Exception, match="CSV header does not conform"):
        read_csv(spark, path, SCHEMA).collect()
    # By position the columns shift, as the header is ignored.
    assert rows(read_csv(spark, path, SCHEMA, header_check=False)) == [("1", None, 2.5)]
    by_name = schema_by_name(spark, path, {"n": "int", "x": "float"})
    assert rows(read_csv(spark, path, by_name).select("a", "n")) == [("ok", 1)]


def test_pieces_without_header(spark, write):
    path = write("t.csv", "p,1,2.5\nq,2,3.5\n")
    assert read_csv(spark, path, SCHEMA, header=False).count() == 2


def test_inferred_schema_with_fixed_types(spark, write):
    path = write("t.csv", "date,n,x\n2017-11-26T20:59:40+0000,1,2.5\n")
    assert dict(read_csv(spark, path).dtypes) == {"date": "timestamp", "n": "int", "x": "double"}
    found = read_csv(spark, path, types={"date": "string"})
    assert rows(found) == [("2017-11-26T20:59:40+0000", 1, 2.5)]


@pytest.mark.parametrize("named", [True, False])
def test_restaging_a_day_leaves_other_days(spark, tmp_path, named):
    root = str(tmp_path)
    stage(spark.range(5), root, "t", "20240101", named)
    stage(spark.range(7), root, "t", "20240102", named)
    stage(spark.range(100, 103), root, "t", "20240102", named)
    found = sorted(r["id"] for r in read_stage(spark, root, "t", "all", named).collect())
    assert found == [0, 1, 2, 3, 4, 100, 101, 102]
    assert read_stage(spark, root, "t", "20240101", named).count() == 5


def test_restaging_with_no_rows_empties_the_day(spark, tmp_path):
    root = str(tmp_path)
    stage(spark.range(5), root, "t", "20240101")
    stage(spark.range(5), root, "t", "20240102")
    stage(spark.range(0), root, "t", "20240102")
    assert read_stage(spark, root, "t", "20240102").count() == 0
    assert read_stage(spark, root, "t", "all").count() == 5


def test_read_stage_choices(spark, tmp_path):
    root = str(tmp_path)
    stage(spark.range(2), root, "t", "20240101")
    stage(spark.range(3), root, "t", "20240110", max_records_per_file=1)
    latest = read_stage(spark, root, "t", with_run_date=True)
    assert latest.columns == ["id", "run_date"] and latest.count() == 3
    assert {r["run_date"] for r in latest.collect()} == {"20240110"}
    every = read_stage(spark, root, "t", "all", with_run_date=True).filter("run_date = '20240101'")
    assert every.count() == 2
    assert "PartitionFilters: [" in plan(every) and "PartitionFilters: []" not in plan(every)
    with pytest.raises(ValueError):
        stage_path(root, "t", "2024-01-01")
    with pytest.raises(ValueError):
        read_stage(spark, root, "t", "latest", named=False)


@pytest.fixture
def database(spark, tmp_path):
    name = f"db_{uuid.uuid4().hex}"
    yield name
    spark.sql(f"DROP DATABASE IF EXISTS {name} CASCADE")


TYPED = TableSpec("t", "k VARCHAR(8), n INT, x DOUBLE", sort=("k",))


def frame(spark, *data, ddl="k string, n int, x float"):
    return spark.createDataFrame(list(data), ddl)


def test_create_is_idempotent_and_load_replaces(spark, database):
    create_tables(spark, [TYPED], database)
    load(frame(spark, ("b", 1, 0.5), ("a", 2, 0.25)), TYPED, database)
    create_tables(spark, [TYPED], database)
    assert rows(spark.table(f"{database}.t")) == [("a", 2, 0.25), ("b", 1, 0.5)]
    load(frame(spark, ("c", 3, 1.0)), TYPED, database)
    assert rows(spark.table(f"{database}.t")) == [("c", 3, 1.0)]
    load(frame(spark, ("d", 4, 1.0)), TYPED, database, "append")
    assert spark.table(f"{database}.t").count() == 2
    analyze(spark, database, "t")
    truncate(spark, database, "t")
    assert spark.table(f"{database}.t").count() == 0


def test_float_widens_on_load(spark, database):
    create_tables(spark, [TYPED], database)
    load(frame(spark, ("a", 1, 0.1)), TYPED, database)
    assert spark.table(f"{database}.t").first()["x"] == 0.10000000149011612


def test_load_is_by_position(spark, database):
    create_tables(spark, [TYPED], database)
    load(frame(spark, ("a", 1, 0.5), ddl="x string, y int, z float"), TYPED, database)
    assert rows(spark.table(f"{database}.t")) == [("a", 1, 0.5)]


def test_load_rejects_misfits(spark, database):
    create_tables(spark, [TYPED], database)
    load(frame(spark, ("kept", 1, 0.5)), TYPED, database)
    with pytest.raises(PySparkException, match="EXCEED_LIMIT_LENGTH"):
        load(frame(spark, ("123456789", 1, 0.5)), TYPED, database, "append")
    with pytest.raises(ValueError, match="columns"):
        load(frame(spark, ("a", 1), ddl="k string, n int"), TYPED, database)
    with pytest.raises(PySparkException):
        load(frame(spark, ("a", "b", 0.5), ddl="k string, n string, x float"), TYPED, database)
    with pytest.raises(ValueError, match="mode"):
        load(frame(spark, ("a", 1, 0.5)), TYPED, database, "other")
    assert rows(spark.table(f"{database}.t")) == [("kept", 1, 0.5)]


def test_bucketed_table_joins_without_shuffle(spark, database):
    spec = TableSpec("b", "k INT, v STRING", bucket_by=("k",), sort=("k",), buckets=4)
    other = TableSpec("c", "k INT, w STRING", bucket_by=("k",), sort=("k",), buckets=4)
    create_tables(spark, [spec, other], database)
    df = spark.range(100).select(F.col("id").cast("int"), F.col("id").cast("string"))
    load(df, spec, database)
    load(df, other, database)
    b, c = spark.table(f"{database}.b"), spark.table(f"{database}.c")
    assert len(b.inputFiles()) == 4
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        assert "Exchange" not in plan(b.join(c, "k"))
        assert b.join(c, "k").count() == 100
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_sorted_load_gives_disjoint_file_ranges(spark, database):
    spec = TableSpec("s", "x DOUBLE, k BIGINT", sort=("x",))
    create_tables(spark, [spec], database)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        load(spark.range(8000).select((F.col("id") * 37 % 8000).cast("double"), "id"), spec, database)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    table = spark.table(f"{database}.s").groupBy(F.input_file_name().alias("f"))
    ranges = table.agg(F.min("x").alias("low"), F.max("x").alias("high")).orderBy("low").collect()
    assert len(ranges) > 1
    assert all(a["high"] < b["low"] for a, b in zip(ranges, ranges[1:]))


def test_load_staged_days(spark, tmp_path, database):
    spec = TableSpec("t", "k BIGINT", source="day_table")
    create_tables(spark, [spec], database)
    root = str(tmp_path)
    stage(spark.range(2), root, "day_table", "20240101")
    stage(spark.range(3), root, "day_table", "20240102")
    for day, count in (("20240101", 2), ("latest", 3), ("all", 5)):
        load_staged(spark, spec, database, root, day)
        assert spark.table(f"{database}.t").count() == count
