"""How much is read and shuffled: bounds, pruning, clustering, late distinct, one-pass scans."""

from __future__ import annotations

from dataclasses import replace
from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from starweave.operators import (
    Measured,
    check_join_size,
    distinct_rows,
    distinct_rows_late,
    gate_measured,
    gate_report,
    join_size,
    measured_report,
    z_ordered,
)
from starweave.plans import match_star as ms
from starweave.queries import roles, stars
from starweave.session import BROADCAST_BYTES
from starweave.sinks import stage_all
from starweave.sources import read_csv, read_csv_once
from tests.conftest import plan, rows

SF = "/root/testdata/sf0.001"


def written(events: list[dict]) -> int:
    """Shuffle bytes that all tasks wrote."""
    found = [e["Task Metrics"]["Shuffle Write Metrics"]["Shuffle Bytes Written"] for e in events if e["Event"] == "SparkListenerTaskEnd"]
    return sum(found)


def test_a_report_chooses_its_rows_once(spark):
    star = roles.star(spark, SF).stored("dates")
    for report in (
        ms.area_report(star, stars.LOW, stars.HIGH, stars.MONTH, 50),
        stars.star_top_large(spark, SF),
        stars.star_top_bound(spark, SF),
    ):
        text = plan(report)
        assert text.count("TakeOrderedAndProject") == 1
        assert "Python" not in text


def test_the_bound_of_a_report_reaches_the_scan(spark):
    star = ms.in_area_and_month(ms.for_report(roles.star(spark, SF).stored("dates")), stars.LOW, stars.HIGH, stars.MONTH)
    bounded = star.bounded("killer_position_x", 5, ["dates"])
    text = plan(bounded.join(["dates"]))
    low = rows(star.join(["dates"]).select("locations_killer_position_x"))[:5]
    last = sorted(r[0] for r in star.join(["dates"]).select("locations_killer_position_x").collect())[4]
    assert f"LessThanOrEqual(l_extendedprice,{last})" in text
    assert len(low) == 5
    assert bounded.join(["dates"]).count() < star.join(["dates"]).count()


def test_bounds_with_ties_nulls_and_few_rows(spark):
    from starweave.operators.star import Link, Star

    fact = spark.createDataFrame([(x, i % 2, i) for i, x in enumerate([3.0, None, 1.0, 1.0, 2.0, None, 2.0])], "x double, k int, i int")
    dim = spark.createDataFrame([(0, "a"), (1, "b")], "d int, name string")
    star = Star("f", fact, {"dim": dim}, (Link("dim", "k", "d"),), complete=True)
    for n in range(1, 9):
        for first in ([], ["dim"]):
            others = [] if first else ["dim"]
            found = star.top(["x", "i"], n, first, others, bound=True)
            assert rows(found) == rows(star.top(["x", "i"], n, first, others))
            loose = replace(star, complete=False).top(["x", "i"], n, first, others, bound=True)
            assert rows(loose.select("f_i")) == rows(found.select("f_i"))
    assert star.bounded("x", 7) is not star and star.bounded("x", 8) is star
    assert star.bounded("x", 2).fact.count() == 2 and star.bounded("x", 3).fact.count() == 4


def test_only_the_folders_of_the_months_are_read(spark):
    star = roles.star(spark, SF, ids="digest", id_columns=stars.NATURAL)
    part = stars._by_month(spark, star)
    query = part.join(["dates"]).select("locations_location_id", "dates_week")
    assert "dynamicpruning" in plan(query)
    want = rows(query)
    months = {r["month"] for r in part.dims["dates"].select("month").distinct().collect()}
    assert months and len(months) < 12
    folder = Path(part.fact.inputFiles()[0].removeprefix("file://").removeprefix("file:")).parent.parent
    spoiled = 0
    for file in folder.glob("date_month=*/*.parquet"):
        if int(file.parent.name.split("=")[1]) not in months:
            file.write_bytes(b"not Parquet")
            spoiled += 1
    assert spoiled >= 8
    assert rows(query) == want and want


def test_a_measured_write_gives_the_gate_its_shares(spark, tmp_path):
    some = spark.createDataFrame([(1, None), (None, "x"), (3, None), (4, "y")], "k int, `odd name` string").repartition(3)
    tables = {"some": some, "none": some.limit(0), "folded": some.filter("false")}
    checks = {t: ["k", "odd name"] for t in tables}
    measured = {t: Measured(tuple(c)) for t, c in checks.items()}
    stage_all({t: measured[t].on(df) for t, df in tables.items()}, str(tmp_path), "20240101")
    missing = {t: m.missing() for t, m in measured.items()}
    assert missing["some"] == {"k": 0.25, "odd name": 0.5}
    assert rows(measured_report(spark, missing)) == rows(gate_report(tables, checks))
    with pytest.raises(ValueError, match="some.k: 0.25"):
        gate_measured(missing)
    gate_measured({"t": {"k": 0.0}})


def test_the_gate_of_a_staging_reads_nothing(event_log):
    """One job for each table that is written, and none after them."""
    events = event_log(f"""
        from starweave.operators import Measured, gate_measured
        from starweave.sinks import stage_all
        df = spark.read.parquet("{SF}/orders.parquet")
        m = Measured(("o_orderkey",))
        stage_all({{"orders": m.on(df)}}, folder + "/s", "20240101")
        spark.sparkContext.setJobGroup("gate", "gate")
        gate_measured({{"orders": m.missing()}})
        """)
    jobs = [e for e in events if e["Event"] == "SparkListenerJobStart"]
    assert jobs and not any(e["Properties"].get("spark.jobGroup.id") == "gate" for e in jobs)


def test_z_order_lets_a_range_of_either_column_skip_row_groups(spark, tmp_path):
    df = spark.range(40000).select(
        (F.rand(1) * 1000).alias("x"), (F.rand(2) * 3 - 7).alias("y"), F.col("id")
    )
    paths = {}
    for name, ordered in (("z", z_ordered(df, ["x", "y"])), ("sorted", df.orderBy("x", "y"))):
        paths[name] = str(tmp_path / name)
        ordered.coalesce(1).write.option("parquet.block.size", 1 << 12).option("parquet.page.size", 1 << 10).option(
            "parquet.block.size.row.check.min", 100
        ).option("parquet.page.row.count.limit", 200).option("parquet.page.size.row.check.min", 100).parquet(paths[name])

    def kept(name, column, low, high):
        """Share of the row groups whose range of a column meets that of the query."""
        total = met = 0
        for file in Path(paths[name]).glob("*.parquet"):
            meta = pq.ParquetFile(file).metadata
            at = [c for c in range(meta.num_columns) if meta.row_group(0).column(c).path_in_schema == column][0]
            for g in range(meta.num_row_groups):
                s = meta.row_group(g).column(at).statistics
                total += 1
                met += s.min <= high and s.max >= low
        assert total >= 20
        return met / total

    assert kept("z", "x", 500, 510) < 0.3 and kept("z", "y", -6, -5.97) < 0.3
    assert kept("sorted", "y", -6, -5.97) > 0.9
    assert rows(spark.read.parquet(paths["z"]).select("id")) == rows(df.select("id"))


def test_z_order_of_odd_values(spark):
    data = [(1.0, None, 1), (float("nan"), 2.0, 2), (None, None, 3), (float("inf"), -1.0, 4), (-5.0, 3.0, 5)]
    df = spark.createDataFrame(data, "x double, y double, i int")
    assert z_ordered(df, ["x", "y"]).count() == 5
    assert z_ordered(df.limit(0), ["x", "y"]).count() == 0
    same = spark.createDataFrame([(2.0, 1)] * 3, "x double, i int")
    assert z_ordered(same, ["x", "i"]).count() == 3


def test_late_distinct_is_exact(spark):
    data = [(1, "a", 0.0, None), (1, "a", -0.0, None), (None, "a", 1.0, "x"), (None, "a", 1.0, "x"), (2, None, float("nan"), "x"), (2, None, float("nan"), "x"), (3, "b", 1.0, "y")]
    df = spark.createDataFrame(data, "a int, `b c` string, d double, e string").repartition(3)
    assert repr(rows(distinct_rows_late(df))) == repr(rows(distinct_rows(df)))
    assert distinct_rows_late(df).count() == 4
    assert distinct_rows_late(df.limit(0)).count() == 0
    # A digest that is equal by chance (nulls leave it as it is) is no equality.
    twins = spark.createDataFrame([(None, 7), (7, None), (7, 7)], "a int, b int")
    assert distinct_rows_late(twins).count() == 3
    # More repeated digests than may be broadcast.
    bound = spark.conf.get(BROADCAST_BYTES)
    spark.conf.set(BROADCAST_BYTES, "32")
    try:
        assert repr(rows(distinct_rows_late(df))) == repr(rows(distinct_rows(df)))
    finally:
        spark.conf.set(BROADCAST_BYTES, bound)


def test_late_distinct_shuffles_less_than_a_third(event_log):
    code = """
        from pyspark.sql import functions as F
        from starweave.operators import distinct_rows, distinct_rows_late
        docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
        df = docs.unionAll(docs.filter("lang = 'es'"))
        {}(df).write.format("noop").mode("overwrite").save()
        """
    late, plain = (written(event_log(code.format(f))) for f in ("distinct_rows_late", "distinct_rows"))
    assert 0 < late < plain / 3


ODD_CSV = """\
i,l,w,d,dt,ts,b,s,n,mix,when,di
1,1,99999999999999999999,1.5,2020-01-02,2020-01-02 03:04:05,true,x,,1,2020-01-01,1
-2,3000000000,1,2,2020-12-31,2021-01-02T03:04:05,FALSE,1,,true,2020-01-01 10:00:00,2.5
,,,NaN,,,,,,,,
+3,4,-7,1e5,2021-02-28,2021-01-02 03:04,true,2020,,2,2020-01-02,99999999999
"""


def test_types_inferred_in_one_scan_are_those_of_the_reader(spark, write):
    path = write("odd.csv", ODD_CSV)
    once, twice = read_csv_once(spark, path), read_csv(spark, path)
    assert once.dtypes == twice.dtypes
    assert repr(rows(once)) == repr(rows(twice))  # NaN is not equal to itself
    fixed = read_csv_once(spark, path, {"i": "string", "d": "float"})
    assert dict(fixed.dtypes)["i"] == "string" and dict(fixed.dtypes)["d"] == "float"
    empty = read_csv_once(spark, write("empty.csv", "a,b\n"))
    assert empty.dtypes == [("a", "string"), ("b", "string")] and empty.count() == 0


def test_inference_scans_the_file_once(event_log):
    """Beyond the header line, which takes one task, each part of the file is read by one task."""
    events = event_log("""
        from starweave.sources import read_csv_once
        spark.range(0, 20000, 1, 4).selectExpr("id", "id / 2 AS x", "cast(id as string) AS s").write.option("header", True).csv(folder + "/csv")
        spark.sparkContext.setJobGroup("infer", "infer")
        read_csv_once(spark, folder + "/csv", folder=folder + "/t")
        """)
    stages = {s for e in events if e["Event"] == "SparkListenerJobStart" and e["Properties"].get("spark.jobGroup.id") == "infer" for s in e["Stage IDs"]}
    read = {}
    for e in events:
        if e["Event"] == "SparkListenerTaskEnd" and e["Stage ID"] in stages:
            read[e["Stage ID"]] = read.get(e["Stage ID"], 0) + e["Task Metrics"]["Input Metrics"]["Records Read"]
    whole = [n for n in read.values() if n >= 20000]
    assert len(whole) == 1 and sum(read.values()) < 1.1 * whole[0]


def test_join_size_of_hot_and_null_keys(spark):
    left = spark.createDataFrame([(1, "a")] * 500 + [(2, "b"), (None, "c"), (3, None)], "k int, s string")
    right = spark.createDataFrame([(1, "a")] * 300 + [(2, "b"), (2, "b"), (None, "c"), (3, None), (9, "z")], "q int, t string")
    on = [("k", "q"), ("s", "t")]
    (found,) = join_size(left, right, on).collect()
    joined = left.join(right, (F.col("k") == F.col("q")) & (F.col("s") == F.col("t"))).count()
    assert tuple(int(v) for v in found) == (2, 501, 302, 150002, 150000) and joined == 150002
    assert check_join_size(left, right, on, 150002) == 150002
    with pytest.raises(ValueError, match="one key gives 150000"):
        check_join_size(left, right, on, 150001)
    (none,) = join_size(left.limit(0), right, on).collect()
    assert none["join_rows"] == 0 and none["largest"] is None

