"""What is shuffled and written on the way: the same rows in fewer bytes."""

from __future__ import annotations

from pathlib import Path

import pyarrow.parquet as pq
import pytest

from starweave.operators.dedup import SEVERAL, one_per_key
from starweave.operators.quality import Measured
from starweave.queries import loads, stars
from starweave.session import materialize
from starweave.sinks.stage import stage
from starweave.sinks.warehouse import TableSpec, create_tables, load

KEYED = "k string, j int, a double, b string"
ROWS = [
    ("x", 1, -0.0, "p"), ("x", 1, 1.0, "o"), ("x", 2, 3.0, "n"), ("y", 1, None, "m"),
    (None, 1, 2.0, "l"), (None, 1, 1.5, "k"), ("z", None, 0.0, None), ("w", 9, -0.0, "j"),
]


def codecs(folder):
    files = [f for f in Path(folder).rglob("*") if f.is_file() and ".parquet" in f.name and not f.name.startswith(".")]
    metas = [pq.ParquetFile(f).metadata for f in files]
    return {m.row_group(0).column(0).compression for m in metas if m.num_row_groups}


def test_parquet_files_are_zstd(spark, tmp_path):
    rows = spark.createDataFrame(ROWS, KEYED)
    materialize(rows, "kept", str(tmp_path))
    stage(rows, str(tmp_path / "stage"), "rows", "20240101")
    spec = TableSpec("rows", KEYED, bucket_by=("j",), buckets=2)
    create_tables(spark, [spec], "bytes_db", f"{tmp_path}/db")
    try:
        load(rows, spec, "bytes_db")
        assert spark.table("bytes_db.rows").count() == len(ROWS)
        for part in ("kept", "stage", "db"):
            assert codecs(tmp_path / part) == {"ZSTD"}
    finally:
        spark.sql("DROP DATABASE bytes_db CASCADE")


def sets(df):
    return sorted((tuple(repr(v) for v in r) for r in df.collect()))


@pytest.mark.parametrize("most", [64 << 20, 0])
def test_rare_repeats_give_the_same_rows(spark, tmp_path, most):
    rows = spark.createDataFrame(ROWS, KEYED).repartition(3)
    want = one_per_key(rows, ["k", "j"])
    old = spark.conf.get("spark.starweave.broadcastBytes", None)
    spark.conf.set("spark.starweave.broadcastBytes", str(most))
    try:
        got = one_per_key(rows, ["k", "j"], rare=str(tmp_path))
        assert got.columns == want.columns and sets(got) == sets(want)
    finally:
        spark.conf.unset("spark.starweave.broadcastBytes")
        if old is not None:
            spark.conf.set("spark.starweave.broadcastBytes", old)
    alone = [r for r in got.collect() if r["k"] == "w"]
    assert [repr(r["a"]) for r in alone] == ["0.0"]


def test_several_natural_keys_of_a_key_are_told(spark):
    rows = spark.createDataFrame(ROWS, KEYED)
    told = {r["k"]: r[SEVERAL] for r in one_per_key(rows, "k", natural=["j"]).collect()}
    assert told == {"x": True, "y": False, None: False, "z": False, "w": False}
    seen = Measured(("k",), (SEVERAL,))
    seen.on(one_per_key(rows, "k", natural=["j"])).write.format("noop").mode("overwrite").save()
    assert seen.told(SEVERAL) == 1 and seen.missing() == {"k": 0.2}


def test_raw_files_are_compressed_and_short(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(loads, "RAW_ROWS", 1000)
    loads._write_raw(spark, "/root/testdata/sf0.001", str(tmp_path))
    for path in ("aggregate", "kill"):
        files = [f for f in (tmp_path / path).rglob("part-*") if not f.name.endswith(".crc")]
        assert files and all(f.name.endswith(".csv.gz") for f in files)
    assert len(files) > 1  # 6000 kills


def test_wide_rows_get_their_ids_after_the_joins(spark):
    df = stars.wide_star(spark, "/root/testdata/sf0.001")
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("md5(") == 1 and plan.index("md5(") < plan.index("Join")
    assert df.columns[0] == "locations_location_id" and not any("_id_" in c for c in df.columns)
    assert df.select("locations_location_id").distinct().count() == df.count()
