from __future__ import annotations

import pytest

from starweave.operators import (
    fanout_report,
    gate,
    gate_report,
    key_collisions,
    null_fractions,
    orphan_keys,
    repeated_keys,
)
from tests.conftest import rows


@pytest.fixture
def tables(spark):
    return {
        "whole": spark.createDataFrame([("a", 1), ("b", 2)], "k string, n int"),
        "holes": spark.createDataFrame([("a", 1), (None, 2)], "k string, n int"),
        "empty": spark.createDataFrame([], "k string, n int"),
    }


def test_null_fractions(tables):
    assert rows(null_fractions(tables["holes"])) == [("k", 0.5), ("n", 0.0)]
    assert rows(null_fractions(tables["empty"], ["k"])) == [("k", None)]


def test_gate_report(tables):
    report = gate_report(tables, {"whole": ["k", "n"], "holes": ["k"], "empty": ["k"]})
    assert [tuple(r) for r in report.collect()] == [
        ("whole", "k", 0.0, True),
        ("whole", "n", 0.0, True),
        ("holes", "k", 0.5, False),
        ("empty", "k", None, False),
    ]


def test_gate(tables):
    gate(tables, {"whole": ["k", "n"]})
    gate(tables, {"holes": ["k"]}, expected=0.5)
    with pytest.raises(ValueError, match="holes.k: 0.5"):
        gate(tables, {"whole": ["k"], "holes": ["k"]})
    with pytest.raises(ValueError, match="empty.k: None"):
        gate(tables, {"empty": ["k"]})
    with pytest.raises(KeyError):
        gate(tables, {"other": ["k"]})


def test_key_reports(spark):
    df = spark.createDataFrame([("k1", "a", 1), ("k1", "b", 1), ("k2", "a", 2), ("k2", "a", 2)], "k string, n string, v int")
    assert rows(repeated_keys(df, ["k", "n"])) == [("k2", "a", 2)]
    assert rows(key_collisions(df, "k", ["n", "v"])) == [("k1", 2)]
    assert rows(fanout_report(df, ["k", "n"])) == [(3, 1, 2)]
    dim = spark.createDataFrame([("k1",)], "id string")
    assert rows(orphan_keys(df, "k", dim, "id")) == [("k2", 2)]
