"""Radix partitioning against grouping by the text itself."""

from __future__ import annotations

import random
from collections import defaultdict

from starweave.llm import exact


def found(df):
    return sorted(
        ((r["_carry"]["doc_id"], r["keep_id"], r["group_size"], r["kept"]) for r in df.collect()), key=repr
    )


def expected(rows):
    groups = defaultdict(list)
    for k, (i, t) in enumerate(rows):
        groups[t or ""].append((-1 if i is None else i, k, i))
    out = []
    for members in groups.values():
        best = max(members)
        out += [(m[2], best[2], len(members), m == best) for m in members]
    return out


def test_shared_prefixes_ends_and_copies(docs, monkeypatch):
    monkeypatch.setattr(exact, "FIRST_BYTES", 4)
    monkeypatch.setattr(exact, "GROWTH", 2)
    rng = random.Random(1)
    base = ["", "a", "abcd", "abcde", "é" * 50, "é" * 49 + "e", "x" * 5000, "x" * 5001, "abcd" * 3, "\0\0"]
    rows = [(i, rng.choice(base)) for i in range(200)] + [(None, None), (None, ""), (7, "zz"), (7, "zz")]
    df = exact.exact_duplicates(docs(*rows))
    got, want = found(df), expected(rows)
    # Of rows equal in everything either may stay.
    assert sorted(got, key=repr) == sorted(want, key=repr)


def test_keeps_texts_and_carries_clashing_names(spark):
    names = "doc_id long, text string, `row` string, `group` string, `_digit` int"
    rows = [(1, "same", "r", "g", 1), (2, "same", None, "h", 2), (3, None, "r", "g", 3)]
    df = spark.createDataFrame(rows, names)
    out = exact.exact_duplicates(df, carry=["row", "group", "_digit"], keep_text=True).collect()
    assert {(r["_carry"]["doc_id"], r["_text"], r["_carry"]["group"], r["kept"]) for r in out} == {
        (1, "same", "g", False), (2, "same", "h", True), (3, "", "g", True),
    }


def test_empty_table(docs):
    assert exact.exact_duplicates(docs()).count() == 0
