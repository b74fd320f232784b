"""The registered queries: SQL where there is any, one row per input row elsewhere."""

from __future__ import annotations

import duckdb
import pytest

from starweave.llm.queries import LLM_ORACLES, LLM_QUERIES

SF = "/root/testdata/sf0.001"
TABLE = {"op2_warc": "pages", "op5_main_text": "pages", "op13_whitening": "embeddings"}
KEY = {"pages": "page_id", "embeddings": "vec_id"}
#: Rows for each row of the table.
ROWS = {"op13_whitening": 8}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "pages", "embeddings", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS FROM read_parquet('{SF}/{name}.parquet')")
    return connection


@pytest.mark.parametrize("name", LLM_ORACLES)
def test_query_matches_sql(spark, duck, name):
    ours = LLM_QUERIES[name](spark, SF).toPandas()
    theirs = duck.execute(LLM_ORACLES[name]).df()
    columns = sorted(ours.columns)
    left = ours[columns].sort_values(columns, ignore_index=True)
    right = theirs[columns].sort_values(columns, ignore_index=True)
    assert len(left) == len(right) > 0
    for c in columns:
        assert ((left[c] == right[c]) | (left[c].isna() & right[c].isna())).all(), c


@pytest.mark.parametrize("name", [n for n in LLM_QUERIES if n not in LLM_ORACLES])
def test_query_covers_its_table(spark, duck, name):
    source = TABLE.get(name, "documents")
    key = KEY.get(source, "doc_id")
    want = {r[0] for r in duck.execute(f"SELECT {key} FROM {source}").fetchall()}
    got = [r[key] for r in LLM_QUERIES[name](spark, SF).select(key).collect()]
    assert set(got) == want
    assert name == "op7_packing" or len(got) == ROWS.get(name, 1) * duck.execute(f"SELECT count(*) FROM {source}").fetchone()[0]
