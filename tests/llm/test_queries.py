"""The text queries that SQL can express, against DuckDB on the smallest tables."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(__file__), "..", "..", "scripts"))

import __spark_entry__ as E  # noqa: E402
from barkeep.llm.registry import ORACLES, QUERIES  # noqa: E402
from oracle_check import _rows, type_mismatches  # noqa: E402

SF = "/root/testdata/sf0.001"


def test_all_are_registered():
    assert {*QUERIES, "pipeline"} <= set(E.queries()) and set(ORACLES) <= set(E.oracle_sql())
    assert sorted(int(q[2:].split("_")[0]) for q in QUERIES) == list(range(1, 14))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "conversations", "embeddings"):
        con.execute("CREATE VIEW %s AS SELECT * FROM read_parquet('%s/%s.parquet')" % (t, SF, t))
    df = QUERIES[name](spark, SF)
    cur = con.execute(ORACLES[name])
    cols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(cols)
    assert type_mismatches(df.schema, cols, [d[1] for d in cur.description]) == {}
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(cols, cur.fetchall())
