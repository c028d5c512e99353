"""Every registered query against its DuckDB oracle on the smallest tables
(the driver repeats this at sf0.01)."""
import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from barkeep.plans.registry import QUERIES  # noqa: E402
from oracle_check import TABLES, _rows, type_mismatches  # noqa: E402

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = os.path.join(SF, "%s.parquet" % t)
        if os.path.exists(p):
            c.execute("CREATE VIEW %s AS SELECT * FROM read_parquet('%s')" % (t, p))
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries()) and set(QUERIES) <= set(E.oracle_sql())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["symbol", "date", "ts", "o", "h", "l", "c", "v", "minutes"]
    assert df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    srows = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    dcols = [d[0] for d in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert type_mismatches(df.schema, dcols, [d[1] for d in cur.description]) == {}
    assert _rows(df.columns, srows) == _rows(dcols, cur.fetchall())
