"""Every registered query equals its DuckDB oracle (row count, column names, value hash) at sf0.001."""

import os
import sys

import duckdb
import pytest

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "scripts"))

import __spark_entry__ as E  # noqa: E402
from check_oracle import digest  # noqa: E402
from cinelens.sources.tables import TABLES  # noqa: E402

SF = "/root/testdata/sf0.001"
QUERIES = E.queries()
ORACLE = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = QUERIES[name](spark, SF)
    rows = [tuple(r) for r in df.collect()]
    if name not in ORACLE:
        assert df.columns and isinstance(rows, list)
        return
    res = con.execute(ORACLE[name])
    ocols = [d[0] for d in res.description]
    orows = res.fetchall()
    assert sorted(df.columns) == sorted(ocols)
    assert len(rows) == len(orows)
    assert digest(df.columns, rows) == digest(ocols, orows)
