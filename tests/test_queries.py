"""Every registered query runs at sf0.001 with a stable schema, and matches
its DuckDB oracle (row count, column names, order-free value hash)."""

import os
import sys

import duckdb
import pytest

from conftest import SF_SMALL

sys.path.insert(0, os.path.join(os.path.dirname(os.path.dirname(os.path.abspath(__file__))), "tools"))

import __spark_entry__ as E  # noqa: E402
from check_oracles import digest  # noqa: E402
from quarry.sources.tables import TABLE_NAMES  # noqa: E402

NAMES = sorted(E.queries())


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLE_NAMES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "field_name" in df.columns


@pytest.mark.parametrize("name", NAMES)
def test_query_against_oracle(spark, con, name):
    df = E.queries()[name](spark, SF_SMALL)
    cols = df.columns
    rows = [tuple(r) for r in df.collect()]
    assert len(cols) == len(set(cols))
    oracle = E.oracle_sql().get(name)
    if oracle is None:
        assert rows is not None
        return
    cur = con.execute(oracle)
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(cols) == sorted(dcols)
    assert len(rows) == len(drows)
    assert digest(cols, rows)[0] == digest(dcols, drows)[0]
