"""Every registered query against its DuckDB oracle on the smallest data;
rows-only keys must run and return rows."""

import os

import duckdb
import pytest

from conftest import SF_SMALL
from tools.oracle_check import TABLES, _rows

import __spark_entry__ as E

QUERIES = E.queries()
ORACLES = E.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)
    assert len(ORACLES) >= 85


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert df.columns == ["host_country_std", "host_iso3", "value_observed", "rank", "share"]
    assert [r["rank"] for r in rows] == list(range(1, len(rows) + 1))


@pytest.mark.parametrize("key", sorted(ORACLES))
def test_oracle(spark, con, key):
    sdf = QUERIES[key](spark, SF_SMALL)
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(ORACLES[key])
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert len(srows) == len(drows)
    assert _rows(sdf.columns, srows, True) == _rows(dcols, drows, True)


@pytest.mark.parametrize("key", sorted(set(QUERIES) - set(ORACLES)))
def test_rows_only(spark, key):
    rows = QUERIES[key](spark, SF_SMALL).collect()
    assert len(rows) > 0
