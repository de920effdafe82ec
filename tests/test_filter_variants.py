"""The selection parameters beyond the defaults: explicit years, every
scope, crisis and origin/host filters - Spark against DuckDB on the
smallest data."""

import os

import duckdb
import pytest

from conftest import SF_SMALL
from flowatlas.operators import select as sel
from flowatlas.operators import stock as st
from flowatlas.plans.common import clean_sql, sql_list
from flowatlas.schemas import SCOPES, Filters, crisis_origin
from flowatlas.sources import fixtures
from flowatlas.sources.catalog import catalog
from tools.oracle_check import TABLES, _rows

VARIANTS = [
    Filters(year=1996),
    Filters(year=2000, scope="Refugees"),
    Filters(scope="Active forced incl. IDPs"),
    Filters(scope="No such scope"),
    Filters(year=None, crisis="Crisis 3"),
    Filters(year=1998, crisis="Crisis 2", origin="NATION_4"),
    Filters(year=None, host="NATION_7", top_n=5),
]


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        p = f"{SF_SMALL}/{t}.parquet"
        if os.path.exists(p):
            c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return c


def where(f: Filters) -> str:
    parts = [f"population_type_std IN {sql_list(SCOPES.get(f.scope, SCOPES['All cross-border']))}"]
    if f.year == "latest":
        parts.append("year = (SELECT max(year) FROM stock)")
    elif f.year is not None:
        parts.append(f"year = {int(f.year)}")
    origin = f.origin if f.origin != "All" else crisis_origin(f.crisis)
    if origin:
        parts.append(f"origin_country_std = '{origin}'")
    if f.host != "All":
        parts.append(f"host_country_std = '{f.host}'")
    return " AND ".join(parts)


def check(spark, con, sdf, sql):
    srows = [tuple(r) for r in sdf.collect()]
    cur = con.execute(fixtures.oracle(sql, "stock"))
    dcols = [d[0] for d in cur.description]
    drows = cur.fetchall()
    assert sorted(sdf.columns) == sorted(dcols)
    assert _rows(sdf.columns, srows, False) == _rows(dcols, drows, False)


@pytest.mark.parametrize("f", VARIANTS, ids=str)
def test_rank_hosts_variant(spark, con, f):
    d = sel.filter_selection(catalog(spark, SF_SMALL).stock(), f)
    sql = f"""
, d AS (SELECT * FROM stock WHERE {where(f)} AND {clean_sql('host')})
, g AS (SELECT host_country_std, host_iso3, coalesce(sum(value_observed), 0) AS value_observed FROM d
        WHERE host_country_std IS NOT NULL GROUP BY 1, 2 HAVING coalesce(sum(value_observed), 0) > 0)
SELECT host_country_std, host_iso3, value_observed,
       cast(row_number() OVER (ORDER BY value_observed DESC, host_country_std, host_iso3) AS int) AS rank,
       CASE WHEN (SELECT sum(value_observed) FROM d) > 0
            THEN value_observed / (SELECT sum(value_observed) FROM d) END AS share
FROM g ORDER BY value_observed DESC, host_country_std, host_iso3 LIMIT {f.top_n}
"""
    check(spark, con, st.rank_entities(d, "host", f.top_n), sql)


@pytest.mark.parametrize("f", VARIANTS, ids=str)
def test_kpis_variant(spark, con, f):
    scope = SCOPES.get(f.scope, SCOPES["All cross-border"])
    active = sorted(set(scope) | set(SCOPES["Active forced incl. IDPs"]))
    base = where(f).replace(f"population_type_std IN {sql_list(scope)}", f"population_type_std IN {sql_list(active)}")
    sql = f"""
, a AS (SELECT * FROM stock WHERE {base})
, s AS (SELECT * FROM a WHERE population_type_std IN {sql_list(scope)})
SELECT coalesce((SELECT sum(value_observed) FROM s), 0) AS total,
       coalesce((SELECT sum(value_observed) FROM s WHERE population_type_std = 'Refugees'), 0) AS refugees,
       coalesce((SELECT sum(value_observed) FROM s WHERE population_type_std = 'Asylum-seekers'), 0) AS asylum,
       coalesce((SELECT sum(value_observed) FROM a WHERE population_type_std = 'IDPs'), 0) AS idps,
       (SELECT count(DISTINCT c) FROM (SELECT origin_country_std AS c FROM s
                                       UNION ALL SELECT host_country_std FROM s) u) AS countries
"""
    check(spark, con, st.kpis(catalog(spark, SF_SMALL).stock(), f), sql)


@pytest.mark.parametrize("f", VARIANTS, ids=str)
def test_corridors_variant(spark, con, f):
    d = sel.filter_selection(catalog(spark, SF_SMALL).stock(), f)
    sql = f"""
, d AS (SELECT * FROM stock WHERE {where(f)} AND {clean_sql('origin')} AND {clean_sql('host')})
SELECT origin_country_std, host_country_std, population_type_std,
       coalesce(sum(value_observed), 0) AS value_observed
FROM d WHERE origin_country_std IS NOT NULL AND host_country_std IS NOT NULL
GROUP BY 1, 2, 3 HAVING coalesce(sum(value_observed), 0) > 0
ORDER BY value_observed DESC, 1, 2, 3 LIMIT {f.top_n}
"""
    check(spark, con, st.corridors(d, f.top_n), sql)
