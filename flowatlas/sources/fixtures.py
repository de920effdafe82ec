"""Displacement-schema views derived from the driver's star-schema tables.

Every view is one SQL text. Spark runs it through ``spark.sql`` with the
driver tables passed in as DataFrame parameters (``{lineitem}``); the DuckDB
oracle runs the very same text as a CTE over its pre-registered views. One
definition, two engines, so an oracle mismatch always points at an operator
and never at the fixture.

Mapping (see FIXTURES.md): a line item is one stock cell. The year is the
ship year, the population type comes from the return flag / line status,
the origin is the supplier's nation, the host the customer's nation.
Nations are turned into "entities" whose mapping status and ISO code are
chosen so that every predicate of the entity-cleaning rule selects rows.

All SQL here must stay portable between Spark SQL and DuckDB: no ``//`` or
``div``, ``floor(x/5)`` instead; ``||`` for concatenation; ``varchar(4)``
casts; CASE for month names.
"""

from __future__ import annotations

import re

from flowatlas.schemas import (
    CRISIS_EVENTS, CRISIS_ORIGIN, POP_ASYLUM, POP_IDPS, POP_OTHERS, POP_REFUGEES, SCOPES,
)

# English month names in calendar order.
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]


def _month_case(expr: str) -> str:
    arms = " ".join(f"WHEN {i} THEN '{m}'" for i, m in enumerate(MONTH_NAMES, start=1))
    return f"CASE {expr} {arms} END"


# name -> (sql, dependencies). Table references in braces are driver tables
# (Spark: DataFrame parameters; DuckDB: plain view names); bare names refer to
# other fixture views and become CTE references.
VIEWS: dict[str, tuple[str, tuple[str, ...]]] = {}


def _view(name: str, deps: tuple[str, ...], sql: str) -> None:
    VIEWS[name] = (sql.strip(), deps)


_view("entity", (), """
SELECT n_nationkey AS k,
       n_name AS country_std,
       CASE WHEN n_nationkey <= 20 THEN 'N' || lpad(cast(n_nationkey AS varchar(4)), 2, '0')
            WHEN n_nationkey = 21 THEN NULL
            WHEN n_nationkey IN (22, 23) THEN 'X_' || cast(n_nationkey AS varchar(4))
            ELSE 'UNMAPPED' END AS iso3,
       CASE WHEN n_nationkey < 20 AND n_nationkey % 2 = 0 THEN 'manual_iso'
            WHEN n_nationkey < 20 THEN 'pycountry_exact_or_alias'
            WHEN n_nationkey = 20 THEN NULL
            WHEN n_nationkey = 21 THEN 'pycountry_exact_or_alias'
            WHEN n_nationkey = 22 THEN 'historical_or_composite'
            WHEN n_nationkey = 23 THEN 'special_entity'
            ELSE 'unmapped' END AS mapping_status,
       n_nationkey <= 20 AS map_eligible_flag
FROM {nation}
""")

# Centroids only for entities 0-19; 20-24 have none (dropped by inner joins).
_view("centroid", ("entity",), """
SELECT country_std,
       cast((k % 5) * 6.0 AS double) AS lat,
       cast(floor(k / 5) * 25.0 AS double) AS lon
FROM entity
WHERE k < 20
""")

# One line item = one stock cell, with the keys the other fixtures need.
# Join order: orders meet customers first (the smaller pair), so the line
# items are shuffled once by order key against (order key, host nation)
# pairs only; the supplier side is a nation lookup by supplier key.
_view("stock_base", (), """
SELECT l.l_orderkey, l.l_linenumber, l.l_partkey, l.l_suppkey, l.l_quantity,
       l.l_returnflag, l.l_linestatus,
       cast(extract(year FROM l.l_shipdate) AS int) AS year,
       s.s_nationkey AS origin_k,
       oc.c_nationkey AS host_k
FROM {lineitem} l
JOIN (SELECT o.o_orderkey, c.c_nationkey
      FROM {orders} o JOIN {customer} c ON o.o_custkey = c.c_custkey) oc
  ON l.l_orderkey = oc.o_orderkey
JOIN {supplier} s ON l.l_suppkey = s.s_suppkey
""")

_view("stock", ("stock_base", "entity"), f"""
SELECT b.year,
       CASE WHEN b.l_returnflag = 'R' THEN '{POP_REFUGEES}'
            WHEN b.l_returnflag = 'A' THEN '{POP_ASYLUM}'
            WHEN b.l_returnflag = 'N' AND b.l_linestatus = 'O' THEN '{POP_IDPS}'
            ELSE '{POP_OTHERS}' END AS population_type_std,
       CASE WHEN b.l_orderkey % 50 = 0 THEN NULL
            WHEN b.l_orderkey % 41 = 0 THEN cast(0 AS double)
            ELSE b.l_quantity END AS value_observed,
       eo.country_std AS origin_country_std, eo.iso3 AS origin_iso3,
       eo.mapping_status AS origin_mapping_status, eo.map_eligible_flag AS origin_map_eligible_flag,
       eh.country_std AS host_country_std, eh.iso3 AS host_iso3,
       eh.mapping_status AS host_mapping_status, eh.map_eligible_flag AS host_map_eligible_flag,
       false AS value_is_blank,
       b.l_orderkey % 50 = 0 AS value_is_redacted,
       (b.l_orderkey % 50 <> 0 AND b.l_orderkey % 41 = 0) AS value_is_zero,
       false AS value_is_negative_raw,
       b.l_orderkey AS source_key, b.l_linenumber AS source_line
FROM stock_base b
JOIN entity eo ON b.origin_k = eo.k
JOIN entity eh ON b.host_k = eh.k
""")

# Crisis dimension and its events, generated from the fixed values in schemas.
_CRISIS_ROWS = ",\n  ".join(
    f"('{c}', '{o}', {i})" for i, (c, o) in enumerate(CRISIS_ORIGIN.items(), start=1))
_view("crisis", (), f"""
SELECT * FROM (VALUES
  {_CRISIS_ROWS}
) AS t(crisis, origin_country_std, crisis_order)
""")

_EVENT_ROWS = ",\n  ".join(
    f"('{c}', {y}, '{e}')" for c, evs in CRISIS_EVENTS.items() for y, e in evs)
_view("crisis_events", (), f"""
SELECT * FROM (VALUES
  {_EVENT_ROWS}
) AS t(crisis, year, event)
""")

# Scope dimension: scope name -> member population types (from schemas.SCOPES).
_SCOPE_ROWS = ",\n  ".join(f"('{s}', '{t}')" for s, ts in SCOPES.items() for t in ts)
_view("scope", (), f"""
SELECT * FROM (VALUES
  {_SCOPE_ROWS}
) AS t(scope, population_type_std)
""")

# Host-country denominators per (iso3, year) present in the data (one row
# per host and year, from an equi-join); missing when k % 5 = 4.
_view("population", ("entity", "stock_base"), """
SELECT e.iso3, y.year,
       CASE WHEN e.k % 5 = 4 THEN NULL ELSE cast(100000 * (e.k + 1) AS double) END AS population_total,
       CASE WHEN e.k % 5 = 4 THEN NULL ELSE cast(1000 * (e.k + 3) AS double) END AS gdp_per_capita,
       CASE WHEN e.k % 5 = 4 THEN NULL WHEN e.k < 10 THEN 'Low income' ELSE 'High income' END AS income_group
FROM (SELECT DISTINCT host_k, year FROM stock_base) y
JOIN entity e ON e.k = y.host_k
WHERE e.iso3 IS NOT NULL
""")

# Raw stock table: all strings, as a CSV export of the source would carry them.
_view("raw_stock", ("stock_base", "entity"), """
SELECT cast(b.year AS varchar(4)) AS year_raw,
       CASE WHEN b.l_orderkey % 3 = 0 THEN ' ' || lower(eo.country_std) ELSE eo.country_std END AS origin_raw,
       eh.country_std AS host_raw,
       CASE WHEN b.l_returnflag = 'R' THEN 'Refugees (incl. refugee-like situations)'
            WHEN b.l_returnflag = 'A' THEN 'Asylum-seekers (pending cases)'
            WHEN b.l_returnflag = 'N' AND b.l_linestatus = 'O' THEN 'Internally displaced persons'
            ELSE 'Others of concern' END AS population_type_raw,
       CASE WHEN b.l_orderkey % 50 = 0 THEN '*'
            WHEN b.l_orderkey % 89 = 0 THEN ''
            WHEN b.l_orderkey % 101 = 0 THEN '-5'
            WHEN b.l_orderkey % 103 = 0 THEN 'n/a'
            WHEN b.l_orderkey % 41 = 0 THEN '0'
            ELSE cast(cast(b.l_quantity AS bigint) AS varchar(12)) END AS value_raw,
       CASE WHEN b.l_orderkey % 11 = 0 THEN 'G / NA'
            WHEN b.l_orderkey % 2 = 0 THEN 'G / FI'
            ELSE 'U / AR' END AS procedure_raw,
       b.l_orderkey AS source_key, b.l_linenumber AS source_line
FROM stock_base b
JOIN entity eo ON b.origin_k = eo.k
JOIN entity eh ON b.host_k = eh.k
""")

# Country map: normalised raw label -> standard entity. Entity 24 is left out
# on purpose so that its label reaches the unmapped audit.
_view("country_map", ("entity",), """
SELECT upper(country_std) AS label_key, country_std, iso3, mapping_status, map_eligible_flag
FROM entity
WHERE k <> 24
""")

# Population-type map (fixed values): raw label -> standard label.
_view("population_type_map", (), """
SELECT * FROM (VALUES
  ('Refugees (incl. refugee-like situations)', 'Refugees'),
  ('Asylum-seekers (pending cases)', 'Asylum-seekers'),
  ('Returned refugees', 'Returned refugees'),
  ('Internally displaced persons', 'IDPs'),
  ('Returned IDPs', 'Returned IDPs'),
  ('Stateless persons', 'Stateless persons'),
  ('Others of concern', 'Others of concern')
) AS t(population_type_raw, population_type_std)
""")

# Monthly asylum applications: one order = one monthly cell, host = customer nation.
_view("apps_monthly", ("entity",), f"""
SELECT cast(extract(year FROM o.o_orderdate) AS int) AS year,
       {_month_case("cast(extract(month FROM o.o_orderdate) AS int)")} AS month,
       eh.country_std AS host_country_std,
       cast(floor(o.o_totalprice / 1000) AS double) AS applications_monthly_observed
FROM {{orders}} o
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN entity eh ON c.c_nationkey = eh.k
""")

# Asylum applications and decisions, one per stock cell.
_view("decisions", ("stock_base", "entity"), """
SELECT b.year,
       eo.country_std AS origin_country_std, eo.iso3 AS origin_iso3,
       eh.country_std AS host_country_std, eh.iso3 AS host_iso3,
       b.l_quantity AS applications_observed,
       CASE WHEN b.l_orderkey % 4 = 0 THEN b.l_quantity ELSE 0.0 END AS recognized_observed,
       CASE WHEN b.l_orderkey % 4 = 1 THEN b.l_quantity ELSE 0.0 END AS rejected_observed,
       CASE WHEN b.l_orderkey % 4 = 2 THEN b.l_quantity ELSE 0.0 END AS other_decisions_observed,
       CASE WHEN b.l_orderkey % 4 = 3 THEN b.l_quantity ELSE 0.0 END AS otherwise_closed_observed,
       CASE WHEN b.l_orderkey % 7 = 0 THEN NULL
            WHEN b.l_orderkey % 997 = 0 THEN b.l_quantity + 1
            ELSE b.l_quantity END AS total_decisions_reported,
       CASE WHEN b.l_orderkey % 11 = 0 THEN 'G / NA'
            WHEN b.l_orderkey % 2 = 0 THEN 'G / FI'
            ELSE 'U / AR' END AS procedure_raw,
       b.l_linenumber AS source_line
FROM stock_base b
JOIN entity eo ON b.origin_k = eo.k
JOIN entity eh ON b.host_k = eh.k
""")

# Resettlement flows at the reference's grain: one row per (year, origin,
# host), summed over every line item of the corridor; the first line of an
# order counts as a resettled person-group, the others as none.
_view("resettlement", ("stock_base", "entity"), """
SELECT b.year,
       eo.country_std AS origin_country_std, eo.iso3 AS origin_iso3,
       eh.country_std AS host_country_std, eh.iso3 AS host_iso3,
       sum(CASE WHEN b.l_linenumber = 1 THEN b.l_quantity ELSE 0 END) AS resettlement_observed
FROM stock_base b
JOIN entity eo ON b.origin_k = eo.k
JOIN entity eh ON b.host_k = eh.k
GROUP BY b.year, eo.country_std, eo.iso3, eh.country_std, eh.iso3
""")

# Persons of concern, wide: the stock pivoted by population type.
_view("poc_wide", ("stock",), f"""
SELECT year, origin_country_std, host_country_std,
       sum(CASE WHEN population_type_std = '{POP_REFUGEES}' THEN value_observed END) AS refugees,
       sum(CASE WHEN population_type_std = '{POP_ASYLUM}' THEN value_observed END) AS asylum_seekers,
       sum(CASE WHEN population_type_std = 'Returned refugees' THEN value_observed END) AS returned_refugees,
       sum(CASE WHEN population_type_std = '{POP_IDPS}' THEN value_observed END) AS idps,
       sum(CASE WHEN population_type_std = 'Returned IDPs' THEN value_observed END) AS returned_idps,
       sum(CASE WHEN population_type_std = 'Stateless persons' THEN value_observed END) AS stateless,
       sum(CASE WHEN population_type_std = '{POP_OTHERS}' THEN value_observed END) AS others_of_concern
FROM stock
GROUP BY year, origin_country_std, host_country_std
""")

# Demographics, wide: per (year, host) sums into 16 age x sex columns.
# Age bucket from l_partkey % 5, sex from l_suppkey % 2; school-age items of
# orders with l_orderkey % 13 = 0 are reported only as the combined 5-17 group.
def _demo_col(sex_val: int, cond: str) -> str:
    return (f"sum(CASE WHEN b.l_suppkey % 2 = {sex_val} AND {cond} "
            f"THEN b.l_quantity END)")


_SCHOOL_SPLIT = "b.l_orderkey % 13 <> 0"
_DEMO_COLS = []
for _sex, _sv in (("female", 0), ("male", 1)):
    _DEMO_COLS += [
        f"{_demo_col(_sv, 'b.l_partkey % 5 = 0')} AS {_sex}_0_4",
        f"{_demo_col(_sv, f'b.l_partkey % 5 = 1 AND {_SCHOOL_SPLIT}')} AS {_sex}_5_11",
        f"{_demo_col(_sv, 'b.l_partkey % 5 IN (1, 2) AND b.l_orderkey % 13 = 0')} AS {_sex}_5_17",
        f"{_demo_col(_sv, f'b.l_partkey % 5 = 2 AND {_SCHOOL_SPLIT}')} AS {_sex}_12_17",
        f"{_demo_col(_sv, 'b.l_partkey % 5 = 3')} AS {_sex}_18_59",
        f"{_demo_col(_sv, 'b.l_partkey % 5 = 4')} AS {_sex}_60",
        f"{_demo_col(_sv, 'b.l_linenumber = 7')} AS {_sex}_unknown",
        f"{_demo_col(_sv, 'true')} AS {_sex}_total",
    ]

_view("demographics_wide", ("stock_base", "entity"), f"""
SELECT b.year, eh.country_std AS host_country_std,
       {", ".join(_DEMO_COLS)}
FROM stock_base b
JOIN entity eh ON b.host_k = eh.k
GROUP BY b.year, eh.country_std
""")

# The other raw tables, all strings. A cell's number picks its defect: redacted,
# blank (empty or spaces), negative, or text; null measures are blank cells.
def _raw_cell(value: str, pick: str) -> str:
    whole = f"cast({value} AS bigint)"
    return (f"CASE WHEN {value} IS NULL THEN '' WHEN ({pick}) % 37 = 0 THEN '*' WHEN ({pick}) % 41 = 0 THEN '  ' "
            f"WHEN ({pick}) % 43 = 0 THEN '-3' WHEN ({pick}) % 47 = 0 THEN 'n/a' "
            f"WHEN ({pick}) % 53 = 0 THEN ' ' || cast({whole} AS varchar(20)) || ' ' ELSE cast({whole} AS varchar(20)) END")


def _raw_cells(columns: list[str], pick: str) -> str:
    return ",\n       ".join(f"{_raw_cell(c, f'{pick} + {7 * i}')} AS {c}_raw" for i, c in enumerate(columns))


_YEAR_RAW = "cast(year AS varchar(4)) AS year_raw"
DECISION_PARTS = ["applications", "recognized", "rejected", "other_decisions", "otherwise_closed"]
_view("raw_decisions", ("stock_base", "entity"), f"""
SELECT {_YEAR_RAW}, origin_country_std AS origin_raw, host_country_std AS host_raw, procedure_raw,
       {_raw_cells([*DECISION_PARTS, "total_decisions"], "source_key")},
       source_key, source_line
FROM (SELECT b.year, eo.country_std AS origin_country_std, eh.country_std AS host_country_std,
             CASE WHEN b.l_orderkey % 11 = 0 THEN 'G / NA' WHEN b.l_orderkey % 2 = 0 THEN 'G / FI' ELSE 'U / AR' END AS procedure_raw,
             b.l_quantity AS applications,
             CASE WHEN b.l_orderkey % 4 = 0 THEN b.l_quantity ELSE 0.0 END AS recognized,
             CASE WHEN b.l_orderkey % 4 = 1 THEN b.l_quantity ELSE 0.0 END AS rejected,
             CASE WHEN b.l_orderkey % 4 = 2 THEN b.l_quantity ELSE 0.0 END AS other_decisions,
             CASE WHEN b.l_orderkey % 4 = 3 THEN b.l_quantity ELSE 0.0 END AS otherwise_closed,
             CASE WHEN b.l_orderkey % 7 = 0 THEN NULL ELSE b.l_quantity END AS total_decisions,
             b.l_orderkey AS source_key, b.l_linenumber AS source_line
      FROM stock_base b JOIN entity eo ON b.origin_k = eo.k JOIN entity eh ON b.host_k = eh.k) d
""")

_view("raw_apps_monthly", ("entity",), f"""
SELECT cast(extract(year FROM o.o_orderdate) AS varchar(4)) AS year_raw,
       {_month_case("cast(extract(month FROM o.o_orderdate) AS int)")} AS month_raw,
       CASE WHEN o.o_orderkey % 5 = 0 THEN lower(eh.country_std) || ' ' ELSE eh.country_std END AS host_raw,
       {_raw_cell("floor(o.o_totalprice / 1000)", "o.o_orderkey")} AS value_raw,
       o.o_orderkey AS source_key
FROM {{orders}} o
JOIN {{customer}} c ON o.o_custkey = c.c_custkey
JOIN entity eh ON c.c_nationkey = eh.k
""")

_view("raw_resettlement", ("resettlement",), f"""
SELECT {_YEAR_RAW}, origin_country_std AS origin_raw, host_country_std AS host_raw,
       {_raw_cell("resettlement_observed", "cast(resettlement_observed AS bigint) + year")} AS value_raw
FROM resettlement
""")

POC_COLUMNS = ["refugees", "asylum_seekers", "returned_refugees", "idps", "returned_idps", "stateless", "others_of_concern"]
_view("raw_poc", ("poc_wide",), f"""
SELECT {_YEAR_RAW}, origin_country_std AS origin_raw, host_country_std AS host_raw,
       {_raw_cells(POC_COLUMNS, "coalesce(cast(refugees AS bigint), 1) + year")}
FROM poc_wide
""")

DEMOGRAPHIC_COLUMNS = [f"{s}_{a}" for s in ("female", "male") for a in ("0_4", "5_11", "5_17", "12_17", "18_59", "60", "unknown", "total")]
_view("raw_demographics", ("demographics_wide",), f"""
SELECT {_YEAR_RAW}, CASE WHEN year % 2 = 0 THEN ' ' || host_country_std ELSE host_country_std END AS host_raw,
       {_raw_cells(DEMOGRAPHIC_COLUMNS, "coalesce(cast(female_total AS bigint), 1) + year")}
FROM demographics_wide
""")

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")
#: the columns that the views read
USED_COLUMNS = {
    "nation": ["n_nationkey", "n_name"], "customer": ["c_custkey", "c_nationkey"], "supplier": ["s_suppkey", "s_nationkey"],
    "orders": ["o_orderkey", "o_custkey", "o_orderdate", "o_totalprice"],
    "lineitem": ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_returnflag", "l_linestatus", "l_shipdate"],
}
_DRIVER_REF = re.compile(r"\{(" + "|".join(DRIVER_TABLES) + r")\}")


def _closure(names) -> list[str]:
    """Fixture views needed by ``names`` in dependency order."""
    order: list[str] = []

    def visit(n: str) -> None:
        if n in order:
            return
        for d in VIEWS[n][1]:
            visit(d)
        order.append(n)

    for n in names:
        visit(n)
    return order


def oracle_ctes(*names: str) -> str:
    """``WITH a AS (...), b AS (...)`` prefix for DuckDB over plain table names."""
    parts = []
    for n in _closure(names):
        sql = _DRIVER_REF.sub(lambda m: m.group(1), VIEWS[n][0])
        parts.append(f"{n} AS (\n{sql}\n)")
    return "WITH " + ",\n".join(parts)


def oracle(body: str, *names: str) -> str:
    """Oracle SQL: fixture CTEs, then ``body``. A body starting with ','
    continues the CTE list with its own CTEs."""
    body = body.strip()
    if not names:
        return body
    head = oracle_ctes(*names)
    return head + ("\n" if body.startswith(",") else "\n") + body


def spark_view(spark, tables: dict, name: str):
    """Build fixture view ``name`` as a DataFrame; ``tables`` maps driver
    table names to DataFrames and is extended with built views (memo)."""
    if name in tables:
        return tables[name]
    deps = {d: spark_view(spark, tables, d) for d in VIEWS[name][1]}
    sql = VIEWS[name][0]
    # fixture-view references are bare names: rewrite them to parameters
    for d in deps:
        sql = re.sub(rf"(?<![\w.{{]){d}(?![\w}}(])", "{" + d + "}", sql)
    params = {t: tables[t] for t in DRIVER_TABLES if "{" + t + "}" in sql}
    params.update(deps)
    df = spark.sql(sql, **params)
    tables[name] = df
    return df
