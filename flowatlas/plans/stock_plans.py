"""Registered selection (§2.4) and stock (§2.5) queries with their oracles.

Parameters are the reference defaults: latest year, cross-border scope,
no crisis / origin / host filter, top 12.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowatlas.operators import select as sel
from flowatlas.operators import stock as st
from flowatlas.operators.cube import row_count
from flowatlas.plans.common import ACTIVE, CB, LATEST_YEAR, clean_sql, register, views
from flowatlas.schemas import Filters, crisis_focus_origin

F0 = Filters()
V = "value_observed"
FOCUS = crisis_focus_origin(F0.crisis)  # default crisis origin
SEL = f"year = {LATEST_YEAR} AND population_type_std IN {CB}"


def _stock(spark, sf):
    """The cell table (for queries that count or return cells)."""
    return views(spark, sf).stock()


def _cube(spark, sf):
    """The stock cube (for queries that only sum): exact, and bounded by
    countries^2 x years x types rows whatever the cell count."""
    return views(spark, sf).cube()


# ============================================================ §2.4 selection
@register("scope_types", f"""
SELECT s.scope, s.population_type_std, count(*) AS rows
FROM stock t JOIN scope s ON s.population_type_std = t.population_type_std
GROUP BY s.scope, s.population_type_std
""", views=("stock", "scope"))
def q_scope_types(spark, sf):
    cat = views(spark, sf)
    cube = cat.cube()
    per_type = cube.groupBy("population_type_std").agg(row_count(cube).alias("rows"))
    return (cat.view("scope").join(per_type, "population_type_std")
            .select("scope", "population_type_std", "rows"))


@register("filter_selection", f"""
SELECT year, population_type_std, origin_country_std, host_country_std, value_observed,
       source_key, source_line
FROM stock WHERE population_type_std IN {CB} AND origin_country_std = 'NATION_3'
""")
def q_filter_selection(spark, sf):
    f = F0.with_(year=None, crisis="Crisis 2", origin="NATION_3")  # origin beats crisis
    return sel.filter_selection(_stock(spark, sf), f).select(
        "year", "population_type_std", "origin_country_std", "host_country_std", V,
        "source_key", "source_line")


@register("crisis_origin", f"""
, s AS (SELECT origin_country_std, coalesce(sum(value_observed), 0) AS v FROM stock
        WHERE {SEL} GROUP BY origin_country_std)
SELECT c.crisis, c.origin_country_std, coalesce(s.v, 0) AS value_observed
FROM crisis c LEFT JOIN s ON s.origin_country_std = c.origin_country_std
""", views=("stock", "crisis"))
def q_crisis_origin(spark, sf):
    cat = views(spark, sf)
    per_origin = (sel.filter_selection(cat.cube(), F0).groupBy("origin_country_std")
                  .agg(F.coalesce(F.sum(V), F.lit(0.0)).alias("_v")))
    return (F.broadcast(cat.view("crisis")).join(per_origin, "origin_country_std", "left")
            .select("crisis", "origin_country_std", F.coalesce("_v", F.lit(0.0)).alias(V)))


def _clean_counts_sql():
    parts = []
    for role in ("origin", "host"):
        for mo in (False, True):
            cond = clean_sql(role) + (f" AND {role}_map_eligible_flag" if mo else "")
            parts.append(f"SELECT '{role}' AS role, {str(mo).lower()} AS map_only, count(*) AS rows, "
                         f"coalesce(sum(value_observed), 0) AS value_observed FROM stock WHERE {cond}")
    return "\nUNION ALL\n".join(parts)


@register("clean_entities", _clean_counts_sql())
def q_clean_entities(spark, sf):
    """Cells and value kept by each cleaning variant, from one pass over the cube."""
    variants = [(role, mo) for role in ("origin", "host") for mo in (False, True)]
    aggs = []
    for role, mo in variants:
        c = sel.clean_condition(role, map_only=mo)
        # cube rows carry their cell counts: a kept cube row keeps all its cells
        aggs += [F.coalesce(F.sum(F.when(c, F.col("source_rows"))), F.lit(0)).cast("bigint")
                 .alias(f"{role}_{mo}_rows"),
                 F.coalesce(F.sum(F.when(c, F.col(V))), F.lit(0.0)).alias(f"{role}_{mo}_v")]
    a = _cube(spark, sf).agg(*aggs)
    rows = F.array(*[F.struct(F.lit(role).alias("role"), F.lit(mo).alias("map_only"),
                              F.col(f"{role}_{mo}_rows").alias("rows"), F.col(f"{role}_{mo}_v").alias(V))
                     for role, mo in variants])
    return a.select(F.inline(rows))


@register("positive_only", f"""
SELECT host_country_std, population_type_std, coalesce(sum(value_observed), 0) AS value_observed
FROM stock WHERE {SEL} AND host_country_std IS NOT NULL
GROUP BY host_country_std, population_type_std HAVING coalesce(sum(value_observed), 0) > 0
""")
def q_positive_only(spark, sf):
    d = sel.filter_selection(_cube(spark, sf), F0).dropna(subset=["host_country_std"])
    return sel.positive_only(d.groupBy("host_country_std", "population_type_std")
                             .agg(F.coalesce(F.sum(V), F.lit(0.0)).alias(V)))


@register("key_not_null", """
SELECT year, count(*) AS rows FROM stock
WHERE origin_iso3 IS NOT NULL AND host_iso3 IS NOT NULL GROUP BY year
""")
def q_key_not_null(spark, sf):
    cube = _cube(spark, sf)
    return (sel.key_not_null(cube, ["origin_iso3", "host_iso3"])
            .groupBy("year").agg(row_count(cube).alias("rows")))


@register("last_n_years", """
SELECT year, count(*) AS rows FROM stock
WHERE year IN (SELECT DISTINCT year FROM stock WHERE year IS NOT NULL ORDER BY year DESC LIMIT 12)
GROUP BY year
""")
def q_last_n_years(spark, sf):
    cube = _cube(spark, sf)
    return sel.last_n_years(cube, 12).groupBy("year").agg(row_count(cube).alias("rows"))


@register("year_bounds", "SELECT min(year) AS year_min, max(year) AS year_max FROM stock")
def q_year_bounds(spark, sf):
    return sel.year_bounds(_cube(spark, sf))


@register("filter_choices", """
SELECT 'origin' AS role, 0 AS choice_order, 'All' AS choice
UNION ALL SELECT DISTINCT 'origin', 1, origin_country_std FROM stock
  WHERE origin_country_std IS NOT NULL AND origin_mapping_status IS DISTINCT FROM 'special_entity'
UNION ALL SELECT 'host', 0, 'All'
UNION ALL SELECT DISTINCT 'host', 1, host_country_std FROM stock
  WHERE host_country_std IS NOT NULL AND host_mapping_status IS DISTINCT FROM 'special_entity'
""")
def q_filter_choices(spark, sf):
    s = _cube(spark, sf)
    o = sel.filter_choices(s, "origin").select(F.lit("origin").alias("role"), "choice_order", "choice")
    h = sel.filter_choices(s, "host").select(F.lit("host").alias("role"), "choice_order", "choice")
    return o.unionByName(h)


@register("filter_options", """
SELECT string_agg(DISTINCT cast(year AS varchar), ',' ORDER BY cast(year AS varchar)) AS years,
       string_agg(DISTINCT population_type_std, ',' ORDER BY population_type_std) AS population_types,
       string_agg(DISTINCT origin_country_std, ',' ORDER BY origin_country_std) AS origin_countries,
       string_agg(DISTINCT host_country_std, ',' ORDER BY host_country_std) AS host_countries,
       count(DISTINCT origin_country_std) AS origin_country_count,
       count(DISTINCT host_country_std) AS host_country_count
FROM stock
""")
def q_filter_options(spark, sf):
    o = sel.filter_options(_cube(spark, sf))
    # the nested arrays are compared as comma-joined text
    return o.select(
        F.array_join(F.transform("years", lambda x: x.cast("string")), ",").alias("years"),
        F.array_join("population_types", ",").alias("population_types"),
        F.array_join("origin_countries", ",").alias("origin_countries"),
        F.array_join("host_countries", ",").alias("host_countries"),
        "origin_country_count", "host_country_count")


_COVERED = {"stock": ("origin", "host"), "decisions": ("origin", "host"), "apps_monthly": ("host",),
            "resettlement": ("origin", "host"), "demographics_wide": ("host",), "poc_wide": ("origin", "host")}


def _coverage_sql(table, roles):
    names = [f"(SELECT string_agg(c, ',' ORDER BY c) FROM (SELECT DISTINCT {r}_country_std AS c FROM {table}))" if r in roles
             else "cast(NULL AS varchar)" for r in ("origin", "host")]
    return f"""SELECT '{table}' AS dataset, count(*) AS rows, min(year) AS year_min, max(year) AS year_max,
       (SELECT string_agg(cast(y AS varchar), ',' ORDER BY y) FROM (SELECT DISTINCT year AS y FROM {table})) AS years,
       {names[0]} AS origin_countries, {names[1]} AS host_countries FROM {table}"""


@register("filter_options_coverage", "\nUNION ALL\n".join(_coverage_sql(t, r) for t, r in _COVERED.items()), views=tuple(_COVERED))
def q_filter_options_coverage(spark, sf):
    """Written into the filter options' JSON document and read back from it."""
    cat = views(spark, sf)
    cube = _cube(spark, sf)
    tables = {t: cube if t == "stock" else cat.view(t) for t in _COVERED}
    back = sel.read_coverage(sel.filter_options_document(cube, tables))
    return back.select("dataset", "rows", "year_min", "year_max",
                       F.array_join(F.transform("years", lambda y: y.cast("string")), ",").alias("years"),
                       F.array_join("origin_countries", ",").alias("origin_countries"),
                       F.array_join("host_countries", ",").alias("host_countries"))


@register("year_fallback", """
SELECT cast(coalesce(max(CASE WHEN year = 1990 THEN year END), max(year)) AS int) AS target_year FROM stock
""")
def q_year_fallback(spark, sf):
    return sel.year_fallback(_cube(spark, sf), 1990)


# ============================================================ §2.5 stock
@register("kpis", f"""
, a AS (SELECT * FROM stock WHERE year = {LATEST_YEAR} AND population_type_std IN {ACTIVE})
, s AS (SELECT * FROM a WHERE population_type_std IN {CB})
SELECT coalesce((SELECT sum(value_observed) FROM s), 0) AS total,
       coalesce((SELECT sum(value_observed) FROM s WHERE population_type_std = 'Refugees'), 0) AS refugees,
       coalesce((SELECT sum(value_observed) FROM s WHERE population_type_std = 'Asylum-seekers'), 0) AS asylum,
       coalesce((SELECT sum(value_observed) FROM a WHERE population_type_std = 'IDPs'), 0) AS idps,
       (SELECT count(DISTINCT c) FROM (SELECT origin_country_std AS c FROM s
                                       UNION ALL SELECT host_country_std FROM s) u) AS countries
""")
def q_kpis(spark, sf):
    return st.kpis(_cube(spark, sf), F0)


@register("kpi_table", f"""
, d AS (SELECT * FROM stock WHERE year = {LATEST_YEAR})
, y AS (SELECT max(year) AS year FROM d)
SELECT population_type_std AS kpi, coalesce(sum(value_observed), 0) AS value, (SELECT year FROM y) AS year,
       'stock' AS source FROM d GROUP BY population_type_std
UNION ALL SELECT 'Active forced-displacement scope',
       coalesce(sum(CASE WHEN population_type_std IN {ACTIVE} THEN value_observed END), 0), (SELECT year FROM y), 'stock' FROM d
UNION ALL SELECT 'Cross-border dashboard scope',
       coalesce(sum(CASE WHEN population_type_std IN {CB} THEN value_observed END), 0), (SELECT year FROM y), 'stock' FROM d
UNION ALL SELECT 'Origin countries/entities', cast(count(DISTINCT origin_country_std) AS double), (SELECT year FROM y), 'stock' FROM d
UNION ALL SELECT 'Host countries/entities', cast(count(DISTINCT host_country_std) AS double), (SELECT year FROM y), 'stock' FROM d
UNION ALL SELECT 'Asylum applications during year', coalesce(sum(applications_observed), 0), (SELECT year FROM y), 'decisions'
  FROM decisions WHERE year = (SELECT year FROM y)
""", views=("stock", "decisions"))
def q_kpi_table(spark, sf):
    cat = views(spark, sf)
    return st.kpi_table(cat.cube(), cat.view("decisions"))


@register("trend_by_type", f"""
SELECT year, population_type_std, coalesce(sum(value_observed), 0) AS value_observed
FROM stock WHERE population_type_std IN {CB} GROUP BY year, population_type_std
""")
def q_trend_by_type(spark, sf):
    return st.trend_by_type(_cube(spark, sf), F0)


@register("annual_population_yoy", """
, a AS (SELECT year, population_type_std, coalesce(sum(value_observed), 0) AS value_observed,
               count(*) AS source_rows, count(value_observed) AS observed_rows,
               count(CASE WHEN value_is_redacted THEN 1 END) AS redacted_rows,
               count(CASE WHEN value_is_blank THEN 1 END) AS blank_rows,
               count(CASE WHEN value_is_zero THEN 1 END) AS zero_rows
        FROM stock GROUP BY year, population_type_std)
SELECT a.*, a.value_observed - p.value_observed AS yoy_absolute_change,
       CASE WHEN p.value_observed > 0 THEN a.value_observed / p.value_observed - 1 END AS yoy_pct_change
FROM a LEFT JOIN a p ON p.population_type_std = a.population_type_std AND p.year = a.year - 1
""")
def q_annual_population_yoy(spark, sf):
    return st.annual_population_yoy(_cube(spark, sf))


def _rank_cte(role: str, n: int, cte: str, extra_where: str = "") -> str:
    """CTEs ending in ``cte``: the top ``n`` ranked entities with shares."""
    name, iso = f"{role}_country_std", f"{role}_iso3"
    return f"""
, d AS (SELECT * FROM stock WHERE {SEL} AND {clean_sql(role)} {extra_where})
, g AS (SELECT {name}, {iso}, coalesce(sum(value_observed), 0) AS value_observed FROM d
        WHERE {name} IS NOT NULL GROUP BY {name}, {iso} HAVING coalesce(sum(value_observed), 0) > 0)
, {cte} AS (SELECT {name}, {iso}, value_observed,
       cast(row_number() OVER (ORDER BY value_observed DESC, {name}, {iso}) AS int) AS rank,
       CASE WHEN (SELECT sum(value_observed) FROM d) > 0
            THEN value_observed / (SELECT sum(value_observed) FROM d) END AS share
FROM g ORDER BY value_observed DESC, {name}, {iso} LIMIT {n})
"""


def _rank_sql(role: str, n: int, extra_where: str = "") -> str:
    return _rank_cte(role, n, "ranked", extra_where) + "SELECT * FROM ranked"


@register("rank_hosts", _rank_sql("host", 12))
def q_rank_hosts(spark, sf):
    return st.rank_entities(sel.filter_selection(_cube(spark, sf), F0), "host", F0.top_n)


@register("rank_origins", _rank_sql("origin", 12))
def q_rank_origins(spark, sf):
    return st.rank_entities(sel.filter_selection(_cube(spark, sf), F0), "origin", F0.top_n)


def _rank_full_cte(role: str, n: int, cte: str) -> str:
    name, iso = f"{role}_country_std", f"{role}_iso3"
    stt, fl = f"{role}_mapping_status", f"{role}_map_eligible_flag"
    return f"""
, d_{role} AS (SELECT * FROM stock WHERE {SEL} AND {clean_sql(role)})
, g_{role} AS (SELECT {name}, {iso}, {stt}, {fl}, coalesce(sum(value_observed), 0) AS value_observed,
               count(*) AS source_rows, count(value_observed) AS observed_rows
        FROM d_{role} WHERE {name} IS NOT NULL GROUP BY {name}, {iso}, {stt}, {fl}
        HAVING coalesce(sum(value_observed), 0) > 0)
, {cte} AS (SELECT g_{role}.*,
       cast(row_number() OVER (ORDER BY value_observed DESC, {name}, {iso}) AS int) AS rank,
       CASE WHEN (SELECT sum(value_observed) FROM d_{role}) > 0
            THEN value_observed / (SELECT sum(value_observed) FROM d_{role}) END AS share_of_selected_total
FROM g_{role} ORDER BY value_observed DESC, {name}, {iso} LIMIT {n})
"""


@register("rank_hosts_full", _rank_full_cte("host", 12, "r") + "SELECT * FROM r")
def q_rank_hosts_full(spark, sf):
    return st.rank_entities_full(sel.filter_selection(_cube(spark, sf), F0), "host", F0.top_n)


@register("rank_origins_full", _rank_full_cte("origin", 12, "r") + "SELECT * FROM r")
def q_rank_origins_full(spark, sf):
    return st.rank_entities_full(sel.filter_selection(_cube(spark, sf), F0), "origin", F0.top_n)


@register("rank_combined", _rank_full_cte("origin", 12, "ro") + _rank_full_cte("host", 12, "rh") + """
SELECT 'Top origin countries' AS chart_role, rank, origin_country_std AS country, origin_iso3 AS iso3,
       value_observed, share_of_selected_total FROM ro
UNION ALL
SELECT 'Top host countries', rank, host_country_std, host_iso3, value_observed, share_of_selected_total FROM rh
""")
def q_rank_combined(spark, sf):
    return st.rank_combined(sel.filter_selection(_cube(spark, sf), F0), F0.top_n)


@register("treemap_hosts", _rank_cte("host", 12, "top") + """
SELECT 'Selected host stock' AS parent, host_country_std AS label, value_observed FROM top
UNION ALL SELECT '', 'Selected host stock', sum(value_observed) FROM top
""")
def q_treemap_hosts(spark, sf):
    return st.treemap_hosts(sel.filter_selection(_cube(spark, sf), F0), F0.top_n)


@register("host_geography", f"""
SELECT host_country_std, host_iso3, coalesce(sum(value_observed), 0) AS value_observed
FROM stock WHERE {SEL} AND host_map_eligible_flag AND host_iso3 IS NOT NULL AND host_country_std IS NOT NULL
GROUP BY host_country_std, host_iso3 HAVING coalesce(sum(value_observed), 0) > 0
""")
def q_host_geography(spark, sf):
    return st.host_geography(sel.filter_selection(_cube(spark, sf), F0))


@register("choropleth_latest", f"""
SELECT year, host_country_std, host_iso3, coalesce(sum(value_observed), 0) AS value_observed, count(*) AS source_rows
FROM stock WHERE {SEL} AND host_map_eligible_flag AND host_iso3 IS NOT NULL
  AND origin_map_eligible_flag AND origin_iso3 IS NOT NULL AND host_country_std IS NOT NULL
GROUP BY year, host_country_std, host_iso3 HAVING coalesce(sum(value_observed), 0) > 0
""")
def q_choropleth_latest(spark, sf):
    return st.choropleth_latest(_cube(spark, sf))


@register("host_by_year", f"""
SELECT year, host_country_std, host_iso3, coalesce(sum(value_observed), 0) AS value_observed
FROM stock WHERE population_type_std IN {CB} AND {clean_sql('host')} AND host_map_eligible_flag
  AND host_country_std IS NOT NULL
GROUP BY year, host_country_std, host_iso3 HAVING coalesce(sum(value_observed), 0) > 0
""")
def q_host_by_year(spark, sf):
    return st.host_by_year(_cube(spark, sf))


@register("leading_pair", f"""
, d AS (SELECT * FROM stock WHERE {SEL})
SELECT coalesce((SELECT origin_country_std FROM d WHERE origin_country_std IS NOT NULL GROUP BY origin_country_std
                 ORDER BY coalesce(sum(value_observed), 0) DESC, origin_country_std LIMIT 1), '-') AS origin_name,
       coalesce((SELECT host_country_std FROM d WHERE host_country_std IS NOT NULL GROUP BY host_country_std
                 ORDER BY coalesce(sum(value_observed), 0) DESC, host_country_std LIMIT 1), '-') AS host_name
""")
def q_leading_pair(spark, sf):
    return st.leading_pair(sel.filter_selection(_cube(spark, sf), F0))


def _corridors_cte(n: int, cte: str = "top") -> str:
    return f"""
, dc AS (SELECT * FROM stock WHERE {SEL} AND {clean_sql('origin')} AND {clean_sql('host')})
, {cte} AS (SELECT origin_country_std, host_country_std, population_type_std,
               coalesce(sum(value_observed), 0) AS value_observed
        FROM dc WHERE origin_country_std IS NOT NULL AND host_country_std IS NOT NULL AND population_type_std IS NOT NULL
        GROUP BY origin_country_std, host_country_std, population_type_std
        HAVING coalesce(sum(value_observed), 0) > 0
        ORDER BY value_observed DESC, origin_country_std, host_country_std, population_type_std LIMIT {n})
"""


@register("corridors", _corridors_cte(12) + "SELECT * FROM top")
def q_corridors(spark, sf):
    return st.corridors(sel.filter_selection(_cube(spark, sf), F0), F0.top_n)


@register("corridors_full", f"""
, d AS (SELECT * FROM stock WHERE {SEL} AND {clean_sql('origin')} AND {clean_sql('host')})
SELECT year, origin_country_std, origin_iso3, host_country_std, host_iso3, population_type_std,
       coalesce(sum(value_observed), 0) AS value_observed, count(*) AS source_rows
FROM d WHERE origin_country_std IS NOT NULL AND host_country_std IS NOT NULL AND population_type_std IS NOT NULL
GROUP BY year, origin_country_std, origin_iso3, host_country_std, host_iso3, population_type_std
HAVING coalesce(sum(value_observed), 0) > 0
ORDER BY value_observed DESC, origin_country_std, host_country_std, population_type_std LIMIT 300
""")
def q_corridors_full(spark, sf):
    return st.corridors_full(_cube(spark, sf), 300)


@register("route_weights", _corridors_cte(12) + """
, mx AS (SELECT greatest(max(value_observed), 1.0) AS m FROM top)
SELECT t.origin_country_std, t.host_country_std, t.population_type_std, t.value_observed,
       t.value_observed / (SELECT m FROM mx) AS rel,
       co.lat AS origin_lat, co.lon AS origin_lon, ch.lat AS host_lat, ch.lon AS host_lon
FROM top t JOIN centroid co ON co.country_std = t.origin_country_std
           JOIN centroid ch ON ch.country_std = t.host_country_std
""", views=("stock", "centroid"))
def q_route_weights(spark, sf):
    cat = views(spark, sf)
    corr = st.corridors(sel.filter_selection(cat.cube(), F0), F0.top_n)
    return st.route_weights(corr, cat.view("centroid"))


_SANKEY_LAYERS = _corridors_cte(12) + """
, c AS (SELECT * FROM top)
, l AS (SELECT 1 AS layer, origin_country_std AS source, host_country_std AS target, sum(value_observed) AS value_observed
        FROM c GROUP BY origin_country_std, host_country_std
        UNION ALL
        SELECT 2, host_country_std, population_type_std, sum(value_observed) FROM c
        GROUP BY host_country_std, population_type_std)
"""


def _sankey_layers_df(spark, sf):
    corr = st.corridors(sel.filter_selection(_cube(spark, sf), F0), F0.top_n)
    return st.sankey_layers(corr)


@register("sankey_layers", _SANKEY_LAYERS + "SELECT * FROM l")
def q_sankey_layers(spark, sf):
    return _sankey_layers_df(spark, sf)


@register("sankey_nodes", _SANKEY_LAYERS + """
, n AS (SELECT 0 AS layer, source AS label FROM l WHERE layer = 1
        UNION SELECT 1, target FROM l WHERE layer = 1
        UNION SELECT 2, target FROM l WHERE layer = 2)
SELECT cast(dense_rank() OVER (ORDER BY layer, label) - 1 AS int) AS node_id, layer, label FROM n
""")
def q_sankey_nodes(spark, sf):
    return st.sankey_nodes(_sankey_layers_df(spark, sf))


@register("crisis_hosts", _rank_sql("host", 12, f"AND origin_country_std = '{FOCUS}'"))
def q_crisis_hosts(spark, sf):
    return st.crisis_hosts(_cube(spark, sf), F0)


@register("crisis_routes", f"""
, d AS (SELECT * FROM stock WHERE {SEL} AND origin_country_std = '{FOCUS}')
, r AS (SELECT origin_country_std, host_country_std, coalesce(sum(value_observed), 0) AS value_observed FROM d
        WHERE origin_country_std IS NOT NULL AND host_country_std IS NOT NULL
        GROUP BY origin_country_std, host_country_std ORDER BY value_observed DESC, host_country_std LIMIT 12)
SELECT * FROM r WHERE value_observed > 0
""")
def q_crisis_routes(spark, sf):
    return st.crisis_routes(_cube(spark, sf), F0)


@register("crisis_annotated_trend", f"""
, a AS (SELECT year, coalesce(sum(value_observed), 0) AS value_observed FROM stock
        WHERE population_type_std IN {CB} AND origin_country_std = '{FOCUS}' GROUP BY year)
SELECT a.year, a.value_observed, e.event FROM a
LEFT JOIN (SELECT year, event FROM crisis_events WHERE crisis = 'Crisis 1') e ON e.year = a.year
""", views=("stock", "crisis_events"))
def q_crisis_annotated_trend(spark, sf):
    cat = views(spark, sf)
    return st.crisis_annotated_trend(cat.cube(), cat.view("crisis_events"), F0)


@register("crisis_trend", f"""
SELECT year, population_type_std, coalesce(sum(value_observed), 0) AS value_observed FROM stock
WHERE origin_country_std = '{FOCUS}' AND population_type_std IN {CB} GROUP BY year, population_type_std
""")
def q_crisis_trend(spark, sf):
    return st.crisis_trend(_cube(spark, sf), FOCUS)


@register("crisis_summary", f"""
, d AS (SELECT * FROM stock WHERE population_type_std IN {CB})
, top AS (SELECT origin_country_std FROM d
          WHERE year = (SELECT max(year) FROM stock) AND {clean_sql('origin')} AND origin_country_std IS NOT NULL
          GROUP BY origin_country_std, origin_iso3 HAVING coalesce(sum(value_observed), 0) > 0
          ORDER BY coalesce(sum(value_observed), 0) DESC, origin_country_std, origin_iso3 LIMIT 5)
, a AS (SELECT origin_country_std, year, coalesce(sum(value_observed), 0) AS v FROM d
        WHERE {clean_sql('origin')} AND origin_country_std IN (SELECT origin_country_std FROM top)
        GROUP BY origin_country_std, year)
, r AS (SELECT *, row_number() OVER (PARTITION BY origin_country_std ORDER BY v DESC, year DESC) AS pk,
                  row_number() OVER (PARTITION BY origin_country_std ORDER BY year DESC) AS lt FROM a)
SELECT origin_country_std AS crisis_or_origin,
       min(CASE WHEN v > 0 THEN year END) AS first_observed_year,
       max(CASE WHEN lt = 1 THEN year END) AS latest_year,
       max(CASE WHEN lt = 1 THEN v END) AS latest_value_observed,
       max(CASE WHEN pk = 1 THEN year END) AS peak_year_in_dataset,
       max(CASE WHEN pk = 1 THEN v END) AS peak_value_observed
FROM r GROUP BY origin_country_std
""")
def q_crisis_summary(spark, sf):
    return st.crisis_summary(_cube(spark, sf), 5)


@register("crisis_top_hosts", f"""
SELECT host_country_std, host_iso3, coalesce(sum(value_observed), 0) AS value_observed FROM stock
WHERE {SEL} AND origin_country_std = '{FOCUS}' AND {clean_sql('host')}
  AND host_country_std IS NOT NULL AND host_iso3 IS NOT NULL
GROUP BY host_country_std, host_iso3 HAVING coalesce(sum(value_observed), 0) > 0
ORDER BY value_observed DESC, host_country_std LIMIT 15
""")
def q_crisis_top_hosts(spark, sf):
    return st.crisis_top_hosts(_cube(spark, sf), FOCUS, 15)


@register("concentration_by_year", f"""
, d AS (SELECT * FROM stock WHERE population_type_std IN {CB})
, e AS (SELECT year, 'origin' AS dimension, origin_country_std AS country, value_observed AS v FROM d
        WHERE {clean_sql('origin')} AND origin_country_std IS NOT NULL
        UNION ALL
        SELECT year, 'host', host_country_std, value_observed FROM d
        WHERE {clean_sql('host')} AND host_country_std IS NOT NULL)
, g AS (SELECT year, dimension, country, coalesce(sum(v), 0) AS v FROM e GROUP BY year, dimension, country
        HAVING coalesce(sum(v), 0) > 0)
, r AS (SELECT *, row_number() OVER (PARTITION BY year, dimension ORDER BY v DESC, country) AS rn FROM g)
SELECT year, dimension, count(*) AS countries, sum(v) AS total_observed,
       max(v) / sum(v) AS top1_share,
       sum(CASE WHEN rn <= 5 THEN v END) / sum(v) AS top5_share,
       sum(v * v) / (sum(v) * sum(v)) AS hhi
FROM r GROUP BY year, dimension
""")
def q_concentration_by_year(spark, sf):
    return st.concentration_by_year(_cube(spark, sf))


@register("role_scatter", f"""
, d AS (SELECT * FROM stock WHERE {SEL})
, o AS (SELECT origin_country_std AS country, origin_iso3 AS iso3, coalesce(sum(value_observed), 0) AS v
        FROM d WHERE {clean_sql('origin')} AND origin_country_std IS NOT NULL GROUP BY origin_country_std, origin_iso3)
, h AS (SELECT host_country_std AS country, host_iso3 AS iso3, coalesce(sum(value_observed), 0) AS v
        FROM d WHERE {clean_sql('host')} AND host_country_std IS NOT NULL GROUP BY host_country_std, host_iso3)
, j AS (SELECT coalesce(o.country, h.country) AS country, coalesce(o.iso3, h.iso3) AS iso3,
               coalesce(o.v, 0) AS os, coalesce(h.v, 0) AS hs
        FROM o FULL OUTER JOIN h ON o.country = h.country AND o.iso3 = h.iso3)
SELECT country, iso3, os AS origin_stock_observed, hs AS host_stock_observed, hs - os AS net_host_minus_origin,
       CASE WHEN os > 0 AND hs > 0 THEN 'both_origin_and_host' WHEN hs > 0 THEN 'mostly_host'
            WHEN os > 0 THEN 'mostly_origin' ELSE 'no_observed_role' END AS role_class
FROM j
""")
def q_role_scatter(spark, sf):
    return st.role_scatter(_cube(spark, sf))


@register("host_pressure", f"""
, d AS (SELECT * FROM stock WHERE {SEL} AND {clean_sql('host')})
, h AS (SELECT year, host_country_std, host_iso3, coalesce(sum(value_observed), 0) AS host_stock_observed,
               count(*) AS source_rows
        FROM d WHERE host_country_std IS NOT NULL GROUP BY year, host_country_std, host_iso3
        HAVING coalesce(sum(value_observed), 0) > 0)
SELECT h.year, h.host_country_std AS country, h.host_iso3 AS iso3, h.host_stock_observed, h.source_rows,
       p.population_total, h.host_stock_observed * 100000.0 / p.population_total AS host_stock_per_100k_population,
       p.gdp_per_capita, p.income_group,
       CASE WHEN p.population_total IS NULL THEN 'missing_wdi_denominator' ELSE 'ok' END AS wdi_status
FROM h LEFT JOIN population p ON p.iso3 = h.host_iso3 AND p.year = h.year
""", views=("stock", "population"))
def q_host_pressure(spark, sf):
    cat = views(spark, sf)
    return st.host_pressure(cat.cube(), cat.view("population"))


@register("network_metrics", f"""
, d AS (SELECT * FROM stock WHERE {SEL} AND {clean_sql('origin')} AND {clean_sql('host')})
, e AS (SELECT origin_country_std, host_country_std, coalesce(sum(value_observed), 0) AS w FROM d
        WHERE origin_country_std IS NOT NULL AND host_country_std IS NOT NULL
        GROUP BY origin_country_std, host_country_std HAVING coalesce(sum(value_observed), 0) > 0)
, n AS (SELECT 'Origin: ' || origin_country_std AS node, 'origin' AS node_type, w FROM e
        UNION ALL SELECT 'Host: ' || host_country_std, 'host', w FROM e)
SELECT node, node_type, count(*) AS degree,
       coalesce(sum(CASE WHEN node_type = 'host' THEN w END), 0) AS in_strength,
       coalesce(sum(CASE WHEN node_type = 'origin' THEN w END), 0) AS out_strength,
       cast(0 AS double) AS betweenness
FROM n GROUP BY node, node_type
""")
def q_network_metrics(spark, sf):
    return st.network_metrics(_cube(spark, sf))
