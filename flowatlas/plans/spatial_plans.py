"""Registered spatial / lag feature queries (§2.7) with oracles.

Trigonometric and logarithmic outputs are rounded (distance to 6, logs to
9 decimals) in the registered views and in the oracle alike: the JVM and
DuckDB may differ in the last bit of ``sin`` or ``log1p``.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowatlas.operators import spatial as sp
from flowatlas.operators.select import filter_selection
from flowatlas.plans.common import CB, register, views
from flowatlas.schemas import BAND_FAR, BAND_NEAR, BAND_REGIONAL, DISTANCE_BANDS, FEATURE_COLUMNS, Filters

F_ALL = Filters(year=None)  # every year of the default (cross-border) scope
LOGS = ["prev_flow_log", "origin_prev_total_log", "host_prev_total_log", "target_log_flow"]

HAVERSINE_SQL = ("2 * 6371.0 * asin(sqrt(pow(sin(radians(host_lat - origin_lat) / 2), 2) + "
                 "cos(radians(origin_lat)) * cos(radians(host_lat)) * "
                 "pow(sin(radians(host_lon - origin_lon) / 2), 2)))")
BAND_SQL = (f"CASE WHEN distance_km < 1000 THEN '{BAND_NEAR}' WHEN distance_km < 3000 "
            f"THEN '{BAND_REGIONAL}' ELSE '{BAND_FAR}' END")

# corridor-year table of the default scope, all years
CY_SQL = f"""
, cy_sel AS (SELECT * FROM stock WHERE population_type_std IN {CB})
, cy_base AS (SELECT year, origin_country_std AS origin, host_country_std AS host,
                     coalesce(sum(value_observed), 0) AS v
              FROM cy_sel WHERE year IS NOT NULL AND origin_country_std IS NOT NULL AND host_country_std IS NOT NULL
              GROUP BY year, origin_country_std, host_country_std HAVING coalesce(sum(value_observed), 0) > 0)
, cy_geo AS (SELECT b.*, co.lat AS origin_lat, co.lon AS origin_lon, ch.lat AS host_lat, ch.lon AS host_lon
             FROM cy_base b JOIN centroid co ON co.country_std = b.origin JOIN centroid ch ON ch.country_std = b.host)
, cy_d AS (SELECT *, {HAVERSINE_SQL} AS distance_km FROM cy_geo)
, cy_ot AS (SELECT year, origin, sum(v) AS t FROM cy_d GROUP BY year, origin)
, cy_ht AS (SELECT year, host, sum(v) AS t FROM cy_d GROUP BY year, host)
, cy AS (SELECT d.year, d.origin, d.host, d.distance_km, {BAND_SQL.replace('distance_km', 'd.distance_km')} AS distance_band,
                d.v AS value_observed, coalesce(p.v, 0) AS previous_year_flow,
                coalesce(o.t, 0) AS origin_total_previous_year, coalesce(h.t, 0) AS host_total_previous_year,
                ln(1 + coalesce(p.v, 0)) AS prev_flow_log, ln(1 + coalesce(o.t, 0)) AS origin_prev_total_log,
                ln(1 + coalesce(h.t, 0)) AS host_prev_total_log, ln(1 + d.v) AS target_log_flow,
                d.origin_lat, d.origin_lon, d.host_lat, d.host_lon
         FROM cy_d d
         LEFT JOIN cy_d p ON p.origin = d.origin AND p.host = d.host AND p.year = d.year - 1
         LEFT JOIN cy_ot o ON o.origin = d.origin AND o.year = d.year - 1
         LEFT JOIN cy_ht h ON h.host = d.host AND h.year = d.year - 1)
"""
CY_VIEWS = ("stock", "centroid")


def corridor_year_df(spark, sf, f: Filters = F_ALL, feature_scope: str = "selection"):
    cat = views(spark, sf)
    return sp.corridor_year_for(cat.corridors(), cat.view("centroid"), f, feature_scope)


def _pairs(spark, sf):
    cat = views(spark, sf)
    d = filter_selection(cat.cube(), F_ALL).dropna(subset=["origin_country_std", "host_country_std"])
    pairs = d.groupBy(F.col("origin_country_std").alias("origin"), F.col("host_country_std").alias("host")) \
        .agg(F.coalesce(F.sum("value_observed"), F.lit(0.0)).alias("value_observed"))
    return sp.centroid_join(pairs, cat.view("centroid"))


_PAIRS_SQL = f"""
, pr AS (SELECT origin_country_std AS origin, host_country_std AS host, coalesce(sum(value_observed), 0) AS value_observed
         FROM stock WHERE population_type_std IN {CB} AND origin_country_std IS NOT NULL AND host_country_std IS NOT NULL
         GROUP BY origin_country_std, host_country_std)
, pg AS (SELECT p.*, co.lat AS origin_lat, co.lon AS origin_lon, ch.lat AS host_lat, ch.lon AS host_lon
         FROM pr p JOIN centroid co ON co.country_std = p.origin JOIN centroid ch ON ch.country_std = p.host)
"""


@register("centroid_join", _PAIRS_SQL + "SELECT * FROM pg", views=CY_VIEWS)
def q_centroid_join(spark, sf):
    return _pairs(spark, sf)


@register("haversine_km", _PAIRS_SQL + f"SELECT origin, host, round({HAVERSINE_SQL}, 6) AS distance_km FROM pg",
          views=CY_VIEWS)
def q_haversine_km(spark, sf):
    return sp.with_distance(_pairs(spark, sf)).select("origin", "host", F.round("distance_km", 6).alias("distance_km"))


@register("distance_band", _PAIRS_SQL + f"""
, pb AS (SELECT origin, host, {BAND_SQL.replace('distance_km', HAVERSINE_SQL)} AS distance_band FROM pg)
SELECT distance_band, CASE distance_band WHEN '{BAND_NEAR}' THEN 1 WHEN '{BAND_REGIONAL}' THEN 2 ELSE 3 END AS band_order,
       count(*) AS pairs
FROM pb GROUP BY distance_band
""", views=CY_VIEWS)
def q_distance_band(spark, sf):
    from flowatlas.functions.columns import band_order
    d = sp.with_distance(_pairs(spark, sf))
    return d.groupBy("distance_band").agg(F.count(F.lit(1)).alias("pairs")) \
        .select("distance_band", band_order("distance_band").alias("band_order"), "pairs")


def _rounded_cy(cy):
    return cy.select(*[F.round(c, 6).alias(c) if c == "distance_km" else
                       F.round(c, 9).alias(c) if c in LOGS else F.col(c) for c in cy.columns])


_CY_COLS = ["year", "origin", "host", "distance_km", "distance_band", "value_observed", "previous_year_flow",
            "origin_total_previous_year", "host_total_previous_year"] + LOGS


def _cy_select_sql(cols):
    return ", ".join(f"round({c}, 6) AS {c}" if c == "distance_km" else
                     f"round({c}, 9) AS {c}" if c in LOGS else c for c in cols)


@register("corridor_year", CY_SQL + f"SELECT {_cy_select_sql(_CY_COLS)} FROM cy", views=CY_VIEWS)
def q_corridor_year(spark, sf):
    return _rounded_cy(corridor_year_df(spark, sf).select(*_CY_COLS))


@register("prev_year_flow", CY_SQL + "SELECT year, origin, host, value_observed, previous_year_flow FROM cy",
          views=CY_VIEWS)
def q_prev_year_flow(spark, sf):
    return corridor_year_df(spark, sf).select("year", "origin", "host", "value_observed", "previous_year_flow")


@register("origin_prev_total", CY_SQL + "SELECT DISTINCT year, origin, origin_total_previous_year FROM cy",
          views=CY_VIEWS)
def q_origin_prev_total(spark, sf):
    return corridor_year_df(spark, sf).select("year", "origin", "origin_total_previous_year").distinct()


@register("host_prev_total", CY_SQL + "SELECT DISTINCT year, host, host_total_previous_year FROM cy",
          views=CY_VIEWS)
def q_host_prev_total(spark, sf):
    return corridor_year_df(spark, sf).select("year", "host", "host_total_previous_year").distinct()


@register("log_features", CY_SQL + f"SELECT year, origin, host, {_cy_select_sql(LOGS)} FROM cy", views=CY_VIEWS)
def q_log_features(spark, sf):
    return _rounded_cy(corridor_year_df(spark, sf).select("year", "origin", "host", *LOGS))


def _feature_sql():
    cols = []
    for c in FEATURE_COLUMNS:
        if c.startswith("band__"):
            b = c[len("band__"):]
            cols.append(f"CASE WHEN distance_band = '{b}' THEN cast(1 AS double) ELSE cast(0 AS double) END AS \"{c}\"")
        elif c == "year":
            cols.append("cast(year AS double) AS year")
        elif c == "distance_km":
            cols.append("round(distance_km, 6) AS distance_km")
        else:
            cols.append(f"round({c}, 9) AS {c}")
    return ", ".join(cols)


@register("feature_matrix", CY_SQL + f"SELECT origin, host, {_feature_sql()} FROM cy", views=CY_VIEWS)
def q_feature_matrix(spark, sf):
    fm = sp.feature_matrix(corridor_year_df(spark, sf))
    return fm.select("origin", "host", *[
        F.round(c, 6).alias(c) if c == "distance_km" else
        F.round(c, 9).alias(c) if c in LOGS else
        F.col(f"`{c}`") for c in FEATURE_COLUMNS])


def _mix_sql():
    sums = ", ".join(f"coalesce(sum(CASE WHEN distance_band = '{b}' THEN value_observed END), 0) AS b{i}"
                     for i, b in enumerate(DISTANCE_BANDS, 1))
    parts = [f"SELECT year, '{b}' AS distance_band, {i} AS band_order, b{i} AS value_observed, "
             f"b1 + b2 + b3 AS total, CASE WHEN b1 + b2 + b3 > 0 THEN b{i} / (b1 + b2 + b3) END AS share FROM py"
             for i, b in enumerate(DISTANCE_BANDS, 1)]
    return f", py AS (SELECT year, {sums} FROM cy GROUP BY year)\n" + "\nUNION ALL\n".join(parts)


@register("distance_mix", CY_SQL + _mix_sql(), views=CY_VIEWS)
def q_distance_mix(spark, sf):
    return sp.distance_mix(corridor_year_df(spark, sf))
