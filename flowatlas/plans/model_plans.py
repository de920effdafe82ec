"""Registered model and trend queries (§2.8).

The forest-based outputs have no SQL twin (MLlib trees are not
reproducible by SQL); they get a rows-only check here and invariant tests
in ``tests/``. Split, gates and the OLS trend have exact oracles.
"""

from __future__ import annotations

from pyspark.sql import functions as F

from flowatlas.operators import model as ml
from flowatlas.operators import trend as tr
from flowatlas.operators.select import scope_fallback
from flowatlas.plans.common import ACTIVE, register, views
from flowatlas.plans.spatial_plans import CY_SQL, CY_VIEWS, F_ALL, corridor_year_df
from flowatlas.schemas import ACTIVE_FORCED_TYPES, Filters
from flowatlas.sources.catalog import source_key

N_TREES = 140


def _bundle(spark, sf, f: Filters = F_ALL):
    """The forest of the scope (trained on every year of the scope, origin /
    host / crisis filters ignored), fitted once per run."""
    scope_f = Filters(year=None, scope=f.scope)
    key = (spark.sparkContext.applicationId, source_key(spark, sf), f.scope, N_TREES)
    return ml.fit_forest_cached(key, corridor_year_df(spark, sf, scope_f), n_trees=N_TREES)


def _pred(spark, sf, f: Filters = F_ALL, year="latest"):
    b = _bundle(spark, sf, f)
    cy = corridor_year_df(spark, sf, f.with_(year=None))
    return b, ml.predict_corridors(b, cy, None if year == "latest" else int(year))


_SPLIT_SQL = CY_SQL + """
, yrs AS (SELECT DISTINCT year FROM cy WHERE year IS NOT NULL)
, ty AS (SELECT year FROM (SELECT year, row_number() OVER (ORDER BY year DESC) AS r FROM yrs) q
         WHERE r <= CASE WHEN (SELECT count(*) FROM yrs) >= 8 THEN 3 ELSE 2 END)
, sp AS (SELECT cy.*, cy.year IN (SELECT year FROM ty) AS is_test FROM cy)
"""


@register("temporal_split", _SPLIT_SQL + "SELECT year, is_test, count(*) AS rows FROM sp GROUP BY year, is_test",
          views=CY_VIEWS)
def q_temporal_split(spark, sf):
    return ml.temporal_split(corridor_year_df(spark, sf)).groupBy("year", "is_test") \
        .agg(F.count(F.lit(1)).alias("rows"))


@register("train_gates", _SPLIT_SQL + f"""
, a AS (SELECT count(*) AS rows, count(DISTINCT year) AS years,
               count(CASE WHEN NOT is_test THEN 1 END) AS train_rows, count(CASE WHEN is_test THEN 1 END) AS test_rows
        FROM sp)
, r AS (SELECT *, CASE WHEN rows < {ml.MIN_ROWS} THEN '{ml.REASON_ROWS}'
                       WHEN years < {ml.MIN_YEARS} THEN '{ml.REASON_YEARS}'
                       WHEN train_rows < {ml.MIN_TRAIN} OR test_rows < {ml.MIN_TEST} THEN '{ml.REASON_SPLIT}'
                       ELSE 'OK' END AS reason FROM a)
SELECT reason = 'OK' AS ok, reason, train_rows, test_rows FROM r
""", views=CY_VIEWS)
def q_train_gates(spark, sf):
    return ml.train_gates(corridor_year_df(spark, sf))


@register("fit_forest")
def q_fit_forest(spark, sf):
    """In-sample fit of the forest: training rows with their prediction."""
    b = _bundle(spark, sf)
    from flowatlas.plans.io_plans import scratch
    ml.save_forest(b, scratch(spark, sf, "forest_model"))  # reusable with ml.load_forest
    train = ml.temporal_split(corridor_year_df(spark, sf)).filter(~F.col("is_test"))
    return ml._predict(b, train).select("year", "origin", "host", "target_log_flow", "prediction")


@register("model_metrics")
def q_model_metrics(spark, sf):
    return ml.model_metrics(_bundle(spark, sf), corridor_year_df(spark, sf))


@register("feature_importance")
def q_feature_importance(spark, sf):
    return ml.feature_importance(_bundle(spark, sf), spark)


@register("predict_corridors")
def q_predict_corridors(spark, sf):
    _, p = _pred(spark, sf)
    return p.select("year", "origin", "host", "distance_band", "value_observed", "prediction_year",
                    "predicted_value", "actual_value")


@register("distance_mix_actual_vs_predicted")
def q_distance_mix_actual_vs_predicted(spark, sf):
    _, p = _pred(spark, sf)
    return ml.distance_mix_actual_vs_predicted(p)


@register("distance_uncertainty")
def q_distance_uncertainty(spark, sf):
    b, p = _pred(spark, sf)
    return ml.distance_uncertainty(b, p)


@register("top_destinations")
def q_top_destinations(spark, sf):
    _, p = _pred(spark, sf)
    return ml.top_destinations(p, 10)


@register("corridor_similarity")
def q_corridor_similarity(spark, sf):
    return ml.corridor_similarity(corridor_year_df(spark, sf))


@register("scope_fallback", CY_SQL + """
, nr AS (SELECT * FROM cy WHERE origin = 'NATION_22')
SELECT year, origin, host, value_observed, 'selection' AS input_used FROM nr WHERE (SELECT count(*) FROM nr) >= 10
UNION ALL
SELECT year, origin, host, value_observed, 'scope' FROM cy
WHERE (SELECT count(*) FROM nr) < 10 AND (SELECT count(*) FROM cy) >= 10
""", views=CY_VIEWS)
def q_scope_fallback(spark, sf):
    """An origin filter naming an entity without centroid leaves fewer than
    10 corridor-years, so the whole scope is used instead."""
    narrow = corridor_year_df(spark, sf, F_ALL.with_(origin="NATION_22"))
    whole = corridor_year_df(spark, sf, Filters(year=None))
    return scope_fallback(narrow, whole, 10).select("year", "origin", "host", "value_observed", "input_used")


# ------------------------------------------------------------------ trend
def _annual(spark, sf):
    s = views(spark, sf).cube().filter(F.col("population_type_std").isin(ACTIVE_FORCED_TYPES))
    return s.groupBy("year").agg(F.coalesce(F.sum("value_observed"), F.lit(0.0)).alias("value_observed"))


_OLS_SQL = f"""
, an AS (SELECT year, coalesce(sum(value_observed), 0) AS value_observed FROM stock
         WHERE population_type_std IN {ACTIVE} GROUP BY year)
, rk AS (SELECT *, row_number() OVER (ORDER BY year DESC) <= 3 AS h,
                cast(year - min(year) OVER () AS double) AS x FROM an)
, fit AS (SELECT min(year) AS x0,
                 sum(CASE WHEN NOT h THEN cast(1 AS double) END) AS n,
                 sum(CASE WHEN NOT h THEN x END) AS sx,
                 sum(CASE WHEN NOT h THEN value_observed END) AS sy,
                 sum(CASE WHEN NOT h THEN x * value_observed END) AS sxy,
                 sum(CASE WHEN NOT h THEN x * x END) AS sxx,
                 max(year) AS last_year,
                 (SELECT value_observed FROM rk WHERE NOT h ORDER BY year DESC LIMIT 1) AS last_train_value
          FROM rk)
, f2 AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM fit)
, f3 AS (SELECT *, (sy - slope * sx) / n AS intercept FROM f2)
"""


@register("trend_forecast", _OLS_SQL + """
SELECT year, round(value_observed, 6) AS value_observed, 'observed' AS series FROM an
UNION ALL
SELECT cast(last_year + k AS int) AS year, round(intercept + slope * cast(last_year + k - x0 AS double), 6),
       'linear_trend_forecast_exploratory' FROM f3, range(1, 6) t(k)
""")
def q_trend_forecast(spark, sf):
    f = tr.trend_forecast(_annual(spark, sf), horizon=5, holdout=3)
    return f.select("year", F.round("value_observed", 6).alias("value_observed"), "series")


@register("forecast_compare", _OLS_SQL + """
, ev AS (SELECT rk.year, rk.value_observed, f3.* EXCLUDE (last_year) FROM rk, f3 WHERE rk.h)
SELECT model, round(m, 6) AS holdout_mae, CASE WHEN l < nv THEN 'linear_trend' WHEN nv IS NOT NULL THEN 'naive_last_observed' END AS winner
FROM (SELECT avg(abs(value_observed - last_train_value)) AS nv,
             avg(abs(value_observed - (intercept + slope * cast(year - x0 AS double)))) AS l FROM ev) q,
     LATERAL (SELECT 'naive_last_observed' AS model, nv AS m UNION ALL SELECT 'linear_trend', l) u
""")
def q_forecast_compare(spark, sf):
    c = tr.forecast_compare(_annual(spark, sf), holdout=3)
    return c.select("model", F.round("holdout_mae", 6).alias("holdout_mae"), "winner")





# ------------------------------------------------------------------ per-group trend
def _annual_by_type(spark, sf):
    s = views(spark, sf).cube()
    return s.groupBy("population_type_std", "year").agg(
        F.coalesce(F.sum("value_observed"), F.lit(0.0)).alias("value_observed"))


_OLS_BY_TYPE_SQL = """
, an AS (SELECT population_type_std, year, coalesce(sum(value_observed), 0) AS value_observed FROM stock
         GROUP BY population_type_std, year)
, rk AS (SELECT *, row_number() OVER (PARTITION BY population_type_std ORDER BY year DESC) <= 3 AS h,
                cast(year - min(year) OVER (PARTITION BY population_type_std) AS double) AS x FROM an)
, fit AS (SELECT population_type_std, min(year) AS x0,
                 sum(CASE WHEN NOT h THEN cast(1 AS double) END) AS n,
                 sum(CASE WHEN NOT h THEN x END) AS sx,
                 sum(CASE WHEN NOT h THEN value_observed END) AS sy,
                 sum(CASE WHEN NOT h THEN x * value_observed END) AS sxy,
                 sum(CASE WHEN NOT h THEN x * x END) AS sxx,
                 max(year) AS last_year,
                 arg_max(CASE WHEN NOT h THEN value_observed END, CASE WHEN NOT h THEN year END) AS last_train_value
          FROM rk GROUP BY population_type_std)
, f2 AS (SELECT *, (n * sxy - sx * sy) / (n * sxx - sx * sx) AS slope FROM fit)
, f3 AS (SELECT *, (sy - slope * sx) / n AS intercept FROM f2)
"""


@register("trend_forecast_by_type", _OLS_BY_TYPE_SQL + """
SELECT population_type_std, year, round(value_observed, 6) AS value_observed, 'observed' AS series FROM an
UNION ALL
SELECT population_type_std, cast(last_year + k AS int) AS year,
       round(intercept + slope * cast(last_year + k - x0 AS double), 6), 'linear_trend_forecast_exploratory'
FROM f3, range(1, 6) t(k)
""")
def q_trend_forecast_by_type(spark, sf):
    """One OLS trend per population type in a single aggregation (the
    ``group_cols`` form that fits thousands of series at once)."""
    f = tr.trend_forecast(_annual_by_type(spark, sf), horizon=5, holdout=3, group_cols=["population_type_std"])
    return f.select("population_type_std", "year", F.round("value_observed", 6).alias("value_observed"), "series")


@register("forecast_compare_by_type", _OLS_BY_TYPE_SQL + """
, ev AS (SELECT rk.population_type_std, rk.year, rk.value_observed, f3.x0, f3.slope, f3.intercept,
                f3.last_train_value
         FROM rk JOIN f3 ON f3.population_type_std = rk.population_type_std WHERE rk.h)
SELECT population_type_std, model, round(m, 6) AS holdout_mae,
       CASE WHEN l < nv THEN 'linear_trend' WHEN nv IS NOT NULL THEN 'naive_last_observed' END AS winner
FROM (SELECT population_type_std, avg(abs(value_observed - last_train_value)) AS nv,
             avg(abs(value_observed - (intercept + slope * cast(year - x0 AS double)))) AS l
      FROM ev GROUP BY population_type_std) q,
     LATERAL (SELECT 'naive_last_observed' AS model, nv AS m UNION ALL SELECT 'linear_trend', l) u
""")
def q_forecast_compare_by_type(spark, sf):
    c = tr.forecast_compare(_annual_by_type(spark, sf), holdout=3, group_cols=["population_type_std"])
    return c.select("population_type_std", "model", F.round("holdout_mae", 6).alias("holdout_mae"), "winner")
