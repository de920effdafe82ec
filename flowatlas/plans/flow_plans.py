"""Registered flow queries (§2.6) with oracles."""

from __future__ import annotations

from flowatlas.operators import flows as fl
from flowatlas.operators.clean import AGE_SEX_COLUMNS, MONTHS
from flowatlas.plans.common import register, views
from flowatlas.plans.ingest_plans import RECONCILED_SQL

_MONTH_NUM = "CASE " + " ".join(f"WHEN month = '{m}' THEN {i}" for i, m in enumerate(MONTHS, 1)) + " END"
_MONTHLY = f"""
, monthly AS (SELECT year, {_MONTH_NUM} AS month_num, month,
                     coalesce(sum(applications_monthly_observed), 0) AS applications_observed,
                     count(*) AS source_rows
              FROM apps_monthly GROUP BY year, 2, month)
"""


def _monthly(spark, sf):
    return fl.monthly_applications(views(spark, sf).view("apps_monthly"))


@register("monthly_applications", _MONTHLY + "SELECT * FROM monthly", views=("apps_monthly",))
def q_monthly_applications(spark, sf):
    return _monthly(spark, sf)


@register("monthly_mean", _MONTHLY + """
SELECT month_num, month, avg(applications_observed) AS applications_observed FROM monthly GROUP BY month_num, month
""", views=("apps_monthly",))
def q_monthly_mean(spark, sf):
    return fl.monthly_mean(_monthly(spark, sf))


@register("seasonality_profile", _MONTHLY + """
SELECT month_num, month, avg(applications_observed) AS mean_applications,
       median(applications_observed) AS median_applications, max(applications_observed) AS max_applications
FROM monthly GROUP BY month_num, month
""", views=("apps_monthly",))
def q_seasonality_profile(spark, sf):
    return fl.seasonality_profile(_monthly(spark, sf))


_OUT = ["recognized_observed", "rejected_observed", "other_decisions_observed", "otherwise_closed_observed"]
_OUT_SUMS = ", ".join(f"coalesce(sum({c}), 0) AS {c}" for c in _OUT)


@register("asylum_by_year", RECONCILED_SQL + f"""
, a AS (SELECT year, coalesce(sum(applications_observed), 0) AS applications_observed, {_OUT_SUMS},
               coalesce(sum(total_decisions_final), 0) AS total_decisions_final,
               count(CASE WHEN decision_total_mismatch_flag THEN 1 END) AS decision_total_mismatch_rows,
               count(*) AS source_rows
        FROM rec GROUP BY year)
SELECT a.*, CASE WHEN total_decisions_final > 0 THEN recognized_observed / total_decisions_final END
            AS recognition_rate_observed FROM a
""", views=("decisions",))
def q_asylum_by_year(spark, sf):
    return fl.asylum_by_year(views(spark, sf).view("decisions"))


def _app_corridors_sql(n: int, cte: str) -> str:
    return RECONCILED_SQL + f"""
, {cte} AS (SELECT year, origin_country_std, origin_iso3, host_country_std, host_iso3,
               coalesce(sum(applications_observed), 0) AS applications_observed, {_OUT_SUMS},
               coalesce(sum(total_decisions_final), 0) AS total_decisions_final, count(*) AS source_rows
        FROM rec WHERE year = (SELECT max(year) FROM decisions)
          AND origin_country_std IS NOT NULL AND host_country_std IS NOT NULL
        GROUP BY year, origin_country_std, origin_iso3, host_country_std, host_iso3
        ORDER BY applications_observed DESC, origin_country_std, host_country_std LIMIT {n})
"""


@register("application_corridors", _app_corridors_sql(150, "top") + "SELECT * FROM top", views=("decisions",))
def q_application_corridors(spark, sf):
    return fl.application_corridors(views(spark, sf).view("decisions"), 150)


_STATUS = fl.STATUS_LABELS


@register("decision_sankey", _app_corridors_sql(40, "top") + """
, ph AS (SELECT host_country_std, """ + ", ".join(f"sum({c}) AS {c}" for c in _OUT) + """
         FROM top GROUP BY host_country_std)
, l2 AS (""" + "\nUNION ALL\n".join(
    f"SELECT host_country_std, '{lbl}' AS status, {c} AS v FROM ph" for c, lbl in _STATUS.items()) + """)
SELECT 'Origin: ' || origin_country_std AS source, 'Host: ' || host_country_std AS target,
       applications_observed AS value_observed, 'origin_to_host' AS link_layer FROM top
UNION ALL
SELECT 'Host: ' || host_country_std, 'Status: ' || status, v, 'host_to_status' FROM l2 WHERE v > 0
""", views=("decisions",))
def q_decision_sankey(spark, sf):
    return fl.decision_sankey(views(spark, sf).view("decisions"), 40)


@register("resettlement_by_year", """
SELECT year, coalesce(sum(resettlement_observed), 0) AS resettlement_observed, count(*) AS source_rows
FROM resettlement GROUP BY year
""", views=("resettlement",))
def q_resettlement_by_year(spark, sf):
    return fl.resettlement_by_year(views(spark, sf).view("resettlement"))


@register("resettlement_top_destinations", """
SELECT host_country_std, host_iso3, coalesce(sum(resettlement_observed), 0) AS resettlement_observed,
       count(*) AS source_rows
FROM resettlement WHERE host_country_std IS NOT NULL GROUP BY host_country_std, host_iso3
HAVING coalesce(sum(resettlement_observed), 0) > 0
ORDER BY resettlement_observed DESC, host_country_std LIMIT 20
""", views=("resettlement",))
def q_resettlement_top_destinations(spark, sf):
    return fl.resettlement_top_destinations(views(spark, sf).view("resettlement"), 20)


@register("demographics_latest", ", u AS (" + "\nUNION ALL\n".join(
    f"SELECT year, '{a}' AS age_group, '{s}' AS sex, {o} AS age_order, {c} AS v FROM demographics_wide "
    f"WHERE year = (SELECT max(year) FROM demographics_wide)"
    for c, (a, s, o) in AGE_SEX_COLUMNS.items()) + """)
SELECT year, age_group, sex, coalesce(sum(v), 0) AS value_observed, age_order FROM u
GROUP BY year, age_group, sex, age_order
""", views=("demographics_wide",))
def q_demographics_latest(spark, sf):
    return fl.demographics_latest(views(spark, sf).view("demographics_wide"))


@register("streaming_monthly_applications", _MONTHLY + "SELECT * FROM monthly", views=("apps_monthly",))
def q_streaming_monthly_applications(spark, sf):
    """The monthly aggregation run as a stream over the monthly table written
    as parquet files (one folder per year) into the checkpoint folder."""
    import uuid

    from flowatlas.plans.io_plans import scratch
    from flowatlas.streaming.monthly import monthly_applications_stream, run_available

    base = scratch(spark, sf, "stream")
    src = f"{base}/source"
    apps = views(spark, sf).view("apps_monthly")
    from flowatlas.sources.catalog import path_exists
    if not path_exists(spark, f"{src}/_SUCCESS"):  # the landing folder is written once per run
        apps.write.mode("overwrite").partitionBy("year").parquet(src)
    agg = monthly_applications_stream(spark, src, apps.schema)
    run = uuid.uuid4().hex[:12]  # a fresh stream (and state) per call
    return run_available(agg, f"monthly_stream_{run}", f"{base}/checkpoint_{run}")
