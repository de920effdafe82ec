"""Flow aggregations: monthly applications, seasonality, asylum decisions,
resettlement and demographics.

Flows are never mixed with stocks: each function reads one flow table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.functions.columns import share, sum0
from flowatlas.operators.clean import melt_age_sex, month_to_num, reconcile_decision_total
from flowatlas.operators.select import filter_year
from flowatlas.schemas import LATEST

OUTCOMES = ["recognized_observed", "rejected_observed", "other_decisions_observed",
            "otherwise_closed_observed"]
# Decision-status labels of the Sankey, in outcome order, its
# node prefixes and its two link layers.
STATUS_LABELS = {"recognized_observed": "Recognized", "rejected_observed": "Rejected",
                 "other_decisions_observed": "Other decision",
                 "otherwise_closed_observed": "Otherwise closed"}
ORIGIN_PREFIX, HOST_PREFIX, STATUS_PREFIX = "Origin: ", "Host: ", "Status: "
LAYER_ORIGIN_HOST, LAYER_HOST_STATUS = "origin_to_host", "host_to_status"


def monthly_applications(apps: DataFrame) -> DataFrame:
    """Applications and source rows per (year, month)."""
    d = apps if "month_num" in apps.columns else month_to_num(apps, "month")
    return d.groupBy("year", "month_num", "month").agg(
        sum0("applications_monthly_observed").alias("applications_observed"),
        F.count(F.lit(1)).alias("source_rows"))


def monthly_mean(monthly: DataFrame) -> DataFrame:
    """Mean of the monthly totals per calendar month."""
    return monthly.groupBy("month_num", "month").agg(
        F.avg("applications_observed").alias("applications_observed"))


def seasonality_profile(monthly: DataFrame) -> DataFrame:
    """Mean, median (linear interpolation) and max of monthly totals per
    calendar month; a partial last year gives some months one value fewer."""
    return monthly.groupBy("month_num", "month").agg(
        F.avg("applications_observed").alias("mean_applications"),
        F.median("applications_observed").alias("median_applications"),
        F.max("applications_observed").alias("max_applications"))


def asylum_by_year(decisions: DataFrame) -> DataFrame:
    """Per year: applications, the four outcomes, the final decision total,
    mismatching reported totals, rows and the recognition rate."""
    d = reconcile_decision_total(decisions)
    a = d.groupBy("year").agg(
        sum0("applications_observed").alias("applications_observed"),
        *[sum0(c).alias(c) for c in OUTCOMES],
        sum0("total_decisions_final").alias("total_decisions_final"),
        F.count_if("decision_total_mismatch_flag").alias("decision_total_mismatch_rows"),
        F.count(F.lit(1)).alias("source_rows"))
    return a.withColumn("recognition_rate_observed",
                        share("recognized_observed", "total_decisions_final"))


def application_corridors(decisions: DataFrame, n: int = 150, year=LATEST) -> DataFrame:
    """Top ``n`` origin -> host application corridors of a year, with the
    outcome sums."""
    d = reconcile_decision_total(filter_year(decisions, year))
    keys = ["year", "origin_country_std", "origin_iso3", "host_country_std", "host_iso3"]
    return (d.dropna(subset=["origin_country_std", "host_country_std"]).groupBy(*keys).agg(
        sum0("applications_observed").alias("applications_observed"),
        *[sum0(c).alias(c) for c in OUTCOMES],
        sum0("total_decisions_final").alias("total_decisions_final"),
        F.count(F.lit(1)).alias("source_rows"))
        .orderBy(F.col("applications_observed").desc(), F.col("origin_country_std"),
                 F.col("host_country_std")).limit(int(n)))


def decision_sankey(decisions: DataFrame, n: int = 40, year=LATEST) -> DataFrame:
    """Layer 1: the top ``n`` application corridors (origin -> host).
    Layer 2: those same corridors summed per host and split into the four
    decision outcomes (host -> status), positive links only."""
    top = application_corridors(decisions, n, year)
    l1 = top.select(F.concat(F.lit(ORIGIN_PREFIX), "origin_country_std").alias("source"),
                    F.concat(F.lit(HOST_PREFIX), "host_country_std").alias("target"),
                    F.col("applications_observed").alias("value_observed"),
                    F.lit(LAYER_ORIGIN_HOST).alias("link_layer"))
    per_host = top.groupBy("host_country_std").agg(*[F.sum(c).alias(STATUS_LABELS[c]) for c in OUTCOMES])
    l2 = (per_host.unpivot(["host_country_std"], list(STATUS_LABELS.values()), "status", "value_observed")
          .filter(F.col("value_observed") > 0)
          .select(F.concat(F.lit(HOST_PREFIX), "host_country_std").alias("source"),
                  F.concat(F.lit(STATUS_PREFIX), "status").alias("target"), "value_observed",
                  F.lit(LAYER_HOST_STATUS).alias("link_layer")))
    return l1.unionByName(l2)


def resettlement_by_year(df: DataFrame) -> DataFrame:
    return df.groupBy("year").agg(sum0("resettlement_observed").alias("resettlement_observed"),
                                  F.count(F.lit(1)).alias("source_rows"))


def resettlement_top_destinations(df: DataFrame, n: int = 20) -> DataFrame:
    """All-years top ``n`` resettlement hosts."""
    return (df.dropna(subset=["host_country_std"]).groupBy("host_country_std", "host_iso3")
            .agg(sum0("resettlement_observed").alias("resettlement_observed"),
                 F.count(F.lit(1)).alias("source_rows"))
            .filter(F.col("resettlement_observed") > 0)
            .orderBy(F.col("resettlement_observed").desc(), F.col("host_country_std")).limit(int(n)))


def demographics_latest(wide: DataFrame) -> DataFrame:
    """Age x sex totals of the latest year, with the age order."""
    return melt_age_sex(filter_year(wide, LATEST)).select(
        "year", "age_group", "sex", "value_observed", "age_order")
