"""Skew: one origin holds a third of all rows. Results must equal a brute
force computation over the same rows (pandas on the collected test data),
and the plans must still only shuffle partial aggregates (see test_plans)."""

import math

import pytest
from pyspark.sql import functions as F

from flowatlas.operators import spatial as sp
from flowatlas.operators import stock as st
from flowatlas.schemas import Filters
from flowatlas.operators.select import filter_selection

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    r = spark.range(N)
    hot = (F.col("id") % 3) == 0
    origin = F.when(hot, F.lit("HOT")).otherwise(F.concat(F.lit("O"), (F.col("id") % 17).cast("string")))
    host = F.concat(F.lit("H"), (F.col("id") % 11).cast("string"))
    df = r.select(
        (F.lit(2000) + F.col("id") % 5).cast("int").alias("year"),
        F.when(F.col("id") % 7 == 0, F.lit("IDPs")).otherwise(F.lit("Refugees")).alias("population_type_std"),
        F.when(F.col("id") % 13 == 0, F.lit(None)).otherwise((F.col("id") % 50).cast("double")).alias("value_observed"),
        origin.alias("origin_country_std"), F.upper(origin).alias("origin_iso3"),
        F.lit("manual_iso").alias("origin_mapping_status"), F.lit(True).alias("origin_map_eligible_flag"),
        host.alias("host_country_std"), F.upper(host).alias("host_iso3"),
        F.lit("manual_iso").alias("host_mapping_status"), F.lit(True).alias("host_map_eligible_flag"))
    return df.repartition(8).cache()


def test_rank_under_skew(spark, skewed):
    pdf = skewed.toPandas()
    d = pdf[pdf.population_type_std.isin(["Refugees", "Asylum-seekers", "Others of concern"])]
    want = d.groupby("origin_country_std").value_observed.sum().sort_values(ascending=False)
    got = st.rank_entities(filter_selection(skewed, Filters(year=None)), "origin", 5).collect()
    assert got[0]["origin_country_std"] == "HOT"
    assert [r["value_observed"] for r in got] == list(want.head(5).values)
    assert math.isclose(got[0]["share"], want.iloc[0] / d.value_observed.sum(), rel_tol=1e-12)


def test_corridor_lags_under_skew(spark, skewed):
    names = [r[0] for r in skewed.select("origin_country_std").union(skewed.select("host_country_std"))
             .distinct().collect()]
    cent = spark.createDataFrame([(n, float(i % 7), float(i)) for i, n in enumerate(sorted(names))],
                                 "country_std string, lat double, lon double")
    cy = sp.corridor_year(skewed, cent).toPandas()
    pdf = skewed.toPandas()
    pair = pdf.groupby(["year", "origin_country_std", "host_country_std"]).value_observed.sum(min_count=0)
    row = cy[(cy.origin == "HOT") & (cy.host == "H0") & (cy.year == 2003)].iloc[0]
    assert row.value_observed == pair[(2003, "HOT", "H0")]
    assert row.previous_year_flow == pair[(2002, "HOT", "H0")]
    origin_prev = pdf[pdf.year == 2002].groupby("origin_country_std").value_observed.sum()["HOT"]
    assert row.origin_total_previous_year == origin_prev


def test_concentration_under_skew(spark, skewed):
    c = {(r["year"], r["dimension"]): r for r in st.concentration_by_year(skewed).collect()}
    pdf = skewed.toPandas()
    d = pdf[(pdf.year == 2001) & (pdf.population_type_std == "Refugees")]
    v = d.groupby("origin_country_std").value_observed.sum()
    v = v[v > 0]
    r = c[(2001, "origin")]
    assert r["countries"] == len(v)
    assert math.isclose(r["hhi"], float(((v / v.sum()) ** 2).sum()), rel_tol=1e-12)
    assert math.isclose(r["top1_share"], v.max() / v.sum(), rel_tol=1e-12)
