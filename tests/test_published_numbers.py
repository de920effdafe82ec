"""Published numbers typed in as literals: the operators must reproduce them."""

import math

from pyspark.sql import functions as F

from flowatlas.operators import flows as fl
from flowatlas.operators import stock as st
from flowatlas.operators import trend as tr

# Annual active forced-displacement totals 1951-2016 as published
# with the reference's forecast table (66 values, in year order).
ANNUAL = [
    1957211.0, 1787928.0, 1679304.0, 1581628.0, 1547066.0, 1600875.0, 1582814.0, 1545310.0, 1520185.0,
    1504664.0, 1641867.0, 1623322.0, 1556603.0, 2954919.0, 3269615.0, 3363873.0, 2176941.0, 2313726.0,
    2433657.0, 2443730.0, 2451710.0, 2527130.0, 2322585.0, 2360973.0, 2775314.0, 3667331.0, 4395459.0,
    4913804.0, 6110422.0, 8287287.0, 9611176.0, 10218319.0, 10519723.0, 10557306.0, 11699562.0,
    12028574.0, 12668947.0, 14341431.0, 14726576.0, 17390695.0, 16848803.0, 17819063.0, 20523925.0,
    21076681.0, 19182777.0, 18210799.0, 17992562.0, 17923285.0, 17147018.0, 20729850.0, 19196833.0,
    17287843.0, 15676328.0, 16482229.0, 17041325.0, 24458671.0, 25940972.0, 25923938.0, 27425462.0,
    27340509.0, 28187051.0, 30440729.0, 37625384.0, 49517167.0, 57701163.0, 57330239.0,
]
# Published forecast and hold-out results for that series.
FORECAST_2017 = 28158216.18604386
FORECAST_2021 = 30098943.661274314
MAE_NAIVE = 17224139.0
MAE_LINEAR = 27661670.55157133


def annual(spark):
    return spark.createDataFrame([(1951 + i, v) for i, v in enumerate(ANNUAL)],
                                 "year int, value_observed double")


def test_forecast_matches_published(spark):
    f = tr.trend_forecast(annual(spark), horizon=5, holdout=3)
    fc = {r["year"]: r["value_observed"] for r in f.filter(F.col("series") == tr.FORECAST).collect()}
    assert sorted(fc) == [2017, 2018, 2019, 2020, 2021]
    assert math.isclose(fc[2017], FORECAST_2017, rel_tol=1e-12)
    assert math.isclose(fc[2021], FORECAST_2021, rel_tol=1e-12)
    assert f.filter(F.col("series") == tr.OBSERVED).count() == 66


def test_holdout_mae_matches_published(spark):
    c = {r["model"]: r["holdout_mae"] for r in tr.forecast_compare(annual(spark), holdout=3).collect()}
    assert math.isclose(c[tr.NAIVE], MAE_NAIVE, rel_tol=1e-12)
    assert math.isclose(c[tr.LINEAR], MAE_LINEAR, rel_tol=1e-9)


def test_forecast_per_group(spark):
    a = annual(spark)
    two = a.withColumn("g", F.lit("a")).unionByName(a.withColumn("g", F.lit("b")))
    c = tr.forecast_compare(two, holdout=3, group_cols=["g"]).collect()
    assert len(c) == 4
    assert all(math.isclose(r["holdout_mae"], MAE_NAIVE if r["model"] == tr.NAIVE else MAE_LINEAR,
                            rel_tol=1e-9) for r in c)


def test_recognition_rate(spark):
    # Year 2000 recognized and final decision totals, published rate.
    df = spark.createDataFrame(
        [(2000, 1093045.0, 203402.0, 543635.0, 93522.0, 249787.0, 1090346.0)],
        "year int, applications_observed double, recognized_observed double, rejected_observed double, "
        "other_decisions_observed double, otherwise_closed_observed double, total_decisions_reported double")
    r = fl.asylum_by_year(df).first()
    assert r["recognition_rate_observed"] == 0.18654812325628745


def test_role_classes(spark):
    rows = [
        # both roles, host only, origin only
        (2016, "Refugees", 10.0, "Aa", "Bb"),
        (2016, "Refugees", 5.0, "Bb", "Aa"),
        (2016, "Refugees", 3.0, "Cc", "Bb"),
    ]
    ddl = ("year int, population_type_std string, value_observed double, origin_country_std string, "
           "host_country_std string")
    df = spark.createDataFrame(rows, ddl)
    for role in ("origin", "host"):
        df = (df.withColumn(f"{role}_iso3", F.upper(F.col(f"{role}_country_std")))
              .withColumn(f"{role}_mapping_status", F.lit("manual_iso"))
              .withColumn(f"{role}_map_eligible_flag", F.lit(True)))
    got = {r["country"]: r["role_class"] for r in st.role_scatter(df).collect()}
    assert got == {"Aa": "both_origin_and_host", "Bb": "both_origin_and_host", "Cc": "mostly_origin"}
    df2 = df.filter(F.col("origin_country_std") != "Bb")
    got2 = {r["country"]: r["role_class"] for r in st.role_scatter(df2).collect()}
    assert got2["Bb"] == "mostly_host" and got2["Aa"] == "mostly_origin"


# Published annual asylum-seeker totals 2000-2016 and the
# published year-on-year changes of that series (absolute, fraction).
ASYLUM = [947926.0, 943980.0, 1093824.0, 996488.0, 885249.0, 802174.0, 741291.0, 741110.0, 825043.0,
          989169.0, 837445.0, 897021.0, 942797.0, 1164450.0, 1804465.0, 3224966.0, 2716578.0]
YOY_2001 = (-3946.0, -0.004162772199517661)
YOY_2015 = (1420501.0, 0.7872144929383502)
YOY_2016 = (-508388.0, -0.15764135187781825)

# Published June application totals 1999-2016 (18 values; the
# partial last year has no June) and the published June profile.
JUNE = [47922.0, 41815.0, 47263.0, 44675.0, 36300.0, 30140.0, 25779.0, 20773.0, 23105.0, 27676.0,
        30711.0, 28627.0, 36821.0, 37141.0, 48856.0, 65029.0, 123299.0, 144573.0]
JUNE_PROFILE = (47805.833333333336, 36981.0, 144573.0)


def test_yoy_matches_published(spark):
    rows = [(2000 + i, "Asylum-seekers", v, False, False, False) for i, v in enumerate(ASYLUM)]
    df = spark.createDataFrame(rows, "year int, population_type_std string, value_observed double, "
                                     "value_is_redacted boolean, value_is_blank boolean, value_is_zero boolean")
    got = {r["year"]: r for r in st.annual_population_yoy(df).collect()}
    assert got[2000]["yoy_absolute_change"] is None and got[2000]["yoy_pct_change"] is None
    for y, (a, p) in ((2001, YOY_2001), (2015, YOY_2015), (2016, YOY_2016)):
        assert got[y]["yoy_absolute_change"] == a
        assert math.isclose(got[y]["yoy_pct_change"], p, rel_tol=1e-15)


def test_seasonality_matches_published(spark):
    monthly = spark.createDataFrame([(1999 + i, 6, "June", v) for i, v in enumerate(JUNE)],
                                    "year int, month_num int, month string, applications_observed double")
    r = fl.seasonality_profile(monthly).first()
    assert math.isclose(r["mean_applications"], JUNE_PROFILE[0], rel_tol=1e-15)
    assert r["median_applications"] == JUNE_PROFILE[1]
    assert r["max_applications"] == JUNE_PROFILE[2]
