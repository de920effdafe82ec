"""Two data folders of one name, short series, refused models, odd CSV files."""

import os

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowatlas.operators import clean, model, select, stock, trend
from flowatlas.schemas import CRISIS_ORIGIN, DRIVER_SCHEMAS, Filters
from flowatlas.sources import sinks
from flowatlas.sources.catalog import catalog, scan_table, source_key


def test_folders_of_one_name_have_their_own_silver(spark, tmp_path):
    folder = f"{tmp_path}/sf0.001"
    os.makedirs(folder)
    for t in DRIVER_SCHEMAS:
        src = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        (src.orderBy("l_orderkey", "l_linenumber").limit(50) if t == "lineitem" else src).write.parquet(f"{folder}/{t}.parquet")
    assert catalog(spark, SF_SMALL).stock().count() > 5000
    assert catalog(spark, folder).stock().count() == 50
    before = source_key(spark, folder)
    assert before == source_key(spark, folder + "/") != source_key(spark, SF_SMALL)
    spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").limit(20).write.mode("overwrite").parquet(f"{folder}/lineitem.parquet")
    assert source_key(spark, folder) != before
    assert catalog(spark, folder).stock().count() == 20


@pytest.mark.parametrize("years", [1, 2, 3, 4, 5])
def test_short_series(spark, years):
    rows = [("s", 2000 + i, 10.0 * i) for i in range(years)] + [("l", 2000 + i, 5.0 * i) for i in range(9)]
    a = spark.createDataFrame(rows, "g string, year int, value_observed double")
    fc = trend.trend_forecast(a, 2, 3, ["g"]).filter("series <> 'observed'").collect()
    assert {r.year: r.value_observed for r in fc if r.g == "l"} == {2009: 45.0, 2010: 50.0}
    assert all((r.value_observed is None) == (years < 5) for r in fc if r.g == "s")
    cmp = {(r.g, r.model): r for r in trend.forecast_compare(a, 3, ["g"]).collect()}
    assert cmp["l", trend.LINEAR].holdout_mae == 0.0 and cmp["l", trend.LINEAR].winner == trend.LINEAR
    assert cmp["s", trend.LINEAR].winner == (None if years < 4 else trend.NAIVE if years == 4 else trend.LINEAR)


def test_refused_model_gives_empty_tables(spark):
    from flowatlas.operators.spatial import corridor_year
    s = catalog(spark, SF_SMALL).stock().filter("year = 1996")
    cy = corridor_year(s, catalog(spark, SF_SMALL).view("centroid"))
    b = model.fit_forest(cy, n_trees=3)
    assert not b.ok and b.reason in (model.REASON_ROWS, model.REASON_YEARS)
    p = model.predict_corridors(b, cy)
    assert p.count() == model.feature_importance(b, spark).count() == model.distance_uncertainty(b, p).count() == 0
    assert model.top_destinations(p).count() == 0 and model.model_metrics(b, cy).first()["reason"] == b.reason
    assert p.columns[-2:] == ["predicted_value", "actual_value"]


def test_metrics_of_a_constant_target(spark):
    assert spark.range(3).select(F.try_divide(F.lit(0.0), F.var_pop(F.lit(1.0)) * F.count("id")).alias("r")).first()["r"] is None


def test_top_n_is_the_callers(spark):
    s = catalog(spark, SF_SMALL).cube()
    f = Filters(top_n=30)
    hosts = stock.rank_entities(select.filter_selection(s, f), "host", 30).count()
    assert hosts > 20 and stock.treemap_hosts(select.filter_selection(s, f), 30).count() == hosts + 1
    # the crisis origins have few rows here: rename one large origin
    big = s.groupBy("origin_country_std").agg(F.count_distinct("host_country_std").alias("n")).orderBy(F.desc("n")).first()
    focus = next(iter(CRISIS_ORIGIN))
    renamed = s.withColumn("origin_country_std", F.when(F.col("origin_country_std") == big[0], F.lit(CRISIS_ORIGIN[focus])).otherwise(F.lit("x")))
    routes = stock.crisis_routes(renamed, Filters(top_n=30, scope=f.scope, year=None, crisis=focus)).count()
    assert 12 < routes <= big["n"]


def test_csv_is_bound_by_name_and_kept_verbatim(spark, tmp_path):
    p = f"{tmp_path}/t.csv"
    with open(p, "w") as f:
        f.write("b,extra,a\n  lead ,x,1\nNA,y,2\n")
    rows = scan_table(spark, p, spark.createDataFrame([], "a int, b string").schema).collect()
    assert [(r.a, r.b) for r in rows] == [(1, "  lead "), (2, "NA")]
    with pytest.raises(ValueError, match="no column c"):
        scan_table(spark, p, spark.createDataFrame([], "a int, c string").schema)
    with open(p, "w") as f:
        f.write("a,b\nnot a number,x\n")
    with pytest.raises(Exception, match="(?i)malformed|not a number"):
        scan_table(spark, p, spark.createDataFrame([], "a int, b string").schema).collect()
    df = spark.createDataFrame([(" lead", 1), ("trail ", 2)], "s string, n int")
    assert sorted(r.s for r in sinks.export_chart_table(df, f"{tmp_path}/out.csv").collect()) == [" lead", "trail "]


def test_duplicate_map_key_is_refused(spark):
    raw = spark.createDataFrame([("X",), ("y",), (None,)], "host_raw string")
    schema = "label_key string, country_std string, iso3 string, mapping_status string, map_eligible_flag boolean"
    one = [("X", "Xland", "XXX", "manual_iso", True), ("X", "Xland", "XXX", "manual_iso", True), (None, "n", "n", "n", True)]
    ok = clean.standardise_country(raw, "host", spark.createDataFrame(one, schema)).collect()
    assert sorted(r.host_country_std or "" for r in ok) == ["", "Xland", "y"]
    two = spark.createDataFrame(one + [("X", "Other", "OTH", "manual_iso", True)], schema)
    with pytest.raises(Exception, match="two rows for one"):
        clean.standardise_country(raw, "host", two).collect()


def test_json_guard(spark):
    ok = spark.createDataFrame([(1.0, [2.0, None])], "a double, b array<double>")
    assert sinks.assert_json_safe(ok).collect() == ok.collect()
    for bad in ((float("nan"), [1.0]), (1.0, [float("inf")])):
        with pytest.raises(Exception, match="non-finite"):
            sinks.assert_json_safe(spark.createDataFrame([bad], ok.schema)).collect()
    assert sinks.assert_json_safe(sinks.nullify_non_finite(spark.createDataFrame([bad], ok.schema))).count() == 1
