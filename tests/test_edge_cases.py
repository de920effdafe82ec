"""Hand-made edge fixtures (a few rows each) for the semantics that are easy
to get wrong: null keys, all-null sums, ties, gap years, band edges,
centroid-less ends, zero totals, empty selections, filter precedence,
year fallback, model gates and non-finite values in nested columns."""

import math

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowatlas.functions.columns import distance_band, haversine_km
from flowatlas.operators import audit as au
from flowatlas.operators import model as ml
from flowatlas.operators import select as sel
from flowatlas.operators import spatial as sp
from flowatlas.operators import stock as st
from flowatlas.operators.clean import clean_measure, protect_literal_na, reconcile_decision_total
from flowatlas.schemas import BAND_FAR, BAND_NEAR, BAND_REGIONAL, Filters
from flowatlas.sources import sinks
from flowatlas.sources.catalog import scan_first_available
from flowatlas.sources.sinks import nullify_non_finite

STOCK_DDL = ("year int, population_type_std string, value_observed double, "
             "origin_country_std string, origin_iso3 string, origin_mapping_status string, "
             "origin_map_eligible_flag boolean, host_country_std string, host_iso3 string, "
             "host_mapping_status string, host_map_eligible_flag boolean")


def stock_rows(spark, rows):
    full = []
    for r in rows:
        y, t, v, o, h = r[:5]
        h_iso = r[5] if len(r) > 5 else (None if h is None else h[:3].upper())
        h_status = r[6] if len(r) > 6 else "manual_iso"
        full.append((y, t, v, o, None if o is None else o[:3].upper(), "manual_iso", True,
                     h, h_iso, h_status, True))
    return spark.createDataFrame(full, STOCK_DDL)


def test_null_keys_dropped_and_all_null_sum_is_zero(spark):
    df = stock_rows(spark, [
        (2000, "Refugees", 5.0, "Aa", "Bb"),
        (2000, "Refugees", None, "Aa", "Cc"),
        (2000, "Refugees", 7.0, "Aa", None, "XXX"),
    ])
    t = st.trend_by_type(df, Filters(year=None))
    assert t.collect()[0]["value_observed"] == 12.0
    r = st.rank_entities(df, "host", 10).collect()
    assert [x["host_country_std"] for x in r] == ["Bb"]  # null name and all-null host dropped
    k = st.kpis(df.filter("value_observed IS NULL"), Filters(year=None)).collect()[0]
    assert k["total"] == 0.0 and k["refugees"] == 0.0


def test_null_mapping_status_kept_and_special_entity_dropped(spark):
    df = stock_rows(spark, [
        (2000, "Refugees", 5.0, "Aa", "Bb", "BBB", None),
        (2000, "Refugees", 6.0, "Aa", "Cc", "X_C", "special_entity"),
        (2000, "Refugees", 7.0, "Aa", "Dd", "UNMAPPED", "unmapped"),
    ])
    names = {r["host_country_std"] for r in sel.clean_entities(df, "host").collect()}
    assert names == {"Bb"}


def test_tie_at_top_n_edge_is_broken_by_name(spark):
    df = stock_rows(spark, [(2000, "Refugees", 5.0, "Aa", h) for h in ("Zz", "Bb", "Mm")])
    r = st.rank_entities(df, "host", 2).collect()
    assert [x["host_country_std"] for x in r] == ["Bb", "Mm"]
    assert [x["rank"] for x in r] == [1, 2]
    assert all(math.isclose(x["share"], 1 / 3) for x in r)  # share of all, not of top n


def test_self_corridor_kept(spark):
    df = stock_rows(spark, [(2000, "Refugees", 5.0, "Aa", "Aa")])
    assert st.corridors(df, 5).count() == 1


def test_origin_beats_crisis_and_unknown_crisis_is_no_filter(spark):
    df = stock_rows(spark, [(2000, "Refugees", 1.0, "NATION_9", "Bb"),
                            (2000, "Refugees", 1.0, "NATION_3", "Bb")])
    f = Filters(year=None, crisis="Crisis 1", origin="NATION_3")
    assert [r["origin_country_std"] for r in sel.filter_selection(df, f).collect()] == ["NATION_3"]
    assert sel.filter_selection(df, Filters(year=None, crisis="Crisis 1")).count() == 1
    assert sel.filter_selection(df, Filters(year=None, crisis="No such crisis")).count() == 2


def test_empty_selection(spark):
    df = stock_rows(spark, [(2000, "Refugees", 1.0, "Aa", "Bb")])
    f = Filters(year=1990)
    assert st.rank_entities(sel.filter_selection(df, f), "host", 5).count() == 0
    lp = st.leading_pair(sel.filter_selection(df, f)).collect()[0]
    assert (lp["origin_name"], lp["host_name"]) == ("-", "-")


def test_zero_total_share_is_null(spark):
    df = stock_rows(spark, [(2000, "Refugees", 0.0, "Aa", "Bb")])
    assert st.rank_entities(df, "host", 5).count() == 0  # positives only
    mix = sp.distance_mix(spark.createDataFrame(
        [(2000, BAND_NEAR, 0.0)], "year int, distance_band string, value_observed double")).collect()
    assert len(mix) == 3 and all(r["share"] is None for r in mix)


def test_gap_year_lag_is_exact_previous_year(spark):
    cent = spark.createDataFrame([("A", 0.0, 0.0), ("B", 0.0, 1.0)], "country_std string, lat double, lon double")
    df = stock_rows(spark, [(1, "Refugees", 10.0, "A", "B"), (2, "Refugees", 20.0, "A", "B"),
                            (4, "Refugees", 40.0, "A", "B")])
    cy = {r["year"]: r for r in sp.corridor_year(df, cent).collect()}
    assert cy[1]["previous_year_flow"] == 0.0
    assert cy[2]["previous_year_flow"] == 10.0
    assert cy[4]["previous_year_flow"] == 0.0  # 3 is absent: not the previous row
    assert cy[4]["origin_total_previous_year"] == 0.0


def test_pair_without_centroid_dropped(spark):
    cent = spark.createDataFrame([("A", 0.0, 0.0)], "country_std string, lat double, lon double")
    df = stock_rows(spark, [(1, "Refugees", 10.0, "A", "B"), (1, "Refugees", 10.0, "A", "A")])
    assert [(r["origin"], r["host"]) for r in sp.corridor_year(df, cent).collect()] == [("A", "A")]


@pytest.mark.parametrize("km,band", [(999.99, BAND_NEAR), (1000.0, BAND_REGIONAL),
                                      (2999.99, BAND_REGIONAL), (3000.0, BAND_FAR)])
def test_band_edges(spark, km, band):
    assert spark.range(1).select(distance_band(F.lit(km))).first()[0] == band


def test_haversine_known_distance(spark):
    # one degree of longitude on the equator
    d = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(1.0))).first()[0]
    assert math.isclose(d, 2 * math.pi * 6371.0 / 360, rel_tol=1e-12)


def test_year_fallback(spark):
    df = spark.createDataFrame([(1999,), (2001,)], "year int")
    assert sel.year_fallback(df, 1999).first()[0] == 1999
    assert sel.year_fallback(df, 2005).first()[0] == 2001


def test_clean_measure_flags(spark):
    df = spark.createDataFrame([(x,) for x in ["*", "", None, "-5", "n/a", "0", " 12 ", "NaN"]], "v string")
    rows = clean_measure(df, "v", "m").collect()
    by = {r["v"]: r for r in rows}
    assert by["*"]["m_is_redacted"] and by["*"]["m_observed"] is None
    assert by[""]["m_is_blank"] and by[None]["m_is_blank"]
    assert by["-5"]["m_is_negative_raw"] and by["-5"]["m_observed"] is None
    assert by["n/a"]["m_is_non_numeric"]
    assert by["0"]["m_is_zero"] and by["0"]["m_observed"] == 0.0
    assert by[" 12 "]["m_observed"] == 12.0
    assert by["NaN"]["m_observed"] is None and by["NaN"]["m_is_non_numeric"]


def test_literal_na_stage(spark):
    df = spark.createDataFrame([("G / NA",), ("U / AR",)], "p string")
    got = {r["p"]: (r["procedure"], r["stage"]) for r in protect_literal_na(df, "p").collect()}
    assert got == {"G / NA": ("G", "NEW"), "U / AR": ("U", "AR")}


def test_reconcile_total(spark):
    df = spark.createDataFrame([(None, 1.0, 2.0, 0.0, 0.0), (5.0, 1.0, 2.0, 0.0, 0.0), (3.0, 1.0, 2.0, 0.0, 0.0)],
                               "total_decisions_reported double, recognized_observed double, rejected_observed double, "
                               "other_decisions_observed double, otherwise_closed_observed double")
    rows = reconcile_decision_total(df).collect()
    assert [r["total_decisions_final"] for r in rows] == [3.0, 5.0, 3.0]
    assert [r["decision_total_mismatch_flag"] for r in rows] == [False, True, False]


def test_model_gates(spark):
    small = spark.createDataFrame([(2000 + i % 3, 1.0) for i in range(20)], "year int, value_observed double")
    g = ml.train_gates(small).first()
    assert not g["ok"] and g["reason"] == ml.REASON_ROWS
    few_years = spark.createDataFrame([(2000 + i % 4, 1.0) for i in range(100)], "year int, value_observed double")
    assert ml.train_gates(few_years).first()["reason"] == ml.REASON_YEARS
    ok = spark.createDataFrame([(2000 + i % 10, 1.0) for i in range(100)], "year int, value_observed double")
    g = ml.train_gates(ok).first()
    assert g["ok"] and g["test_rows"] == 30 and g["train_rows"] == 70


def test_nullify_non_finite_nested(spark):
    df = spark.createDataFrame(
        [(float("nan"), float("inf"), [1.0, float("nan")], (float("-inf"), 2.0), "x")],
        "a double, b double, c array<double>, d struct<p: double, q: double>, s string")
    r = nullify_non_finite(df).first()
    assert r["a"] is None and r["b"] is None
    assert r["c"] == [1.0, None]
    assert r["d"]["p"] is None and r["d"]["q"] == 2.0
    assert r["s"] == "x"


def test_feature_scope_selection_vs_scope(spark):
    cent = spark.createDataFrame([("A", 0.0, 0.0), ("B", 0.0, 1.0), ("C", 1.0, 0.0)],
                                 "country_std string, lat double, lon double")
    df = stock_rows(spark, [(1, "Refugees", 10.0, "A", "C"), (1, "Refugees", 5.0, "B", "C"),
                            (2, "Refugees", 20.0, "A", "C"), (2, "Refugees", 7.0, "B", "C")])
    f = Filters(year=None, origin="A")
    sel_cy = {r["year"]: r for r in sp.corridor_year_for(df, cent, f, "selection").collect()}
    scope_cy = {r["year"]: r for r in sp.corridor_year_for(df, cent, f, "scope").collect()}
    assert sel_cy[2]["host_total_previous_year"] == 10.0      # only the selected corridor
    assert scope_cy[2]["host_total_previous_year"] == 15.0    # every origin into C
    assert {r["origin"] for r in scope_cy.values()} == {"A"}


def test_scan_first_available_gzip_csv_and_fallbacks(spark, tmp_path):
    from flowatlas.schemas import STOCK_SCHEMA
    from flowatlas.sources import sinks
    from flowatlas.sources.catalog import scan_first_available
    df = stock_rows(spark, [(2000, "Refugees", 5.0, "Aa", "Bb"), (2001, "IDPs", None, "Cc", "Bb")])
    full = df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in STOCK_SCHEMA])
    gz = str(tmp_path / "time_series_clean.csv.gz")
    sinks.write_csv(full, gz, compression="gzip")
    got = scan_first_available(spark, [str(tmp_path / "stock.parquet"), gz], STOCK_SCHEMA, required=True)
    assert sorted(tuple(r) for r in got.collect()) == sorted(tuple(r) for r in full.collect())
    empty = scan_first_available(spark, [str(tmp_path / "missing.parquet")], STOCK_SCHEMA)
    assert empty.count() == 0 and empty.schema == STOCK_SCHEMA
    with pytest.raises(FileNotFoundError):
        scan_first_available(spark, [str(tmp_path / "missing.parquet")], STOCK_SCHEMA, required=True)


def test_only_gzip_reads_are_rebalanced(spark, tmp_path):
    """A gzip candidate is one task's read: an exchange above it deals its rows out; filters still reach the scan."""
    plain, gz, pq = (str(tmp_path / n) for n in ("t.csv", "t.csv.gz", "t.parquet"))
    rows = spark.range(50).selectExpr("cast(id AS string) AS k", "'x' AS v")
    rows.write.parquet(pq)
    sinks.write_csv(rows, plain)
    sinks.write_csv(rows, gz, compression="gzip")
    schema = T.StructType([T.StructField("k", T.LongType()), T.StructField("v", T.StringType())])
    plans = {}
    for name, path in (("plain", plain), ("gz", gz), ("pq", pq)):
        df = scan_first_available(spark, [str(tmp_path / "none"), path], None if name == "pq" else schema).filter("k > 40")
        plans[name] = df._jdf.queryExecution().executedPlan().toString()
        assert df.count() == 9
    assert "Exchange" in plans["gz"] and "GreaterThan(k,40)" in plans["gz"].split("PushedFilters")[1]
    assert "Exchange" not in plans["plain"] and "Exchange" not in plans["pq"]


def test_labels_of_several_tables_are_resolved_once(spark):
    cmap = spark.createDataFrame([("A", "Aland", "AAA", "manual_iso", True), ("A", "Other", "OOO", "manual_iso", True),
                                  ("B", "Bland", "BBB", None, None), (None, "Null", "NNN", "manual_iso", True)],
                                 "label_key string, country_std string, iso3 string, mapping_status string, map_eligible_flag boolean")
    t = spark.createDataFrame([("a", "b"), (" A ", None), ("a", "zz"), (None, "  ")], "o string, h string")
    u = spark.createDataFrame([("zz",)] * 3, "h string")
    labels = au.country_labels(t, "t", {"origin": "o", "host": "h"}).unionByName(au.country_labels(u, "u", {"host": "h"}))
    labels = labels.unionByName(au.country_labels(u.limit(0), "empty", {"host": "h"}))
    got = au.resolve_labels(labels, cmap)
    assert got.agg(F.sum("rows")).first()[0] == 11  # no row lost, none twice
    assert {(r.dataset, r.country_role, r.mapping_status, r.map_eligible_flag): (r.rows, r.labels)
            for r in au.audit_label_mapping(got).collect()} == {
        ("t", "origin", "manual_iso", True): (3, 2), ("t", "origin", "missing", False): (1, 1),
        ("t", "host", None, None): (1, 1), ("t", "host", "missing", False): (2, 2),
        ("t", "host", "unmapped", False): (1, 1), ("u", "host", "unmapped", False): (3, 1)}
    assert {tuple(r) for r in au.unmapped_labels(got).collect()} == {("t", "host", "zz", 1), ("u", "host", "zz", 3)}


def test_filter_options_document_round_trip(spark):
    import json
    stock = spark.createDataFrame([(2001, "P", "A", "B"), (2003, None, "A", None)],
                                  "year int, population_type_std string, origin_country_std string, host_country_std string")
    monthly = spark.createDataFrame([(1999, "B")], "year int, host_country_std string")
    doc = sel.filter_options_document(stock, {"stock": stock, "monthly": monthly, "none": monthly.limit(0)})
    text = json.loads(doc.first()[0])
    assert text["years"] == [2001, 2003] and (text["all_dataset_year_min"], text["all_dataset_year_max"]) == (1999, 2003)
    assert list(text["dataset_coverage"]) == ["monthly", "none", "stock"]
    assert {r.dataset: tuple(r)[1:] for r in sel.read_coverage(doc).collect()} == {
        "stock": (2, 2001, 2003, [2001, 2003], ["A"], ["B"]), "monthly": (1, 1999, 1999, [1999], None, ["B"]),
        "none": (0, None, None, [], None, [])}
