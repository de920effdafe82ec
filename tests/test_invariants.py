"""Invariants that hold on any data, checked on the smallest driver data,
plus model determinism and quality on a panel with a known signal."""

import math
import random

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowatlas.operators import model as ml
from flowatlas.operators import select as sel
from flowatlas.operators import stock as st
from flowatlas.operators.clean import melt_population_types
from flowatlas.operators.spatial import feature_matrix
from flowatlas.plans.spatial_plans import corridor_year_df
from flowatlas.schemas import Filters
from flowatlas.sources.catalog import catalog

import __spark_entry__ as E

Q = E.queries()


@pytest.fixture(scope="module")
def stock(spark):
    return catalog(spark, SF_SMALL).stock()


def test_band_shares_sum_to_one(spark):
    for r in Q["distance_mix"](spark, SF_SMALL).groupBy("year").agg(F.sum("share").alias("s")).collect():
        assert math.isclose(r["s"], 1.0, rel_tol=1e-12)


def test_entity_shares_sum_to_one(spark, stock):
    d = sel.filter_selection(stock, Filters())
    s = st.rank_entities(d, "host", 10**6).agg(F.sum("share")).first()[0]
    # entities with a non-positive total are not ranked, so the sum is <= 1
    assert 0.99 < s <= 1.0 + 1e-12


def test_hhi_bounds(spark):
    for r in Q["concentration_by_year"](spark, SF_SMALL).collect():
        assert 1.0 / r["countries"] - 1e-12 <= r["hhi"] <= 1.0 + 1e-12
        assert r["top1_share"] <= r["top5_share"] <= 1.0 + 1e-12


def test_kpi_parts_add_up(spark, stock):
    k = Q["kpis"](spark, SF_SMALL).first()
    others = (sel.filter_selection(stock, Filters()).filter(F.col("population_type_std") == "Others of concern")
              .agg(F.coalesce(F.sum("value_observed"), F.lit(0.0))).first()[0])
    assert math.isclose(k["refugees"] + k["asylum"] + others, k["total"], rel_tol=1e-12)


def test_network_in_equals_out(spark):
    r = Q["network_metrics"](spark, SF_SMALL).agg(F.sum("in_strength"), F.sum("out_strength")).first()
    assert r[0] == r[1] and r[0] > 0


def test_no_row_loss_and_gate(spark):
    assert Q["check_no_row_loss"](spark, SF_SMALL).first()["status"] == "PASS"
    gate = Q["quality_gate"](spark, SF_SMALL).collect()
    assert not any(r["blocks_pipeline"] for r in gate)


def test_audits_cover_every_dataset(spark):
    audited = {(r["dataset"], r["column"]): r for r in Q["audit_numeric_quality_all"](spark, SF_SMALL).collect()}
    for t in ("raw_stock", "stock", "decisions", "apps_monthly", "resettlement", "poc_wide", "demographics_wide"):
        df = catalog(spark, SF_SMALL).view(t)
        measures = ["Value"] if t == "raw_stock" else [c for c, k in df.dtypes if k == "double"]
        assert measures and {c for d, c in audited if d == t} == {"Year", *measures}
        assert {audited[t, c]["rows"] for c in measures} == {df.count()}
    assert audited["decisions", "total_decisions_reported"]["blank_rows"] > 0
    checks = {r["check"] for r in Q["quality_gate_all"](spark, SF_SMALL).collect()}
    assert {r["check"] for r in Q["quality_gate"](spark, SF_SMALL).collect()} < checks
    assert "no_negative_observed_values__demographics_wide" in checks


def test_long_equals_wide(spark):
    cat = catalog(spark, SF_SMALL)
    wide = cat.view("poc_wide")
    long = melt_population_types(wide, ["year", "origin_country_std", "host_country_std"])
    cols = [c for c in wide.columns if c not in ("year", "origin_country_std", "host_country_std")]
    w = wide.agg(*[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in cols]).first()
    assert math.isclose(sum(w), long.agg(F.sum("value_observed")).first()[0], rel_tol=1e-12)
    assert all(r["absolute_difference"] == 0 for r in Q["crosscheck_sources"](spark, SF_SMALL).collect())


def test_uncertainty_ordering_and_shares(spark):
    rows = Q["distance_uncertainty"](spark, SF_SMALL).collect()
    assert len(rows) == 3
    for r in rows:
        assert 0.0 <= r["p10"] <= r["p50"] <= r["p90"] <= 1.0
    mix = Q["distance_mix_actual_vs_predicted"](spark, SF_SMALL).collect()
    for series in ("Actual observed", "ML predicted"):
        s = [r["share"] for r in mix if r["series"] == series]
        assert len(s) == 3 and math.isclose(sum(s), 1.0, rel_tol=1e-9)


def test_similarity_shape(spark):
    rows = Q["corridor_similarity"](spark, SF_SMALL).collect()
    assert len(rows) >= 10
    assert all(math.isfinite(r["component_1"]) and math.isfinite(r["component_2"]) for r in rows)


def _panel(spark, seed=7):
    rnd = random.Random(seed)
    rows = []
    for p in range(40):
        base = rnd.uniform(2, 10)
        km = rnd.uniform(100, 8000)
        band = "Near (<1,000 km)" if km < 1000 else ("Regional (1,000–3,000 km)" if km < 3000 else "Far (>3,000 km)")
        prev = 0.0
        for y in range(2000, 2012):
            tgt = 0.8 * prev + 0.2 * base + rnd.gauss(0, 0.05) if prev else base
            rows.append((y, f"o{p}", f"h{p}", km, band, math.expm1(tgt), prev, prev + 1.0, prev + 2.0, tgt))
            prev = tgt
    return spark.createDataFrame(rows, "year int, origin string, host string, distance_km double, "
                                 "distance_band string, value_observed double, prev_flow_log double, "
                                 "origin_prev_total_log double, host_prev_total_log double, target_log_flow double")


def test_forest_learns_known_signal_and_is_deterministic(spark):
    cy = _panel(spark)
    b1 = ml.fit_forest(cy, n_trees=20, seed=42)
    b2 = ml.fit_forest(cy, n_trees=20, seed=42)
    assert b1.ok and b1.test_rows == 120
    m = ml.model_metrics(b1, cy).first()
    assert m["r2"] > 0.5
    p1 = [r["prediction"] for r in ml._predict(b1, cy).orderBy("year", "origin").collect()]
    p2 = [r["prediction"] for r in ml._predict(b2, cy).orderBy("year", "origin").collect()]
    assert p1 == p2


def test_forest_on_driver_data_runs(spark):
    cy = corridor_year_df(spark, SF_SMALL)
    g = ml.train_gates(cy).first()
    assert g["ok"], g["reason"]


def test_forest_save_and_load_round_trip(spark, tmp_path):
    cy = _panel(spark)
    b = ml.fit_forest(cy, n_trees=5, seed=42)
    path = str(tmp_path / "forest")
    ml.save_forest(b, path)
    b2 = ml.load_forest(path, b.train_rows, b.test_rows)
    p1 = [r["prediction"] for r in ml._predict(b, cy).orderBy("year", "origin").collect()]
    p2 = [r["prediction"] for r in ml._predict(b2, cy).orderBy("year", "origin").collect()]
    assert p1 == p2


def test_similarity_matches_brute_force(spark):
    """z-scores (population std) and 2 principal components, against numpy
    on the same top corridor-years; signs fixed by the largest loading."""
    import numpy as np
    from flowatlas.schemas import DISTANCE_BANDS, NUMERIC_FEATURES

    cy = corridor_year_df(spark, SF_SMALL)
    got = {(r["year"], r["origin"], r["host"]): (r["component_1"], r["component_2"])
           for r in ml.corridor_similarity(cy, 300).collect()}
    pdf = cy.toPandas().sort_values(["value_observed", "year", "origin", "host"],
                                    ascending=[False, True, True, True]).head(300)
    x = np.column_stack([pdf[c].astype(float).to_numpy() for c in NUMERIC_FEATURES]
                        + [(pdf["distance_band"] == b).astype(float).to_numpy() for b in DISTANCE_BANDS])
    sd = x.std(axis=0)
    z = np.where(sd > 0, (x - x.mean(axis=0)) / np.where(sd > 0, sd, 1), 0.0)
    vals, vecs = np.linalg.eigh(np.cov(z, rowvar=False))
    pcs = vecs[:, np.argsort(vals)[::-1][:2]]
    for j in range(2):
        if pcs[np.abs(pcs[:, j]).argmax(), j] < 0:
            pcs[:, j] = -pcs[:, j]
    proj = z @ pcs
    assert len(got) == 300
    for (y, o, h), p in zip(pdf[["year", "origin", "host"]].itertuples(index=False), proj):
        c1, c2 = got[(y, o, h)]
        assert math.isclose(c1, p[0], abs_tol=1e-6) and math.isclose(c2, p[1], abs_tol=1e-6)


def test_prediction_tables_match_brute_force(spark):
    """Top destinations and the actual-vs-predicted band mix, recomputed in
    pandas from the scored corridors."""
    pred = Q["predict_corridors"](spark, SF_SMALL).toPandas()
    by_host = pred.groupby("host")[["actual_value", "predicted_value"]].sum()
    by_host["score"] = by_host.max(axis=1)
    want = by_host.reset_index().sort_values(["score", "host"], ascending=[False, True]).head(10)
    got = Q["top_destinations"](spark, SF_SMALL).toPandas()
    assert set(got.host) == set(want.host)
    for h, a, p in want[["host", "actual_value", "predicted_value"]].itertuples(index=False):
        g = got[got.host == h].set_index("series").people
        assert math.isclose(g["Actual observed"], a, rel_tol=1e-9)
        assert math.isclose(g["ML predicted"], p, rel_tol=1e-9)
    mix = Q["distance_mix_actual_vs_predicted"](spark, SF_SMALL).toPandas()
    for series, col in (("Actual observed", "actual_value"), ("ML predicted", "predicted_value")):
        tot = pred[col].sum()
        for band, v in pred.groupby("distance_band")[col].sum().items():
            row = mix[(mix.series == series) & (mix.distance_band == band)].iloc[0]
            assert math.isclose(row["value"], v, rel_tol=1e-9)
            assert math.isclose(row["share"], v / tot, rel_tol=1e-9)


def test_uncertainty_matches_brute_force(spark):
    """Per-tree band shares and their p10/p50/p90, recomputed on the driver
    from each tree's own predictions (test-sized data only)."""
    import numpy as np
    from flowatlas.plans.model_plans import _pred
    from flowatlas.schemas import DISTANCE_BANDS

    b, pred = _pred(spark, SF_SMALL)
    rows = (ml.assembler().transform(feature_matrix(pred.drop("prediction")))
            .select("distance_band", "features").collect())
    shares = {band: [] for band in DISTANCE_BANDS}
    for t in b.forest.trees[:80]:
        v = {band: 0.0 for band in DISTANCE_BANDS}
        for r in rows:
            v[r["distance_band"]] += max(math.expm1(t.predict(r["features"])), 0.0)
        tot = sum(v.values())
        for band in DISTANCE_BANDS:
            shares[band].append(v[band] / tot if tot > 0 else 0.0)
    got = {r["distance_band"]: r for r in ml.distance_uncertainty(b, pred, 80).collect()}
    for band in DISTANCE_BANDS:
        q = np.quantile(shares[band], [0.1, 0.5, 0.9])
        assert math.isclose(got[band]["p10"], q[0], abs_tol=1e-9)
        assert math.isclose(got[band]["p50"], q[1], abs_tol=1e-9)
        assert math.isclose(got[band]["p90"], q[2], abs_tol=1e-9)


def test_cube_re_aggregates_the_cells_exactly(spark, stock):
    cube = catalog(spark, SF_SMALL).cube()
    c = cube.agg(F.sum("value_observed"), F.sum("source_rows"), F.sum("observed_rows"),
                 F.sum("redacted_rows"), F.sum("zero_rows")).first()
    s = stock.agg(F.sum("value_observed"), F.count(F.lit(1)), F.count("value_observed"),
                  F.count_if("value_is_redacted"), F.count_if("value_is_zero")).first()
    assert tuple(c) == tuple(s)
    assert cube.count() < stock.count()
