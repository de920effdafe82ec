"""The corridor table: bucketed by (origin, host), so pair lags need no shuffle."""

import pytest
from pyspark.sql import functions as F

from conftest import SF_SMALL
from flowatlas.operators import spatial as sp
from flowatlas.operators.cube import CORRIDOR_BUCKETS, build_corridors
from flowatlas.plans.spatial_plans import F_ALL
from flowatlas.sources import bucketed
from flowatlas.sources.catalog import catalog


def _exchanges_below_pair_window(node, below=False, found=None, windows=None):
    """(exchanges of rows below a window over origin and host, such windows)."""
    found, windows = ([], []) if found is None else (found, windows)
    name, text = node.nodeName(), node.toString().splitlines()[0]
    if name == "Window" and "[origin#" in text and "host#" in text.split("[origin#")[1][:20]:
        windows.append(text)
        below = True
    if below and "Exchange" in name and "Broadcast" not in name:
        found.append(text)
    if name == "AdaptiveSparkPlan":
        _exchanges_below_pair_window(node.initialPlan(), below, found, windows)
    for i in range(node.children().size()):
        _exchanges_below_pair_window(node.children().apply(i), below, found, windows)
    return found, windows


def pair_lags(df):
    return _exchanges_below_pair_window(df._jdf.queryExecution().executedPlan())


def test_pair_window_without_exchange(spark):
    cat = catalog(spark, SF_SMALL)
    cent = cat.view("centroid")
    found, windows = pair_lags(sp.corridor_year_for(cat.corridors(), cent, F_ALL))
    assert windows and not found, found
    # the check sees the shuffle that the cube needs
    found, windows = pair_lags(sp.corridor_year_for(cat.cube(), cent, F_ALL))
    assert windows and found


@pytest.mark.parametrize("end", [None, "origin", "host"])
def test_same_rows_as_cube_and_cells(spark, end):
    cat = catalog(spark, SF_SMALL)
    cent = cat.view("centroid")
    f = F_ALL
    if end:
        f = F_ALL.with_(**{end: sp.corridor_year_for(cat.cube(), cent, F_ALL).agg(F.min(end)).first()[0]})
    got, cube, cells = (sorted(map(tuple, sp.corridor_year_for(t, cent, f).collect()))
                        for t in (cat.corridors(), cat.cube(), cat.stock()))
    assert got and got == cube and got == cells


def test_lag_before_centroids_keeps_rows(spark):
    """A pair without a centroid, a gap year and a non-positive year: as by hand."""
    rows = [(2000, "Refugees", "A", "B", 5.0), (2001, "Refugees", "A", "B", 7.0), (2003, "Refugees", "A", "B", 1.0),
            (2000, "Refugees", "A", "C", 2.0), (2001, "Refugees", "A", "C", 0.0), (2002, "Refugees", "A", "C", 4.0),
            (2000, "Refugees", "X", "B", 9.0), (2001, "Refugees", "X", "B", 9.0), (None, "Refugees", "A", "B", 3.0),
            (2001, "Refugees", None, "B", 3.0), (2001, "Refugees", "A", None, 3.0), (2001, "Refugees", "A", "B", None)]
    df = spark.createDataFrame(rows, "year int, population_type_std string, origin_country_std string, "
                                     "host_country_std string, value_observed double")
    cent = spark.createDataFrame([("A", 0.0, 0.0), ("B", 1.0, 1.0), ("C", 2.0, 2.0)], "country_std string, lat double, lon double")
    want = {(2000, "A", "B"): (5.0, 0.0, 0.0, 0.0), (2001, "A", "B"): (7.0, 5.0, 7.0, 5.0), (2003, "A", "B"): (1.0, 0.0, 4.0, 0.0),
            (2000, "A", "C"): (2.0, 0.0, 0.0, 0.0), (2002, "A", "C"): (4.0, 0.0, 7.0, 0.0)}
    for t in (df, build_corridors(df)):
        got = {(r.year, r.origin, r.host): (r.value_observed, r.previous_year_flow, r.origin_total_previous_year,
                                            r.host_total_previous_year) for r in sp.corridor_year(t, cent).collect()}
        assert got == want


def test_round_trip(spark, tmp_path):
    b = bucketed.Buckets(3, ("k", "l"), ("k", "v"))
    df = spark.range(1000).select((F.col("id") % 7).cast("string").alias("k"), (F.col("id") % 5).alias("l"), F.col("id").alias("v"))
    df = df.unionByName(spark.createDataFrame([(None, None, 1), (None, 2, None)], "k string, l long, v long"))
    path = f"file:{tmp_path}/it's here"
    bucketed.write(bucketed.deal(df, b), path, b)
    back = bucketed.read(spark, df.schema, path, b)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)
    grouped = back.groupBy("k", "l").agg(F.sum("v").alias("s"))
    assert "Exchange" not in grouped._jdf.queryExecution().executedPlan().toString()
    assert bucketed.read(spark, df.schema, path, b).count() == 1002  # declared twice
    files = [f for f in back.inputFiles()]
    assert len(files) == 3
    empty = f"file:{tmp_path}/empty"
    bucketed.write(bucketed.deal(df.limit(0), b), empty, b)
    assert bucketed.read(spark, df.schema, empty, b).count() == 0


def test_published_once(spark):
    cat = catalog(spark, SF_SMALL)
    cat.corridors()
    assert len(cat.corridors().inputFiles()) <= CORRIDOR_BUCKETS.n
    assert catalog(spark, SF_SMALL).corridors() is cat.corridors()
