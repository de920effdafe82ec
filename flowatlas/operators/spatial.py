"""Spatial and previous-year features of corridor-years.

``corridor_year`` is the feature table of the model: one row per
(year, origin, host) with a positive total and a centroid at both ends,
the great-circle distance, its band, and three exact-previous-year lags.

Plan shape: one partial+final aggregation by (year, origin, host); the pair
lag is a range window partitioned by (origin, host) over the *aggregated*
rows; two joins against the centroid dimension (one row per country, a
bounded dimension). Over the catalog's corridor table, which is bucketed by
(origin, host), neither aggregation nor window shuffles. End-point totals are
aggregated per (year, end) - at most countries x years rows - and joined
back. A hot origin never reaches one task with raw rows: every shuffle
carries partial aggregates only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from flowatlas.functions.columns import band_order, distance_band, finite_or_null, haversine_km, share, sum0
from flowatlas.schemas import DISTANCE_BANDS, FEATURE_COLUMNS, NUMERIC_FEATURES

V = "value_observed"


def centroid_join(df: DataFrame, centroid: DataFrame, origin: str = "origin",
                  host: str = "host") -> DataFrame:
    """Attach both ends' coordinates; rows with an end lacking a centroid
    are dropped (inner joins)."""
    o = centroid.select(F.col("country_std").alias(origin), F.col("lat").alias("origin_lat"),
                        F.col("lon").alias("origin_lon"))
    h = centroid.select(F.col("country_std").alias(host), F.col("lat").alias("host_lat"),
                        F.col("lon").alias("host_lon"))
    return df.join(o, origin).join(h, host)


def with_distance(df: DataFrame) -> DataFrame:
    """``distance_km`` and ``distance_band`` from the four coordinates."""
    km = haversine_km("origin_lat", "origin_lon", "host_lat", "host_lon")
    return df.withColumn("distance_km", km).withColumn("distance_band", distance_band("distance_km"))


def corridor_year(df: DataFrame, centroid: DataFrame) -> DataFrame:
    """Corridor-year feature table (see module docstring). Lags are
    computed after dropping non-positive and centroid-less corridors, and
    over whatever selection ``df`` is."""
    base = (df.dropna(subset=["year", "origin_country_std", "host_country_std"])
            .groupBy("year", F.col("origin_country_std").alias("origin"),
                     F.col("host_country_std").alias("host"))
            .agg(sum0(V).alias(V))
            .filter(F.col(V) > 0))
    # exact previous calendar year (a range frame: a gap year gives null,
    # not the previous row's value). A pair lacks a centroid in all years or
    # in none, so its lag can be taken first: rows dealt by pair stay there.
    pair_w = Window.partitionBy("origin", "host").orderBy("year").rangeBetween(-1, -1)
    lagged = base.withColumn("previous_year_flow", F.sum(V).over(pair_w))
    out = with_distance(centroid_join(lagged, centroid))

    def end_prev(end: str, name: str) -> DataFrame:
        tot = out.groupBy("year", end).agg(F.sum(V).alias("_t"))
        w = Window.partitionBy(end).orderBy("year").rangeBetween(-1, -1)
        return tot.select("year", end, F.sum("_t").over(w).alias(name))

    out = (out.join(end_prev("origin", "origin_total_previous_year"), ["year", "origin"], "left")
           .join(end_prev("host", "host_total_previous_year"), ["year", "host"], "left"))
    for c in ("previous_year_flow", "origin_total_previous_year", "host_total_previous_year"):
        out = out.withColumn(c, F.coalesce(F.col(c), F.lit(0.0)))
    return out.select(
        "year", "origin", "host", "distance_km", "distance_band", V,
        "previous_year_flow", "origin_total_previous_year", "host_total_previous_year",
        F.log1p("previous_year_flow").alias("prev_flow_log"),
        F.log1p("origin_total_previous_year").alias("origin_prev_total_log"),
        F.log1p("host_total_previous_year").alias("host_prev_total_log"),
        F.log1p(V).alias("target_log_flow"),
        "origin_lat", "origin_lon", "host_lat", "host_lon")


def corridor_year_for(stock: DataFrame, centroid: DataFrame, f, feature_scope: str = "selection") -> DataFrame:
    """Corridor-years of a selection, all years.

    ``feature_scope="selection"`` (the reference's behaviour): lags and
    end-point totals are computed over the selected rows only, so with an
    origin filter a host's previous-year total shrinks to that corridor.
    ``"scope"``: the table is built over the whole population scope and the
    origin / host / crisis selection is applied afterwards, so the features
    match the ones the model was trained on.
    """
    from flowatlas.operators.select import filter_selection
    from flowatlas.schemas import CRISIS_ALL, crisis_origin
    sel = f.with_(year=None)
    if feature_scope == "selection":
        return corridor_year(filter_selection(stock, sel), centroid)
    if feature_scope != "scope":
        raise ValueError(f"feature_scope must be 'selection' or 'scope', not {feature_scope!r}")
    cy = corridor_year(filter_selection(stock, sel.with_(origin="All", host="All", crisis=CRISIS_ALL)),
                       centroid)
    origin = f.origin if f.origin != "All" else crisis_origin(f.crisis)
    if origin is not None:
        cy = cy.filter(F.col("origin") == F.lit(origin))
    if f.host != "All":
        cy = cy.filter(F.col("host") == F.lit(f.host))
    return cy


def feature_matrix(cy: DataFrame) -> DataFrame:
    """The 8 model features (5 numeric, 3 one-hot bands); NaN / inf / null
    become 0. Key columns are kept."""
    num = [F.coalesce(finite_or_null(F.col(c).cast("double")), F.lit(0.0)).alias(c)
           for c in NUMERIC_FEATURES]
    bands = [F.when(F.col("distance_band") == b, F.lit(1.0)).otherwise(F.lit(0.0)).alias(f"band__{b}")
             for b in DISTANCE_BANDS]
    keep = [c for c in cy.columns if c not in FEATURE_COLUMNS]
    return cy.select(*keep, *num, *bands)


def distance_mix(cy: DataFrame, value: str = V) -> DataFrame:
    """Per year, value and share of each distance band - dense: all three
    bands for every year, 0 where a band has no corridor. One pivot-style
    aggregation per year (no cross join), then unpivot."""
    per_year = cy.groupBy("year").agg(
        *[sum0(F.when(F.col("distance_band") == b, F.col(value))).alias(b) for b in DISTANCE_BANDS])
    total = sum([F.col(f"`{b}`") for b in DISTANCE_BANDS[1:]], F.col(f"`{DISTANCE_BANDS[0]}`"))
    long = (per_year.withColumn("total", total)
            .unpivot(["year", "total"], DISTANCE_BANDS, "distance_band", "value_observed"))
    return long.select("year", "distance_band", band_order("distance_band").alias("band_order"),
                       "value_observed", "total", share("value_observed", "total").alias("share"))
