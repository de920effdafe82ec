"""Stock aggregations: KPIs, rankings, corridors, Sankey, crisis views,
concentration, roles, pressure and the corridor network.

Plan shape conventions (see README "Scale notes"):

* group-bys aggregate partially before the shuffle, so a hot origin that
  holds a third of all rows only costs one partial row per task;
* top-N is ``orderBy(...).limit(n)`` (TakeOrderedAndProject: each task keeps
  its n best, the driver merges n x tasks rows), and rank numbers are
  assigned on those n rows only;
* global denominators are one-row aggregates attached as scalar
  subqueries, never a window over the whole table and never a cross join;
* every order-by carries a name tie-breaker so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowatlas.functions.columns import share, sum0
from flowatlas.operators.cube import flag_count, observed_count, row_count
from flowatlas.operators.select import clean_condition, clean_entities, filter_selection, filter_year
from flowatlas.schemas import (
    ACTIVE_FORCED_TYPES, CRISIS_ORIGIN, CROSS_BORDER_TYPES, DEFAULT_CRISIS, LATEST, POP_ASYLUM, POP_IDPS, POP_REFUGEES,
    Filters, crisis_focus_origin,
)

V = "value_observed"

# Chart labels, node prefixes, role classes and the
# missing-denominator status of the stock outputs.
ROLE_LABELS = {"origin": "Top origin countries", "host": "Top host countries"}
TREEMAP_ROOT = "Selected host stock"
NODE_PREFIX = {"origin": "Origin: ", "host": "Host: "}
ROLE_BOTH, ROLE_HOST, ROLE_ORIGIN, ROLE_NONE = (
    "both_origin_and_host", "mostly_host", "mostly_origin", "no_observed_role")
MISSING_DENOMINATOR = "missing_wdi_denominator"


def _rank_numbers(df: DataFrame, order) -> DataFrame:
    """1..n in ``order``; only ever applied to a limited (top-n) frame."""
    return df.withColumn("rank", F.row_number().over(Window.orderBy(*order)).cast(T.IntegerType()))


# ------------------------------------------------------------------ KPIs
def kpis(stock: DataFrame, f: Filters) -> DataFrame:
    """Totals of the selection in one scan: total, refugees, asylum over the
    selected scope; IDPs over the active scope with the same other filters;
    distinct countries over origin and host names of the selection."""
    scope = f.types
    types = sorted(set(scope) | set(ACTIVE_FORCED_TYPES))
    d = filter_selection(stock, f, types=types)
    t = F.col("population_type_std")
    in_scope = t.isin(scope)
    return d.agg(
        sum0(F.when(in_scope, F.col(V))).alias("total"),
        sum0(F.when(in_scope & (t == POP_REFUGEES), F.col(V))).alias("refugees"),
        sum0(F.when(in_scope & (t == POP_ASYLUM), F.col(V))).alias("asylum"),
        sum0(F.when(t == POP_IDPS, F.col(V))).alias("idps"),
        # distinct names are bounded by the number of countries, not rows
        F.size(F.array_distinct(F.concat(
            F.collect_set(F.when(in_scope, F.col("origin_country_std"))),
            F.collect_set(F.when(in_scope, F.col("host_country_std")))))).cast("bigint").alias("countries"),
    )


def kpi_table(stock: DataFrame, apps: DataFrame, year=LATEST) -> DataFrame:
    """Latest-year KPI rows: one per population type, the two scope totals,
    the entity counts and the applications of the year."""
    d = filter_year(stock, year)
    y = d.agg(F.max("year").alias("year"))
    per_type = d.groupBy(F.col("population_type_std").alias("kpi")).agg(sum0(V).alias("value"))
    t = F.col("population_type_std")
    scopes = d.agg(
        sum0(F.when(t.isin(ACTIVE_FORCED_TYPES), F.col(V))).alias("Active forced-displacement scope"),
        sum0(F.when(t.isin(CROSS_BORDER_TYPES), F.col(V))).alias("Cross-border dashboard scope"),
        F.count_distinct("origin_country_std").cast("double").alias("Origin countries/entities"),
        F.count_distinct("host_country_std").cast("double").alias("Host countries/entities"),
    )
    scope_rows = scopes.unpivot([], scopes.columns, "kpi", "value")
    stock_rows = (per_type.unionByName(scope_rows)
                  .select("kpi", "value", y.scalar().alias("year"), F.lit("stock").alias("source")))
    apps_year = apps.filter(F.col("year") == y.scalar())
    app_row = apps_year.agg(sum0("applications_observed").alias("value")).select(
        F.lit("Asylum applications during year").alias("kpi"), "value",
        y.scalar().alias("year"), F.lit("decisions").alias("source"))
    return stock_rows.unionByName(app_row)


# ------------------------------------------------------------------ trends
def trend_by_type(stock: DataFrame, f: Filters) -> DataFrame:
    """Annual sum per population type, all years, other filters kept."""
    d = filter_selection(stock, f.with_(year=None))
    return d.groupBy("year", "population_type_std").agg(sum0(V).alias(V))


def annual_population_yoy(stock: DataFrame) -> DataFrame:
    """Per (year, type): sum, row counts by cell state, and the change
    against the exact previous calendar year (null when that year is absent)."""
    a = stock.groupBy("year", "population_type_std").agg(
        sum0(V).alias(V),
        row_count(stock).alias("source_rows"),
        observed_count(stock).alias("observed_rows"),
        flag_count(stock, "redacted").alias("redacted_rows"),
        flag_count(stock, "blank").alias("blank_rows"),
        flag_count(stock, "zero").alias("zero_rows"),
    )
    prev_w = Window.partitionBy("population_type_std").orderBy("year").rangeBetween(-1, -1)
    prev = F.sum(V).over(prev_w)
    return (a.withColumn("_prev", prev)
            .withColumn("yoy_absolute_change", F.col(V) - F.col("_prev"))
            # as a ratio minus one (the published fractions are computed so)
            .withColumn("yoy_pct_change", share(F.col(V), F.col("_prev")) - F.lit(1.0))
            .drop("_prev"))


# ------------------------------------------------------------------ rankings
def rank_entities(df: DataFrame, role: str, n: int) -> DataFrame:
    """Top ``n`` entities of a role: clean -> sum -> positive -> top n ->
    rank 1..n; share is of the total over all cleaned rows."""
    name, iso = f"{role}_country_std", f"{role}_iso3"
    g = clean_entities(df, role).dropna(subset=[name, iso]).groupBy(name, iso).agg(sum0(V).alias(V))
    # the denominator is summed from the same grouped frame, so its scan and
    # shuffle are reused by the subquery (a cleaned row always has a name)
    total = g.agg(F.sum(V)).scalar()
    top = g.filter(F.col(V) > 0).orderBy(F.col(V).desc(), F.col(name), F.col(iso)).limit(int(n))
    return (_rank_numbers(top, [F.col(V).desc(), F.col(name), F.col(iso)])
            .withColumn("share", share(F.col(V), total)))


def rank_entities_full(df: DataFrame, role: str, n: int) -> DataFrame:
    """``rank_entities`` with mapping status, map flag and row counts."""
    name, iso = f"{role}_country_std", f"{role}_iso3"
    st, fl = f"{role}_mapping_status", f"{role}_map_eligible_flag"
    g = (clean_entities(df, role).dropna(subset=[name, iso]).groupBy(name, iso, st, fl)
         .agg(sum0(V).alias(V), row_count(df).alias("source_rows"), observed_count(df).alias("observed_rows")))
    total = g.agg(F.sum(V)).scalar()
    top = g.filter(F.col(V) > 0).orderBy(F.col(V).desc(), F.col(name), F.col(iso)).limit(int(n))
    return (_rank_numbers(top, [F.col(V).desc(), F.col(name), F.col(iso)])
            .withColumn("share_of_selected_total", share(F.col(V), total)))


def rank_combined(df: DataFrame, n: int) -> DataFrame:
    """Both rankings in one table with a role label, from one scan: each
    cell is exploded into its origin end and its host end, both aggregated
    in the same shuffle; ranks and role totals are windows over the per-
    country aggregates (at most a few hundred rows per role)."""
    labels = ROLE_LABELS

    def side(role):
        return F.struct(
            F.lit(labels[role]).alias("chart_role"), F.col(f"{role}_country_std").alias("country"),
            F.col(f"{role}_iso3").alias("iso3"), F.col(f"{role}_mapping_status").alias("status"),
            F.col(f"{role}_map_eligible_flag").alias("flag"),
            (clean_condition(role) & F.col(f"{role}_country_std").isNotNull()).alias("ok"))
    e = (df.select(V, F.explode(F.array(side("origin"), side("host"))).alias("e"))
         .filter(F.col("e.ok")).select(V, "e.chart_role", "e.country", "e.iso3", "e.status", "e.flag"))
    g = e.groupBy("chart_role", "country", "iso3", "status", "flag").agg(sum0(V).alias(V))
    g = g.withColumn("_total", F.sum(V).over(Window.partitionBy("chart_role")))
    order = Window.partitionBy("chart_role").orderBy(F.col(V).desc(), F.col("country"), F.col("iso3"))
    top = (g.filter(F.col(V) > 0).withColumn("rank", F.row_number().over(order).cast(T.IntegerType()))
           .filter(F.col("rank") <= int(n)))
    return top.select("chart_role", "rank", "country", "iso3", V,
                      share(F.col(V), F.col("_total")).alias("share_of_selected_total"))


def treemap_hosts(df: DataFrame, n: int, root: str = TREEMAP_ROOT) -> DataFrame:
    """Top ``n`` hosts as leaves plus their root node (rollup total)."""
    top = rank_entities(df, "host", int(n))
    r = top.rollup("host_country_std").agg(F.sum(V).alias(V))
    leaf = F.col("host_country_std").isNotNull()
    return r.select(
        F.when(leaf, F.lit(root)).otherwise(F.lit("")).alias("parent"),
        F.coalesce(F.col("host_country_std"), F.lit(root)).alias("label"),
        F.col(V))


# ------------------------------------------------------------------ geography
def host_geography(df: DataFrame) -> DataFrame:
    """Map-eligible hosts with an ISO code, summed, positive only."""
    d = df.filter(F.col("host_map_eligible_flag") & F.col("host_iso3").isNotNull())
    return (d.dropna(subset=["host_country_std"]).groupBy("host_country_std", "host_iso3")
            .agg(sum0(V).alias(V)).filter(F.col(V) > 0))


def choropleth_latest(stock: DataFrame, types=None) -> DataFrame:
    """Latest year, both ends map-eligible, host sums with row counts."""
    d = filter_year(stock, LATEST).filter(F.col("population_type_std").isin(types or CROSS_BORDER_TYPES))
    d = d.filter(F.col("host_map_eligible_flag") & F.col("host_iso3").isNotNull()
                 & F.col("origin_map_eligible_flag") & F.col("origin_iso3").isNotNull())
    return (d.dropna(subset=["host_country_std"]).groupBy("year", "host_country_std", "host_iso3")
            .agg(sum0(V).alias(V), row_count(stock).alias("source_rows"))
            .filter(F.col(V) > 0))


def host_by_year(stock: DataFrame, types=None) -> DataFrame:
    """Map-eligible host sums per year (animated map frames)."""
    d = stock.filter(F.col("population_type_std").isin(types or CROSS_BORDER_TYPES))
    d = clean_entities(d, "host", map_only=True)
    return (d.dropna(subset=["host_country_std"]).groupBy("year", "host_country_std", "host_iso3")
            .agg(sum0(V).alias(V)).filter(F.col(V) > 0))


def leading_pair(df: DataFrame) -> DataFrame:
    """Leading origin and leading host of the selection, without entity
    cleaning; "-" when the selection is empty."""
    def lead(role):
        name = f"{role}_country_std"
        return (df.dropna(subset=[name]).groupBy(name).agg(sum0(V).alias("_v"))
                .orderBy(F.col("_v").desc(), F.col(name)).limit(1).select(name))
    one = df.sparkSession.range(1)
    return one.select(F.coalesce(lead("origin").scalar(), F.lit("-")).alias("origin_name"),
                      F.coalesce(lead("host").scalar(), F.lit("-")).alias("host_name"))


# ------------------------------------------------------------------ corridors
def corridors(df: DataFrame, n: int) -> DataFrame:
    """Top ``n`` (origin, host, type) corridors of cleaned entities.
    Self-corridors stay."""
    d = clean_entities(clean_entities(df, "origin"), "host")
    keys = ["origin_country_std", "host_country_std", "population_type_std"]
    return (d.dropna(subset=keys).groupBy(*keys).agg(sum0(V).alias(V))
            .filter(F.col(V) > 0)
            .orderBy(F.col(V).desc(), *[F.col(k) for k in keys]).limit(int(n)))


def corridors_full(stock: DataFrame, n: int = 300, types=None) -> DataFrame:
    """Latest-year top corridors with ISO codes and row counts."""
    d = filter_year(stock, LATEST).filter(F.col("population_type_std").isin(types or CROSS_BORDER_TYPES))
    d = clean_entities(clean_entities(d, "origin"), "host")
    keys = ["year", "origin_country_std", "origin_iso3", "host_country_std", "host_iso3", "population_type_std"]
    return (d.dropna(subset=keys).groupBy(*keys)
            .agg(sum0(V).alias(V), row_count(stock).alias("source_rows"))
            .filter(F.col(V) > 0)
            .orderBy(F.col(V).desc(), F.col("origin_country_std"), F.col("host_country_std"),
                     F.col("population_type_std")).limit(int(n)))


def route_weights(routes: DataFrame, centroid: DataFrame) -> DataFrame:
    """The given routes, weight relative to the largest of them (at least
    1.0); ends without a centroid are dropped."""
    keys = [c for c in ("origin_country_std", "host_country_std", "population_type_std")
            if c in routes.columns]
    top = routes.filter(F.col(V) > 0)
    maxv = F.greatest(top.agg(F.max(V)).scalar(), F.lit(1.0))
    o = centroid.select(F.col("country_std").alias("origin_country_std"),
                        F.col("lat").alias("origin_lat"), F.col("lon").alias("origin_lon"))
    h = centroid.select(F.col("country_std").alias("host_country_std"),
                        F.col("lat").alias("host_lat"), F.col("lon").alias("host_lon"))
    return (top.join(o, "origin_country_std").join(h, "host_country_std")
            .select(*keys, V, (F.col(V) / maxv).alias("rel"),
                    "origin_lat", "origin_lon", "host_lat", "host_lon"))


def sankey_layers(corr: DataFrame) -> DataFrame:
    """The given corridor rows, re-summed into an origin->host layer and a
    host->population-type layer."""
    d = corr.filter(F.col(V) > 0)
    l1 = d.groupBy(F.col("origin_country_std").alias("source"),
                   F.col("host_country_std").alias("target")).agg(F.sum(V).alias(V))
    l2 = d.groupBy(F.col("host_country_std").alias("source"),
                   F.col("population_type_std").alias("target")).agg(F.sum(V).alias(V))
    return (l1.select(F.lit(1).alias("layer"), "source", "target", V)
            .unionByName(l2.select(F.lit(2).alias("layer"), "source", "target", V)))


def sankey_nodes(layers: DataFrame) -> DataFrame:
    """Node ids for the Sankey: one node per (layer, label), so a country
    that is both an origin and a host gets two nodes."""
    nodes = (layers.filter(F.col("layer") == 1).select(F.lit(0).alias("layer"), F.col("source").alias("label"))
             .unionByName(layers.filter(F.col("layer") == 1).select(F.lit(1).alias("layer"), F.col("target").alias("label")))
             .unionByName(layers.filter(F.col("layer") == 2).select(F.lit(2).alias("layer"), F.col("target").alias("label")))
             .distinct())
    return nodes.select((F.dense_rank().over(Window.orderBy("layer", "label")) - 1)
                        .cast(T.IntegerType()).alias("node_id"), "layer", "label")


# ------------------------------------------------------------------ crisis
def crisis_hosts(stock: DataFrame, f: Filters) -> DataFrame:
    """Host ranking of the crisis origin within the selection."""
    origin = crisis_focus_origin(f.crisis)
    d = filter_selection(stock, f).filter(F.col("origin_country_std") == F.lit(origin))
    return rank_entities(d, "host", f.top_n)


def crisis_routes(stock: DataFrame, f: Filters) -> DataFrame:
    """Top routes out of the crisis origin (no entity cleaning), positive only."""
    origin = crisis_focus_origin(f.crisis)
    d = filter_selection(stock, f).filter(F.col("origin_country_std") == F.lit(origin))
    keys = ["origin_country_std", "host_country_std"]
    return (d.dropna(subset=keys).groupBy(*keys).agg(sum0(V).alias(V))
            .orderBy(F.col(V).desc(), F.col("host_country_std")).limit(f.top_n)
            .filter(F.col(V) > 0))


def crisis_annotated_trend(stock: DataFrame, events: DataFrame, f: Filters) -> DataFrame:
    """The crisis origin's annual totals with that crisis's events joined on
    the year."""
    crisis = f.crisis if f.crisis in CRISIS_ORIGIN else DEFAULT_CRISIS
    origin = crisis_focus_origin(crisis)
    d = filter_selection(stock, f.with_(year=None, crisis="All Crises", origin=origin))
    annual = d.groupBy("year").agg(sum0(V).alias(V))
    ev = events.filter(F.col("crisis") == F.lit(crisis)).select("year", "event")
    return annual.join(ev, "year", "left")


def crisis_trend(stock: DataFrame, origin: str, types=None) -> DataFrame:
    """One origin's annual sum per population type."""
    d = stock.filter((F.col("origin_country_std") == F.lit(origin))
                     & F.col("population_type_std").isin(types or CROSS_BORDER_TYPES))
    return d.groupBy("year", "population_type_std").agg(sum0(V).alias(V))


def crisis_summary(stock: DataFrame, n: int = 5, types=None) -> DataFrame:
    """For the top ``n`` origins of the latest year: first year with a
    positive total, latest year and value, peak year and value."""
    scope = F.col("population_type_std").isin(types or CROSS_BORDER_TYPES)
    d = stock.filter(scope)
    top = rank_entities(filter_year(stock, LATEST).filter(scope), "origin", n).select("origin_country_std")
    annual = (clean_entities(d, "origin").join(F.broadcast(top), "origin_country_std", "left_semi")
              .groupBy("origin_country_std", "year").agg(sum0(V).alias(V)))
    w_peak = Window.partitionBy("origin_country_std").orderBy(F.col(V).desc(), F.col("year").desc())
    w_last = Window.partitionBy("origin_country_std").orderBy(F.col("year").desc())
    a = (annual.withColumn("_peak", F.row_number().over(w_peak))
         .withColumn("_last", F.row_number().over(w_last)))
    return a.groupBy(F.col("origin_country_std").alias("crisis_or_origin")).agg(
        F.min(F.when(F.col(V) > 0, F.col("year"))).alias("first_observed_year"),
        F.max(F.when(F.col("_last") == 1, F.col("year"))).alias("latest_year"),
        F.max(F.when(F.col("_last") == 1, F.col(V))).alias("latest_value_observed"),
        F.max(F.when(F.col("_peak") == 1, F.col("year"))).alias("peak_year_in_dataset"),
        F.max(F.when(F.col("_peak") == 1, F.col(V))).alias("peak_value_observed"),
    )


def crisis_top_hosts(stock: DataFrame, origin: str, n: int = 15, types=None) -> DataFrame:
    """Top ``n`` hosts of one origin in the latest year."""
    d = filter_year(stock, LATEST).filter(
        (F.col("origin_country_std") == F.lit(origin))
        & F.col("population_type_std").isin(types or CROSS_BORDER_TYPES))
    d = clean_entities(d, "host")
    return (d.dropna(subset=["host_country_std", "host_iso3"]).groupBy("host_country_std", "host_iso3")
            .agg(sum0(V).alias(V)).filter(F.col(V) > 0)
            .orderBy(F.col(V).desc(), F.col("host_country_std")).limit(int(n)))


# ------------------------------------------------------------------ structure
def _role_values(df: DataFrame) -> DataFrame:
    """One scan, two rows per cell: (dimension, country, iso3, value) for
    the origin end and the host end, each kept only if that end is clean."""
    def side(role):
        iso = F.col(f"{role}_iso3")
        st = F.col(f"{role}_mapping_status")
        ok = (iso.isNotNull() & ~iso.eqNullSafe(F.lit("UNMAPPED"))
              & ~F.coalesce(st.isin("special_entity", "missing", "unmapped"), F.lit(False))
              & F.col(f"{role}_country_std").isNotNull())
        return F.struct(F.lit(role).alias("dimension"), F.col(f"{role}_country_std").alias("country"),
                        iso.alias("iso3"), ok.alias("ok"))
    e = df.select("year", V, F.explode(F.array(side("origin"), side("host"))).alias("e"))
    return e.filter(F.col("e.ok")).select("year", V, "e.dimension", "e.country", "e.iso3")


def concentration_by_year(stock: DataFrame, types=None) -> DataFrame:
    """Per (year, dimension): positive entities, their total, top-1 and
    top-5 shares and HHI = sum(v^2) / total^2."""
    d = stock.filter(F.col("population_type_std").isin(types or CROSS_BORDER_TYPES))
    ent = (_role_values(d).groupBy("year", "dimension", "country").agg(sum0(V).alias(V))
           .filter(F.col(V) > 0))
    w = Window.partitionBy("year", "dimension").orderBy(F.col(V).desc(), F.col("country"))
    r = ent.withColumn("_rn", F.row_number().over(w))
    a = r.groupBy("year", "dimension").agg(
        F.count(F.lit(1)).alias("countries"),
        F.sum(V).alias("total_observed"),
        F.max(V).alias("_top1"),
        F.sum(F.when(F.col("_rn") <= 5, F.col(V))).alias("_top5"),
        F.sum(F.col(V) * F.col(V)).alias("_sq"),
    )
    return a.select("year", "dimension", "countries", "total_observed",
                    (F.col("_top1") / F.col("total_observed")).alias("top1_share"),
                    (F.col("_top5") / F.col("total_observed")).alias("top5_share"),
                    (F.col("_sq") / (F.col("total_observed") * F.col("total_observed"))).alias("hhi"))


def role_scatter(stock: DataFrame, types=None) -> DataFrame:
    """Per country, latest year: origin stock, host stock, net and role class
    (full outer join of the two per-country aggregates)."""
    d = filter_year(stock, LATEST).filter(F.col("population_type_std").isin(types or CROSS_BORDER_TYPES))
    rv = _role_values(d)
    o = (rv.filter(F.col("dimension") == "origin").groupBy("country", "iso3")
         .agg(sum0(V).alias("origin_stock_observed")))
    h = (rv.filter(F.col("dimension") == "host").groupBy("country", "iso3")
         .agg(sum0(V).alias("host_stock_observed")))
    j = o.join(h, ["country", "iso3"], "full_outer")
    os_ = F.coalesce(F.col("origin_stock_observed"), F.lit(0.0))
    hs_ = F.coalesce(F.col("host_stock_observed"), F.lit(0.0))
    cls = (F.when((os_ > 0) & (hs_ > 0), F.lit(ROLE_BOTH))
           .when(hs_ > 0, F.lit(ROLE_HOST))
           .when(os_ > 0, F.lit(ROLE_ORIGIN))
           .otherwise(F.lit(ROLE_NONE)))
    return j.select("country", "iso3", os_.alias("origin_stock_observed"),
                    hs_.alias("host_stock_observed"), (hs_ - os_).alias("net_host_minus_origin"),
                    cls.alias("role_class"))


def host_pressure(stock: DataFrame, population: DataFrame, types=None) -> DataFrame:
    """Latest-year host stock per 100k population; status names a missing
    denominator. Denominators are a per-(country, year) table joined left."""
    d = filter_year(stock, LATEST).filter(F.col("population_type_std").isin(types or CROSS_BORDER_TYPES))
    d = clean_entities(d, "host")
    h = (d.dropna(subset=["host_country_std"]).groupBy("year", "host_country_std", "host_iso3")
         .agg(sum0(V).alias("host_stock_observed"), row_count(stock).alias("source_rows"))
         .filter(F.col("host_stock_observed") > 0))
    p = population.select(F.col("iso3").alias("host_iso3"), "year", "population_total",
                          "gdp_per_capita", "income_group")
    j = h.join(p, ["host_iso3", "year"], "left")
    return j.select(
        "year", F.col("host_country_std").alias("country"), F.col("host_iso3").alias("iso3"),
        "host_stock_observed", "source_rows", "population_total",
        F.try_divide(F.col("host_stock_observed") * F.lit(100000.0), F.col("population_total"))
        .alias("host_stock_per_100k_population"),
        "gdp_per_capita", "income_group",
        F.when(F.col("population_total").isNull(), F.lit(MISSING_DENOMINATOR))
        .otherwise(F.lit("ok")).alias("wdi_status"))


def network_metrics(edges_src: DataFrame, types=None) -> DataFrame:
    """Directed origin->host graph of the latest year's cleaned corridors:
    degree and strengths per node. Several population types of the same
    pair are summed into one edge. Betweenness is identically zero on a
    two-layer source->sink graph (no node lies between two others)."""
    d = filter_year(edges_src, LATEST).filter(F.col("population_type_std").isin(types or CROSS_BORDER_TYPES))
    d = clean_entities(clean_entities(d, "origin"), "host")
    e = (d.dropna(subset=["origin_country_std", "host_country_std"])
         .groupBy("origin_country_std", "host_country_std").agg(sum0(V).alias("w"))
         .filter(F.col("w") > 0))
    ends = e.select("w", F.explode(F.array(
        F.struct(F.concat(F.lit(NODE_PREFIX["origin"]), F.col("origin_country_std")).alias("node"),
                 F.lit("origin").alias("node_type")),
        F.struct(F.concat(F.lit(NODE_PREFIX["host"]), F.col("host_country_std")).alias("node"),
                 F.lit("host").alias("node_type")))).alias("n"))
    return ends.groupBy(F.col("n.node").alias("node"), F.col("n.node_type").alias("node_type")).agg(
        F.count(F.lit(1)).alias("degree"),
        sum0(F.when(F.col("n.node_type") == "host", F.col("w"))).alias("in_strength"),
        sum0(F.when(F.col("n.node_type") == "origin", F.col("w"))).alias("out_strength"),
    ).withColumn("betweenness", F.lit(0.0))
