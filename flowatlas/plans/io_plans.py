"""Registered source / sink queries (§2.1) with oracles.

Queries that write go to ``<checkpoint dir>/flowatlas_out/<data>/<key>`` -
the shared folder the session names - and read the written files back, so
what is checked is the round trip.
"""

from __future__ import annotations

import re

from pyspark.sql import functions as F

from flowatlas.operators import stock as st
from flowatlas.operators.select import filter_selection
from flowatlas.plans.common import ORACLES, QUERIES, register, views
from flowatlas.plans.stock_plans import F0, _rank_sql
from flowatlas.schemas import DRIVER_SCHEMAS, RAW_STOCK_SCHEMA, STOCK_REQUIRED, STOCK_SCHEMA
from flowatlas.session import shared_dir
from flowatlas.sources import fixtures, sinks
from flowatlas.sources.catalog import (
    LINE, SILVER_VIEWS, load_catalog, path_exists, scan_first_available, scan_raw_csv, scan_table, source_key)
from flowatlas.sources.files import validate_files


def scratch(spark, sf: str, key: str) -> str:
    """Output folder of a writing query under the shared folder, per state of
    the data folder."""
    return f"{shared_dir(spark)}/flowatlas_out/{source_key(spark, sf)}/{key}"


_STOCK_COLS = [f.name for f in STOCK_SCHEMA.fields]


@register("scan_table", """
SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem WHERE l_quantity > 45
""", views=())
def q_scan_table(spark, sf):
    li = scan_table(spark, f"{sf}/lineitem.parquet", DRIVER_SCHEMAS["lineitem"])
    return li.select("l_orderkey", "l_linenumber", "l_quantity").filter(F.col("l_quantity") > 45)


@register("scan_first_available", "SELECT o_orderkey, o_orderstatus FROM orders", views=())
def q_scan_first_available(spark, sf):
    df = scan_first_available(spark, [f"{sf}/stock.parquet", f"{sf}/orders.parquet"],
                              DRIVER_SCHEMAS["orders"], required=True)
    return df.select("o_orderkey", "o_orderstatus")


@register("scan_stock", f"SELECT {', '.join(_STOCK_COLS)} FROM stock")
def q_scan_stock(spark, sf):
    """Stock candidates in order: stock.parquet, stock_timeseries.parquet,
    the silver stock table, and last a gzip CSV export - written (once) only
    when no earlier candidate exists."""
    cat = views(spark, sf)
    cat.stock()  # materialises the silver table when the session has a checkpoint folder
    cands = [f"{sf}/stock.parquet", f"{sf}/stock_timeseries.parquet"]
    if cat.silver_dir:
        cands.append(f"{cat.silver_dir}/stock")
    gz = scratch(spark, sf, "scan_stock") + "/time_series_clean.csv.gz"
    if not any(path_exists(spark, c) for c in cands) and not path_exists(spark, f"{gz}/_SUCCESS"):
        sinks.write_csv(cat.stock().select(*_STOCK_COLS), gz, compression="gzip")
    return scan_first_available(spark, cands + [gz], STOCK_SCHEMA, required=True).select(*_STOCK_COLS)


_CATALOG_VIEWS = ["stock", "decisions", "resettlement", "apps_monthly", "demographics_wide", "poc_wide",
                  "raw_stock", "centroid", "crisis", "crisis_events", "scope", "population", "country_map",
                  "population_type_map", "entity"]


@register("load_catalog", "\nUNION ALL\n".join(
    f"SELECT '{v}' AS view_name, count(*) AS rows FROM {v}" for v in _CATALOG_VIEWS),
    views=tuple(_CATALOG_VIEWS))
def q_load_catalog(spark, sf):
    prefix = "fa_" + re.sub(r"\W", "_", source_key(spark, sf)) + "_"
    load_catalog(spark, sf, prefix)
    return spark.sql("\nUNION ALL\n".join(
        f"SELECT '{v}' AS view_name, count(*) AS rows FROM {prefix}{v}" for v in _CATALOG_VIEWS))


_BOUNDED = [v for v in SILVER_VIEWS if not v.startswith("raw_")]


@register("catalog_year_bounds", "\nUNION ALL\n".join(
    f"SELECT '{v}' AS table_name, min(year) AS year_min, max(year) AS year_max FROM {v}" for v in _BOUNDED), views=tuple(_BOUNDED))
def q_catalog_year_bounds(spark, sf):
    """First and last year of every table that has one: from the names of the
    silver tables' partitions where there are silver tables."""
    cat = views(spark, sf)
    if cat.silver_dir:
        cat.build_silver()
        return cat.year_bounds(_BOUNDED)
    out = None
    for v in _BOUNDED:
        d = cat.view(v).agg(F.min("year").alias("year_min"), F.max("year").alias("year_max")).select(F.lit(v).alias("table_name"), "*")
        out = d if out is None else out.unionByName(d)
    return out


# a blank CSV cell reads as null (the clean step treats null and '' alike)
_RAW_SQL = """SELECT nullif(year_raw, '') AS year_raw, nullif(origin_raw, '') AS origin_raw,
       nullif(host_raw, '') AS host_raw, nullif(population_type_raw, '') AS population_type_raw,
       nullif(value_raw, '') AS value_raw, nullif(procedure_raw, '') AS procedure_raw,
       cast(source_key AS varchar) AS source_key, cast(source_line AS varchar) AS source_line FROM raw_stock"""


def _raw_csv(spark, sf):
    """The raw stock table as a header CSV (written once per run)."""
    path = scratch(spark, sf, "raw_csv") + "/raw_stock.csv"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        raw = views(spark, sf).view("raw_stock").select(*[F.col(f.name).cast("string") for f in RAW_STOCK_SCHEMA])
        (raw.write.mode("overwrite").option("header", True)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False).csv(path))
    return path


@register("scan_raw_csv", _RAW_SQL, views=("raw_stock",))
def q_scan_raw_csv(spark, sf):
    """Raw CSV as text: an empty field is null, '*' and 'NA' codes stay text
    (parsing is the clean step's job), malformed records are set aside."""
    raw = scan_raw_csv(spark, _raw_csv(spark, sf), RAW_STOCK_SCHEMA.names)
    return raw.filter(F.col(LINE).isNull()).select(*RAW_STOCK_SCHEMA.names)


# The six raw tables and their columns; files as they arrive, without a header.
RAW_TABLES = {
    "raw_stock": RAW_STOCK_SCHEMA.names,
    "raw_decisions": ["year_raw", "origin_raw", "host_raw", "procedure_raw",
                      *[f"{c}_raw" for c in [*fixtures.DECISION_PARTS, "total_decisions"]], "source_key", "source_line"],
    "raw_apps_monthly": ["year_raw", "month_raw", "host_raw", "value_raw", "source_key"],
    "raw_resettlement": ["year_raw", "origin_raw", "host_raw", "value_raw"],
    "raw_poc": ["year_raw", "origin_raw", "host_raw", *[f"{c}_raw" for c in fixtures.POC_COLUMNS]],
    "raw_demographics": ["year_raw", "host_raw", *[f"{c}_raw" for c in fixtures.DEMOGRAPHIC_COLUMNS]],
}


def _pick_sql(columns) -> str:
    """Length of a row's text; it picks the records that arrive malformed."""
    return "length(" + " || ".join(f"coalesce(cast({c} AS varchar(400)), '')" for c in columns) + ")"


def _damaged_csv(spark, sf, table: str) -> str:
    """The raw table as CSV lines (written once per run); some have a field too
    many or lack the last one."""
    path = scratch(spark, sf, "raw_lines") + f"/{table}.csv"
    if not path_exists(spark, f"{path}/_SUCCESS"):
        cols = [F.col(c).cast("string").alias(c) for c in RAW_TABLES[table]]
        keep = {"ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}
        pick = F.expr(_pick_sql(RAW_TABLES[table]))
        line = (F.when(pick % 13 == 0, F.concat(F.to_csv(F.struct(*cols), keep), F.lit(",surplus")))
                .when(pick % 11 == 0, F.to_csv(F.struct(*cols[:-1]), keep)).otherwise(F.to_csv(F.struct(*cols), keep)))
        views(spark, sf).view(table).select(line.alias("value")).write.mode("overwrite").text(path)
    return path


def _bad_sql(columns) -> str:
    return f"({_pick_sql(columns)} % 13 = 0 OR {_pick_sql(columns)} % 11 = 0)"


@register("scan_raw_csv_all", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, count(*) AS file_rows, count(CASE WHEN NOT {_bad_sql(c)} THEN 1 END) AS good_rows, "
    f"count(CASE WHEN {_bad_sql(c)} THEN 1 END) AS quarantined_rows, "
    f"cast(coalesce(sum(CASE WHEN NOT {_bad_sql(c)} THEN cast(year_raw AS bigint) END), 0) AS bigint) AS good_year_sum FROM {t}"
    for t, c in RAW_TABLES.items()), views=tuple(RAW_TABLES))
def q_scan_raw_csv_all(spark, sf):
    """All six raw files, malformed records and all: rows of the file, good and
    quarantined ones, one scan each."""
    out = None
    for t, cols in RAW_TABLES.items():
        raw = scan_raw_csv(spark, _damaged_csv(spark, sf, t), cols, header=False)
        good = F.col(LINE).isNull()
        n = raw.agg(F.count(F.lit(1)).alias("file_rows"), F.count_if(good).alias("good_rows"), F.count_if(~good).alias("quarantined_rows"),
                    F.coalesce(F.sum(F.when(good, F.col("year_raw").cast("long"))), F.lit(0)).alias("good_year_sum"))
        n = n.select(F.lit(t).alias("dataset"), "*")
        out = n if out is None else out.unionByName(n)
    return out


@register("convert_to_parquet", _RAW_SQL, views=("raw_stock",))
def q_convert_to_parquet(spark, sf):
    src = _raw_csv(spark, sf)
    out = sinks.convert_to_parquet(spark, {"raw_stock": src}, scratch(spark, sf, "parquet"),
                                   schemas={"raw_stock": RAW_STOCK_SCHEMA})
    return spark.read.parquet(out["raw_stock"])


# The ten chart tables, by the query that makes each.
CHART_TABLES = {
    "kpis": "kpi_table", "trends": "trend_by_type", "host_rankings": "rank_hosts", "origin_rankings": "rank_origins",
    "sankey_links": "sankey_layers", "choropleth": "choropleth_latest", "corridors": "corridors",
    "animated_host_map": "host_by_year", "role_scatter": "role_scatter", "host_pressure": "host_pressure"}


@register("convert_to_parquet_all", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS table_name, count(*) AS rows FROM (\n{ORACLES[q]}\n) q_{t}" for t, q in CHART_TABLES.items()), views=())
def q_convert_to_parquet_all(spark, sf):
    """The ten chart tables: exported as CSV, converted together, and counted
    in what was published."""
    folder = scratch(spark, sf, "charts")
    made = {t: QUERIES[q](spark, sf) for t, q in CHART_TABLES.items()}
    for t, df in made.items():
        sinks.write_csv(df, f"{folder}/csv/{t}.csv")
    manifest = sinks.convert_together(spark, {t: f"{folder}/csv/{t}.csv" for t in made}, f"{folder}/parquet",
                                      schemas={t: df.schema for t, df in made.items()})
    out = None
    for r in manifest.collect():  # ten rows
        d = spark.read.schema(made[r["table_name"]].schema).parquet(r["path"]).agg(F.count(F.lit(1)).alias("rows"))
        d = d.select(F.lit(r["table_name"]).alias("table_name"), "rows")
        out = d if out is None else out.unionByName(d)
    return out


REQUIRED_FILES = fixtures.USED_COLUMNS | {"stock": STOCK_REQUIRED}


@register("validate_required_files", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, '{t}.parquet' AS file, true AS exists, "
    f"(SELECT count(*) FROM information_schema.columns WHERE table_name = '{t}')::INT AS columns_in_preview, "
    f"'{' | '.join(c)}' AS required_columns, '' AS missing_required_columns, 'PASS' AS status"
    for t, c in fixtures.USED_COLUMNS.items()) + f"""
UNION ALL
SELECT 'stock', 'stock.parquet', false, 0, '{' | '.join(STOCK_REQUIRED)}', '{' | '.join(STOCK_REQUIRED)}', 'MISSING'
""", views=())
def q_validate_required_files(spark, sf):
    """Every file of the driver tables, and of a first stock candidate that is not there."""
    d = validate_files(spark, {t: f"{sf}/{t}.parquet" for t in REQUIRED_FILES}, REQUIRED_FILES)
    return d.withColumn("file", F.substring_index("file", "/", -1))


@register("export_chart_table", _rank_sql("host", 12))
def q_export_chart_table(spark, sf):
    r = st.rank_entities(filter_selection(views(spark, sf).cube(), F0), "host", F0.top_n)
    path = scratch(spark, sf, "export") + "/host_rankings.csv"
    return sinks.export_chart_table(r, path, aliases=["graph6_top_host_countries", "host_rankings"])


@register("nullify_non_finite", """
, a AS (SELECT year, population_type_std, coalesce(sum(value_observed), 0) AS total FROM stock
        GROUP BY year, population_type_std)
, b AS (SELECT *, total / max(total) OVER (PARTITION BY year) AS s FROM a)
SELECT year, population_type_std, total,
       CASE WHEN s >= 1 OR s <= -1 THEN NULL ELSE round(atanh(s), 9) END AS spread,
       CASE WHEN total > 1 OR total < -1 THEN NULL ELSE round(acos(total), 9) END AS angle
FROM b
""")
def q_nullify_non_finite(spark, sf):
    """Per (year, type): atanh of the share of the year's largest type
    (+inf for that type) and acos of the total (NaN above 1): written as
    strict JSON, read back, non-finite values are nulls."""
    from pyspark.sql import Window
    a = views(spark, sf).cube().groupBy("year", "population_type_std").agg(
        F.coalesce(F.sum("value_observed"), F.lit(0.0)).alias("total"))
    s = F.try_divide(F.col("total"), F.max("total").over(Window.partitionBy("year")))
    raw = a.select("year", "population_type_std", "total", F.atanh(s).alias("spread"),
                   F.acos("total").alias("angle"),
                   F.array(F.atanh(s), F.acos("total")).alias("both"),
                   F.struct(F.atanh(s).alias("spread")).alias("nested"))
    path = scratch(spark, sf, "json") + "/non_finite.json"
    sinks.write_json(raw, path)
    back = spark.read.schema(raw.schema).json(path)
    return back.select("year", "population_type_std", "total", F.round("spread", 9).alias("spread"),
                       F.round("angle", 9).alias("angle"))
