"""Selection operators: filters, entity cleaning, year choices.

Every function maps DataFrames to a DataFrame and runs no action. Predicates
are plain column comparisons with literals so Catalyst pushes them into the
parquet scan (and prunes ``year`` partitions of the silver table).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowatlas.functions.columns import ne_keep_null, not_in_keep_null
from flowatlas.operators.cube import row_count
from flowatlas.schemas import (
    EXCLUDED_STATUSES, LATEST, UNMAPPED_ISO, Filters, crisis_origin, scope_types,
)


def latest_year(df: DataFrame) -> DataFrame:
    """One-row frame with the latest year present."""
    return df.agg(F.max("year").alias("year"))


def filter_year(df: DataFrame, year) -> DataFrame:
    """``year`` int: equality (pushed down / partition-pruned); ``"latest"``:
    equality with a scalar subquery of the max year - on a year-partitioned
    table the subquery reads partition values only and the scan keeps the
    selected partition (runtime partition filter); ``None``: all years."""
    if year is None:
        return df
    if year == LATEST:
        return df.filter(F.col("year") == latest_year(df).scalar())
    return df.filter(F.col("year") == F.lit(int(year)))


def filter_selection(df: DataFrame, f: Filters, types: list[str] | None = None,
                     apply_types: bool = True) -> DataFrame:
    """Optional year, scope types, crisis, origin and host predicates.

    An explicit origin beats the crisis (the crisis only applies when the
    origin is "All"); an unknown crisis or "All" means no filter.
    """
    d = filter_year(df, f.year)
    if apply_types and "population_type_std" in df.columns:
        d = d.filter(F.col("population_type_std").isin(types or f.types))
    c_origin = crisis_origin(f.crisis)
    if f.origin != "All":
        d = d.filter(F.col("origin_country_std") == F.lit(f.origin))
    elif c_origin is not None:
        d = d.filter(F.col("origin_country_std") == F.lit(c_origin))
    if f.host != "All":
        d = d.filter(F.col("host_country_std") == F.lit(f.host))
    return d


def clean_condition(role: str, map_only: bool = False):
    """The predicate of ``clean_entities`` as a Column (null counts as false)."""
    iso = F.col(f"{role}_iso3")
    cond = (iso.isNotNull() & ne_keep_null(iso, UNMAPPED_ISO)
            & not_in_keep_null(f"{role}_mapping_status", EXCLUDED_STATUSES))
    if map_only:
        cond = cond & F.coalesce(F.col(f"{role}_map_eligible_flag"), F.lit(False))
    return cond


def clean_entities(df: DataFrame, role: str, map_only: bool = False) -> DataFrame:
    """Keep rows whose ``role`` entity is rankable: ISO code present and not
    UNMAPPED, status not special/missing/unmapped (a null status is kept);
    ``map_only`` also needs the map-eligible flag. Historical and composite
    entities are kept."""
    return df.filter(clean_condition(role, map_only))


def positive_only(df: DataFrame, value: str = "value_observed") -> DataFrame:
    """Drop aggregated rows whose value is null or not above zero."""
    return df.filter(F.col(value) > 0)


def key_not_null(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.dropna(subset=keys)


def last_n_years(df: DataFrame, n: int = 12) -> DataFrame:
    """Rows of the last ``n`` distinct years present."""
    years = (df.select("year").where(F.col("year").isNotNull()).distinct()
             .orderBy(F.col("year").desc()).limit(n))
    return df.join(F.broadcast(years), "year", "left_semi")


def year_bounds(df: DataFrame) -> DataFrame:
    return df.agg(F.min("year").alias("year_min"), F.max("year").alias("year_max"))


def filter_choices(df: DataFrame, role: str) -> DataFrame:
    """"All" followed by the sorted distinct names of the role, special
    entities excluded (null statuses kept)."""
    name = f"{role}_country_std"
    names = (df.filter(ne_keep_null(f"{role}_mapping_status", "special_entity"))
             .select(F.col(name).alias("choice")).dropna().distinct())
    all_row = df.sparkSession.range(1).select(F.lit("All").alias("choice"))
    return (all_row.select(F.lit(0).alias("choice_order"), "choice")
            .unionByName(names.select(F.lit(1).alias("choice_order"), "choice")))


def filter_options(df: DataFrame) -> DataFrame:
    """Years, types and countries of the table as one nested row."""
    return df.agg(
        F.array_sort(F.collect_set("year")).alias("years"),
        F.array_sort(F.collect_set("population_type_std")).alias("population_types"),
        F.array_sort(F.collect_set("origin_country_std")).alias("origin_countries"),
        F.array_sort(F.collect_set("host_country_std")).alias("host_countries"),
        F.count_distinct("origin_country_std").alias("origin_country_count"),
        F.count_distinct("host_country_std").alias("host_country_count"),
    )


COVERAGE = "rows BIGINT, year_min INT, year_max INT, years ARRAY<INT>, origin_countries ARRAY<STRING>, host_countries ARRAY<STRING>"


def dataset_coverage(tables: dict[str, DataFrame]) -> DataFrame:
    """One row: the map dataset -> struct of rows, first and last year, years and
    countries (``COVERAGE``). A table without a country column has null there,
    an empty one no years. Each table is read once and gives one row; the map
    has an entry per table, whatever their sizes."""
    def side(df: DataFrame, role: str):
        c = f"{role}_country_std"
        return (F.array_sort(F.collect_set(c)) if c in df.columns else F.lit(None)).cast("array<string>").alias(f"{role}_countries")

    def entry(name: str, df: DataFrame) -> DataFrame:
        n = F.coalesce(row_count(df), F.lit(0)).cast("bigint")  # of the cube: the cells behind its rows
        year = F.col("year").cast("int")
        return df.agg(F.struct(
            n.alias("rows"), F.min(year).alias("year_min"), F.max(year).alias("year_max"),
            F.array_sort(F.collect_set(year)).alias("years"), side(df, "origin"), side(df, "host")).alias("coverage")).select(
                F.lit(name).alias("dataset"), "coverage")

    each = reduce(DataFrame.unionByName, [entry(n, df) for n, df in tables.items()])
    return each.agg(F.map_from_entries(F.array_sort(F.collect_list(F.struct("dataset", "coverage")))).alias("dataset_coverage"))


def filter_options_document(df: DataFrame, tables: dict[str, DataFrame]) -> DataFrame:
    """The filter options as one JSON document: ``filter_options`` of ``df``, the
    coverage of every table and the years of all of them together."""
    doc = filter_options(df).withColumn("dataset_coverage", dataset_coverage(tables).scalar())
    bounds = F.map_values("dataset_coverage")
    doc = doc.withColumns({"all_dataset_year_min": F.array_min(F.transform(bounds, lambda x: x["year_min"])),
                           "all_dataset_year_max": F.array_max(F.transform(bounds, lambda x: x["year_max"]))})
    return doc.select(F.to_json(F.struct(*doc.columns)).alias("document"))


def read_coverage(document: DataFrame) -> DataFrame:
    """The coverage in a JSON document again, one row per dataset."""
    kind = f"struct<dataset_coverage: map<string, struct<{', '.join(f.strip().replace(' ', ': ', 1) for f in COVERAGE.split(','))}>>>"
    return (document.select(F.from_json("document", kind).alias("_d"))
            .select(F.explode("_d.dataset_coverage").alias("dataset", "_c")).select("dataset", "_c.*"))


def year_fallback(df: DataFrame, year: int) -> DataFrame:
    """One row: ``year`` if it has rows, otherwise the latest year present."""
    return df.agg(F.coalesce(
        F.max(F.when(F.col("year") == F.lit(int(year)), F.col("year"))),
        F.max("year")).cast(T.IntegerType()).alias("target_year"))


def scope_fallback(selected: DataFrame, whole_scope: DataFrame, min_rows: int = 10) -> DataFrame:
    """The selected table if it has at least ``min_rows`` rows, else the
    whole-scope table, else an empty table; ``input_used`` says which
    (``selection`` or ``scope``). Decided with a bounded count
    (``limit(min_rows).count()``), the only action in this module."""
    if selected.limit(min_rows).count() >= min_rows:
        return selected.withColumn("input_used", F.lit("selection"))
    whole = whole_scope.withColumn("input_used", F.lit("scope"))
    return whole if whole_scope.limit(min_rows).count() >= min_rows else whole.limit(0)


__all__ = [
    "scope_types", "filter_selection", "clean_entities", "positive_only", "key_not_null",
    "last_n_years", "year_bounds", "filter_choices", "filter_options",
    "dataset_coverage", "filter_options_document", "read_coverage", "year_fallback",
    "scope_fallback", "latest_year", "filter_year",
]
