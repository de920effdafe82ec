"""Data-quality audits and the quality gate.

Each audit is one aggregate pass over its table, so the cost is one scan
however many columns are audited. Checks are rows ``(check, status, detail)``; the gate
is their union plus a ``blocks_pipeline`` flag.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowatlas.operators.clean import label_key


def _union(dfs: list[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), dfs)


def _one_row(df: DataFrame) -> DataFrame:
    """A one-row frame to hang scalar subqueries on."""
    return df.sparkSession.range(1)


def audit_dataset_inventory(tables: dict[str, DataFrame]) -> DataFrame:
    """Per table: rows, column count, year range, column list."""
    parts = []
    for name, df in tables.items():
        if "year" in df.columns:
            y = F.col("year").cast(T.IntegerType())
        elif "year_raw" in df.columns:
            y = F.trim(F.col("year_raw")).try_cast(T.IntegerType())
        else:
            y = F.lit(None).cast(T.IntegerType())
        parts.append(df.agg(F.count(F.lit(1)).alias("rows"), F.min(y).alias("year_min"),
                            F.max(y).alias("year_max"))
                     .select(F.lit(name).alias("dataset"), "rows",
                             F.lit(len(df.columns)).alias("columns"), "year_min", "year_max",
                             F.lit(" | ".join(df.columns)).alias("raw_columns")))
    return _union(parts)


#: the audit's accumulators for one column, over its trimmed text and its number (SQL
#: text: a wide table has hundreds of them, too many to build call by call)
_COUNTERS = """named_struct(
  'rows', count(1), 'observed_nonmissing_rows', count(CASE WHEN {v} >= 0 THEN {v} END),
  'blank_rows', count_if({t} IS NULL OR {t} = ''), 'redacted_star_rows', count_if({t} = '*'),
  'zero_rows', count_if({v} = 0), 'negative_raw_rows', count_if({v} < 0),
  'non_numeric_raw_rows', count_if({t} NOT IN ('', '*') AND {v} IS NULL),
  'observed_sum', sum(CASE WHEN {v} >= 0 THEN {v} END), 'observed_min', min(CASE WHEN {v} >= 0 THEN {v} END),
  'observed_max', max(CASE WHEN {v} >= 0 THEN {v} END))"""


def audit_numeric_quality(df: DataFrame, dataset: str, columns: dict[str, str]) -> DataFrame:
    """Per raw column (``columns``: raw column -> audit label): rows, observed,
    blank, redacted, zero, negative and non-numeric counts, and sum / min / max
    of the observed values. All columns are counted side by side in one
    aggregate - rows are never multiplied by the number of columns - and its
    one row is unfolded into a row per column."""
    names = list(columns)
    text = df.selectExpr(*[f"trim(cast(`{c}` AS string)) AS t{i}" for i, c in enumerate(names)])
    number = text.selectExpr("*", *[f"try_cast(t{i} AS double) AS d{i}" for i in range(len(names))])
    parsed = number.selectExpr(*[f"t{i}" for i in range(len(names))], *[
        f"CASE WHEN NOT isnan(d{i}) AND abs(d{i}) <> double('infinity') THEN d{i} END AS v{i}" for i in range(len(names))])
    counted = parsed.selectExpr(*[_COUNTERS.format(v=f"v{i}", t=f"t{i}") + f" AS c{i}" for i in range(len(names))])
    label = lambda s: "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"
    rows = ", ".join(f"named_struct('column', {label(columns[c])}, 'm', c{i})" for i, c in enumerate(names))
    return (counted.selectExpr(f"explode(array({rows})) AS r")
            .select(F.lit(dataset).alias("dataset"), F.col("r.column").alias("column"), "r.m.*"))


def audit_quality_rollup(numeric_quality: DataFrame) -> DataFrame:
    """The numeric audit rolled up per dataset."""
    return numeric_quality.groupBy("dataset").agg(
        F.count(F.lit(1)).alias("numeric_columns"),
        F.sum("observed_nonmissing_rows").alias("observed_cells"),
        F.sum("zero_rows").alias("zero_cells"),
        F.sum("blank_rows").alias("blank_cells"),
        F.sum("redacted_star_rows").alias("redacted_star_cells"),
        F.sum("negative_raw_rows").alias("negative_raw_cells"),
        F.coalesce(F.sum("observed_sum"), F.lit(0.0)).alias("observed_sum_all_numeric"),
    )


def audit_country_mapping(df: DataFrame, dataset: str) -> DataFrame:
    """Rows per (role, mapping status, map flag); both roles from one scan."""
    def side(role):
        return F.struct(F.lit(role).alias("country_role"),
                        F.col(f"{role}_mapping_status").alias("mapping_status"),
                        F.col(f"{role}_map_eligible_flag").alias("map_eligible_flag"))
    roles = [r for r in ("host", "origin") if f"{r}_mapping_status" in df.columns]
    e = df.select(F.explode(F.array(*[side(r) for r in roles])).alias("e")).select("e.*")
    return (e.groupBy("country_role", "mapping_status", "map_eligible_flag")
            .agg(F.count(F.lit(1)).alias("rows"))
            .select(F.lit(dataset).alias("dataset"), "*"))


def audit_unmapped(raw: DataFrame, country_map: DataFrame, dataset: str,
                   roles: dict[str, str]) -> DataFrame:
    """Raw country labels with no entry in the map, with their row counts
    (``roles``: role -> raw column): one scan, labels counted before the anti join."""
    each = F.explode(F.array(*[F.struct(F.lit(role).alias("country_role"), F.col(c).alias("raw_country_value"))
                               for role, c in roles.items()]))
    labels = (raw.select(each.alias("e")).select("e.*").dropna(subset=["raw_country_value"])
              .groupBy("country_role", "raw_country_value").agg(F.count(F.lit(1)).alias("rows")))
    known = country_map.select("label_key").dropna().distinct()
    miss = labels.join(known, label_key("raw_country_value") == F.col("label_key"), "left_anti")
    return miss.select(F.lit(dataset).alias("dataset"), "country_role", "raw_country_value", "rows")


def country_labels(df: DataFrame, dataset: str, roles: dict[str, str]) -> DataFrame:
    """Every raw country label of a table with its rows, per role (``roles``:
    role -> raw column); a missing label is counted too. One scan, counted
    before the shuffle."""
    each = F.explode(F.array(*[F.struct(F.lit(role).alias("country_role"), F.col(c).alias("raw_country_value"))
                               for role, c in roles.items()]))
    return (df.select(each.alias("e")).select(F.lit(dataset).alias("dataset"), "e.*")
            .groupBy("dataset", "country_role", "raw_country_value").agg(F.count(F.lit(1)).alias("rows")))


def resolve_labels(labels: DataFrame, country_map: DataFrame) -> DataFrame:
    """``labels`` with ``country_std``, ``iso3``, ``mapping_status`` and
    ``map_eligible_flag``. Every distinct label, whatever the table and role it
    comes from, meets the map once. A label that the map lacks is ``unmapped``,
    a null or blank one ``missing``, neither is eligible; of several entries of
    one label the least counts."""
    entry = F.struct("country_std", "iso3", "mapping_status", "map_eligible_flag")
    known = country_map.filter("label_key IS NOT NULL").groupBy("label_key").agg(F.min(entry).alias("_e"))
    keyed = labels.withColumn("_key", label_key("raw_country_value"))
    keys = keyed.filter("_key <> ''").select("_key").distinct()
    found = keys.join(known, F.col("_key") == F.col("label_key")).select("_key", "_e")
    blank = F.coalesce(F.col("_key") == "", F.lit(True))
    return keyed.join(found, "_key", "left").select(
        *labels.columns, "_e.country_std", "_e.iso3",
        F.when(blank, F.lit("missing")).when(F.col("_e").isNull(), F.lit("unmapped")).otherwise(F.col("_e.mapping_status")).alias("mapping_status"),
        F.when(F.col("_e").isNull(), F.lit(False)).otherwise(F.col("_e.map_eligible_flag")).alias("map_eligible_flag"))


def audit_label_mapping(resolved: DataFrame) -> DataFrame:
    """``resolve_labels``' rows and labels per dataset, role, status and map flag."""
    return resolved.groupBy("dataset", "country_role", "mapping_status", "map_eligible_flag").agg(
        F.sum("rows").alias("rows"), F.count(F.lit(1)).alias("labels"))


def unmapped_labels(resolved: DataFrame) -> DataFrame:
    return resolved.filter("mapping_status = 'unmapped'").select("dataset", "country_role", "raw_country_value", "rows")


def _check(df1row: DataFrame, check: str, ok, detail) -> DataFrame:
    return df1row.select(F.lit(check).alias("check"),
                         F.when(ok, F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
                         detail.alias("detail"))


def check_no_row_loss(raw: DataFrame, clean: DataFrame, dataset: str) -> DataFrame:
    """raw row count = clean row count."""
    r = raw.agg(F.count(F.lit(1))).scalar()
    c = clean.agg(F.count(F.lit(1))).scalar()
    return _check(_one_row(raw), f"no_row_loss__{dataset}", r == c,
                  F.concat(F.lit("raw="), r.cast("string"), F.lit(", clean="), c.cast("string")))


def check_no_negative(df: DataFrame, dataset: str, columns: list[str]) -> DataFrame:
    """No negative observed value in any of ``columns``."""
    neg = reduce(lambda a, b: a + b, [F.count_if(F.col(c) < 0) for c in columns])
    n = df.agg(neg.alias("n"))
    return _check(n, f"no_negative_observed_values__{dataset}", F.col("n") == 0,
                  F.concat(F.lit("negative_cells="), F.col("n").cast("string")))


def validate_required_columns(df: DataFrame, dataset: str, required: list[str]) -> DataFrame:
    """Schema guard as a check row: the required columns missing from the
    table (``array_except`` of the required list and the table's columns)."""
    have = F.array(*[F.lit(c) for c in df.columns])
    need = F.array(*[F.lit(c) for c in required])
    missing = F.array_join(F.array_except(need, have), " | ")
    return _one_row(df).select(
        F.lit(f"required_columns__{dataset}").alias("check"),
        F.when(missing == "", F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status"),
        F.concat(F.lit("missing="), missing).alias("detail"))


def required_columns_checklist(tables: dict[str, DataFrame], required: dict[str, list[str]]) -> DataFrame:
    """Per table: rows, column count, required and missing columns, status."""
    parts = []
    for name, df in tables.items():
        have = F.array(*[F.lit(c) for c in df.columns])
        need = F.array(*[F.lit(c) for c in required[name]])
        missing = F.array_join(F.array_except(need, have), " | ")
        parts.append(df.agg(F.count(F.lit(1)).alias("rows")).select(
            F.lit(name).alias("dataset"), "rows", F.lit(len(df.columns)).alias("columns"),
            F.lit(" | ".join(required[name])).alias("required_columns"),
            missing.alias("missing_required_columns"),
            F.when(missing == "", F.lit("PASS")).otherwise(F.lit("FAIL")).alias("status")))
    return _union(parts)


def check_unmapped(unmapped: DataFrame) -> DataFrame:
    """Unmapped labels are kept (status ``unmapped``) and listed, so their
    presence is documented rather than a failure."""
    n = unmapped.agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.lit("country_mapping_unmapped_rows").alias("check"),
                    F.when(F.col("n") == 0, F.lit("PASS")).otherwise(F.lit("DOCUMENTED")).alias("status"),
                    F.concat(F.lit("unique_unmapped_values="), F.col("n").cast("string")).alias("detail"))


def check_decision_mismatch(reconciled: DataFrame) -> DataFrame:
    n = reconciled.agg(F.count_if("decision_total_mismatch_flag").alias("n"))
    return n.select(F.lit("asylum_decision_total_mismatch_documented").alias("check"),
                    F.lit("DOCUMENTED").alias("status"),
                    F.concat(F.lit("rows="), F.col("n").cast("string"),
                             F.lit("; reported total differs from its parts"))
                    .alias("detail"))


def check_literal_na(parsed: DataFrame, raw_col: str) -> DataFrame:
    a = parsed.agg(F.count_if(F.col(raw_col).endswith("/ NA")).alias("raw_na"),
                   F.count_if(F.col("stage") == "NEW").alias("parsed_new"))
    return a.select(F.lit("literal_NA_rsd_stage_protected").alias("check"),
                    F.when(F.col("raw_na") == F.col("parsed_new"), F.lit("PASS")).otherwise(F.lit("FAIL"))
                    .alias("status"),
                    F.concat(F.lit("raw '/ NA' rows="), F.col("raw_na").cast("string"),
                             F.lit(", parsed NEW rows="), F.col("parsed_new").cast("string")).alias("detail"))


def quality_gate(checks: list[DataFrame], head: int | None = None) -> DataFrame:
    """Union of check rows; a FAIL blocks the pipeline. ``head`` keeps the
    first rows in check order (the display shows 8)."""
    g = _union(checks).select("check", "status", "detail",
                              (F.col("status") == "FAIL").alias("blocks_pipeline"))
    if head:
        g = g.orderBy("check").limit(int(head))
    return g


def crosscheck_sources(a: DataFrame, b: DataFrame) -> DataFrame:
    """Annual sums per type from two independent tables; a side without the
    (year, type) cell counts as 0 in the difference."""
    sa = a.groupBy("year", "population_type_std").agg(
        F.coalesce(F.sum("value_observed"), F.lit(0.0)).alias("time_series_sum"))
    sb = b.groupBy("year", "population_type_std").agg(
        F.coalesce(F.sum("value_observed"), F.lit(0.0)).alias("persons_of_concern_long_sum"))
    j = sa.join(sb, ["year", "population_type_std"], "full_outer")
    return j.withColumn("absolute_difference", F.abs(
        F.coalesce(F.col("time_series_sum"), F.lit(0.0))
        - F.coalesce(F.col("persons_of_concern_long_sum"), F.lit(0.0))))


def coverage_by_component(components: dict[str, DataFrame]) -> DataFrame:
    """Rows available and year span per downstream component."""
    parts = [df.agg(F.count(F.lit(1)).alias("rows_available"), F.min("year").alias("year_min"),
                    F.max("year").alias("year_max")).select(F.lit(name).alias("component"), "*")
             for name, df in components.items()]
    return _union(parts)
