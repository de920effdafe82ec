"""Registered ingest / clean (§2.2) and audit (§2.3) queries with oracles."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.operators import audit as au
from flowatlas.operators import clean as cl
from flowatlas.plans.common import register, views
from flowatlas.schemas import STOCK_REQUIRED
from flowatlas.sources import gate
from flowatlas.sources.fixtures import DECISION_PARTS, DEMOGRAPHIC_COLUMNS, POC_COLUMNS

V = "value_observed"

# Columns of the fixture views (the oracle of the inventory audit names them).
DATASET_COLUMNS = {
    "stock": ["year", "population_type_std", "value_observed", "origin_country_std", "origin_iso3",
              "origin_mapping_status", "origin_map_eligible_flag", "host_country_std", "host_iso3",
              "host_mapping_status", "host_map_eligible_flag", "value_is_blank", "value_is_redacted",
              "value_is_zero", "value_is_negative_raw", "source_key", "source_line"],
    "decisions": ["year", "origin_country_std", "origin_iso3", "host_country_std", "host_iso3",
                  "applications_observed", "recognized_observed", "rejected_observed",
                  "other_decisions_observed", "otherwise_closed_observed", "total_decisions_reported",
                  "procedure_raw", "source_line"],
    "apps_monthly": ["year", "month", "host_country_std", "applications_monthly_observed"],
    "resettlement": ["year", "origin_country_std", "origin_iso3", "host_country_std", "host_iso3",
                     "resettlement_observed"],
    "raw_stock": ["year_raw", "origin_raw", "host_raw", "population_type_raw", "value_raw",
                  "procedure_raw", "source_key", "source_line"],
}
REQUIRED = {
    "stock": STOCK_REQUIRED,
    "decisions": ["year", "applications_observed", "recognized_observed", "rejected_observed",
                  "host_country_std", "origin_country_std"],
    "apps_monthly": ["year", "month", "applications_monthly_observed"],
    "resettlement": ["year", "resettlement_observed", "host_country_std", "origin_country_std"],
}
# The six raw tables' numeric columns (raw column -> audit label).
NUMERIC_AUDIT = {"year_raw": "Year", "value_raw": "Value"}
RAW_NUMERIC_AUDIT = {
    "raw_stock": NUMERIC_AUDIT, "raw_apps_monthly": NUMERIC_AUDIT, "raw_resettlement": NUMERIC_AUDIT,
    "raw_decisions": {"year_raw": "Year"} | {f"{c}_raw": c for c in [*DECISION_PARTS, "total_decisions"]},
    "raw_poc": {"year_raw": "Year"} | {f"{c}_raw": c for c in POC_COLUMNS},
    "raw_demographics": {"year_raw": "Year"} | {f"{c}_raw": c for c in DEMOGRAPHIC_COLUMNS}}
# Every dataset's year and measures (column -> audit label).
NUMERIC_AUDIT_ALL = {"raw_stock": NUMERIC_AUDIT} | {t: {"year": "Year"} | {c: c for c in cols} for t, cols in {
    "stock": ["value_observed"],
    "decisions": ["applications_observed", "recognized_observed", "rejected_observed", "other_decisions_observed",
                  "otherwise_closed_observed", "total_decisions_reported"],
    "apps_monthly": ["applications_monthly_observed"],
    "resettlement": ["resettlement_observed"],
    "poc_wide": list(cl.POC_TYPE_COLUMNS),
    "demographics_wide": [*cl.AGE_SEX_COLUMNS, "female_total", "male_total"]}.items()}
FAMILIES = {"stock": "population_stock", "decisions": "asylum_application_and_decision_flow",
            "apps_monthly": "asylum_application_flow_monthly", "resettlement": "durable_solution_flow",
            "demographics_wide": "demographics_stock"}
COMPONENTS = {"KPI cards": "stock", "Monthly asylum trend": "apps_monthly",
              "Demographics": "demographics_wide", "Resettlement": "resettlement",
              "Asylum decisions": "decisions"}


def measure_sql(raw: str) -> dict[str, str]:
    """SQL twins of ``clean.measure_columns`` (DuckDB)."""
    t = f"trim({raw})"
    p = f"try_cast({t} AS double)"
    q = f"(CASE WHEN isnan({p}) OR isinf({p}) THEN NULL ELSE {p} END)"
    blank = f"({raw} IS NULL OR {t} = '')"
    red = f"coalesce({t} = '*', false)"
    return {
        "observed": f"CASE WHEN {q} >= 0 THEN {q} END",
        "is_blank": blank,
        "is_redacted": red,
        "is_zero": f"coalesce({q} = 0, false)",
        "is_negative_raw": f"coalesce({q} < 0, false)",
        "is_non_numeric": f"coalesce(NOT {blank} AND NOT {red} AND {q} IS NULL, false)",
    }


_M = measure_sql("value_raw")


# ============================================================ §2.2 clean
@register("clean_measure", f"""
SELECT source_key, source_line, {_M['observed']} AS value_observed, {_M['is_blank']} AS value_is_blank,
       {_M['is_redacted']} AS value_is_redacted, {_M['is_zero']} AS value_is_zero,
       {_M['is_negative_raw']} AS value_is_negative_raw, {_M['is_non_numeric']} AS value_is_non_numeric
FROM raw_stock
""", views=("raw_stock",))
def q_clean_measure(spark, sf):
    raw = views(spark, sf).view("raw_stock")
    return cl.clean_measure(raw, "value_raw", "value").select(
        "source_key", "source_line", "value_observed", "value_is_blank", "value_is_redacted",
        "value_is_zero", "value_is_negative_raw", "value_is_non_numeric")


@register("protect_literal_na", """
SELECT trim(split_part(procedure_raw, ' / ', 1)) AS procedure,
       CASE WHEN trim(split_part(procedure_raw, ' / ', 2)) = 'NA' THEN 'NEW'
            ELSE trim(split_part(procedure_raw, ' / ', 2)) END AS stage,
       count(*) AS rows
FROM decisions GROUP BY 1, 2
""", views=("decisions",))
def q_protect_literal_na(spark, sf):
    d = cl.protect_literal_na(views(spark, sf).view("decisions"), "procedure_raw")
    return d.groupBy("procedure", "stage").agg(F.count(F.lit(1)).alias("rows"))


def _std_sql(role: str, a: str) -> str:
    hit = f"{a}.label_key IS NOT NULL"
    return (f"CASE WHEN {hit} THEN {a}.country_std ELSE trim(r.{role}_raw) END AS {role}_country_std, "
            f"CASE WHEN {hit} THEN {a}.iso3 ELSE 'UNMAPPED' END AS {role}_iso3, "
            f"CASE WHEN {hit} THEN {a}.mapping_status ELSE 'unmapped' END AS {role}_mapping_status, "
            f"CASE WHEN {hit} THEN {a}.map_eligible_flag ELSE false END AS {role}_map_eligible_flag")


@register("standardise_country", f"""
SELECT r.source_key, r.source_line, {_std_sql('origin', 'mo')}, {_std_sql('host', 'mh')}
FROM raw_stock r
LEFT JOIN country_map mo ON mo.label_key = upper(trim(r.origin_raw))
LEFT JOIN country_map mh ON mh.label_key = upper(trim(r.host_raw))
""", views=("raw_stock", "country_map"))
def q_standardise_country(spark, sf):
    cat = views(spark, sf)
    raw = cat.view("raw_stock").select("source_key", "source_line", "origin_raw", "host_raw")
    m = cat.view("country_map")
    d = cl.standardise_country(cl.standardise_country(raw, "origin", m), "host", m)
    return d.drop("origin_raw", "host_raw")


@register("melt_population_types", "\nUNION ALL\n".join(
    f"SELECT year, origin_country_std, host_country_std, '{t}' AS population_type_std, "
    f"cast({c} AS double) AS value_observed FROM poc_wide"
    for c, t in cl.POC_TYPE_COLUMNS.items()), views=("poc_wide",))
def q_melt_population_types(spark, sf):
    return cl.melt_population_types(views(spark, sf).view("poc_wide"),
                                    ["year", "origin_country_std", "host_country_std"])


_MELT_AGE = ", u AS (" + "\nUNION ALL\n".join(
    f"SELECT year, '{a}' AS age_group, '{s}' AS sex, {o} AS age_order, {c} AS v FROM demographics_wide"
    for c, (a, s, o) in cl.AGE_SEX_COLUMNS.items()) + ")"


@register("melt_age_sex", _MELT_AGE + """
SELECT year, age_group, sex, age_order, coalesce(sum(v), 0) AS value_observed FROM u
GROUP BY year, age_group, sex, age_order
""", views=("demographics_wide",))
def q_melt_age_sex(spark, sf):
    return cl.melt_age_sex(views(spark, sf).view("demographics_wide"))


@register("normalise_population_type", """
SELECT r.population_type_raw, coalesce(m.population_type_std, trim(r.population_type_raw)) AS population_type_std,
       count(*) AS rows
FROM raw_stock r LEFT JOIN population_type_map m ON m.population_type_raw = trim(r.population_type_raw)
GROUP BY 1, 2
""", views=("raw_stock", "population_type_map"))
def q_normalise_population_type(spark, sf):
    cat = views(spark, sf)
    d = cl.normalise_population_type(cat.view("raw_stock"), cat.view("population_type_map"))
    return d.groupBy("population_type_raw", "population_type_std").agg(F.count(F.lit(1)).alias("rows"))


_MONTH_CASE = "CASE " + " ".join(
    f"WHEN initcap(trim(month)) = '{m}' THEN {i}" for i, m in enumerate(cl.MONTHS, start=1)) + " END"
_MONTH_CASE = _MONTH_CASE.replace("initcap(trim(month))", "upper(substr(trim(month), 1, 1)) || lower(substr(trim(month), 2))")


@register("month_to_num", f"""
SELECT month, {_MONTH_CASE} AS month_num, count(*) AS rows FROM apps_monthly GROUP BY 1, 2
""", views=("apps_monthly",))
def q_month_to_num(spark, sf):
    d = cl.month_to_num(views(spark, sf).view("apps_monthly"), "month")
    return d.groupBy("month", "month_num").agg(F.count(F.lit(1)).alias("rows"))


@register("tag_metric_family", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, '{fam}' AS metric_family, count(*) AS rows FROM {t}"
    for t, fam in FAMILIES.items()), views=tuple(FAMILIES))
def q_tag_metric_family(spark, sf):
    cat = views(spark, sf)
    out = None
    for t, fam in FAMILIES.items():
        d = (cl.tag_metric_family(cat.view(t), fam).groupBy("metric_family")
             .agg(F.count(F.lit(1)).alias("rows")).select(F.lit(t).alias("dataset"), "metric_family", "rows"))
        out = d if out is None else out.unionByName(d)
    return out


_PARTS = ("coalesce(recognized_observed, 0) + coalesce(rejected_observed, 0) + "
          "coalesce(other_decisions_observed, 0) + coalesce(otherwise_closed_observed, 0)")
RECONCILED_SQL = f"""
, rec AS (SELECT *, coalesce(total_decisions_reported, {_PARTS}) AS total_decisions_final,
                 coalesce(total_decisions_reported <> ({_PARTS}), false) AS decision_total_mismatch_flag
          FROM decisions)
"""


@register("reconcile_decision_total", RECONCILED_SQL + """
SELECT year, sum(total_decisions_final) AS total_decisions_final,
       count(CASE WHEN decision_total_mismatch_flag THEN 1 END) AS decision_total_mismatch_rows,
       count(CASE WHEN total_decisions_reported IS NULL THEN 1 END) AS recomputed_rows
FROM rec GROUP BY year
""", views=("decisions",))
def q_reconcile_decision_total(spark, sf):
    d = cl.reconcile_decision_total(views(spark, sf).view("decisions"))
    return d.groupBy("year").agg(
        F.sum("total_decisions_final").alias("total_decisions_final"),
        F.count_if("decision_total_mismatch_flag").alias("decision_total_mismatch_rows"),
        F.count_if(F.col("total_decisions_reported").isNull()).alias("recomputed_rows"))


# ============================================================ §2.3 audits
def _inventory_sql():
    parts = []
    for name, cols in DATASET_COLUMNS.items():
        y = "try_cast(trim(year_raw) AS int)" if "year_raw" in cols else "year"
        parts.append(f"SELECT '{name}' AS dataset, count(*) AS rows, {len(cols)} AS columns, "
                     f"min({y}) AS year_min, max({y}) AS year_max, '{' | '.join(cols)}' AS raw_columns FROM {name}")
    return "\nUNION ALL\n".join(parts)


@register("audit_dataset_inventory", _inventory_sql(), views=tuple(DATASET_COLUMNS))
def q_audit_dataset_inventory(spark, sf):
    cat = views(spark, sf)
    return au.audit_dataset_inventory({n: cat.view(n) for n in DATASET_COLUMNS})


def _numeric_sql(dataset: str, table: str, columns: dict) -> str:
    parts = []
    for raw, label in columns.items():
        m = measure_sql(f"cast({raw} AS varchar)")
        parts.append(f"""SELECT '{dataset}' AS dataset, '{label}' AS "column", count(*) AS rows,
       count({m['observed']}) AS observed_nonmissing_rows,
       count(CASE WHEN {m['is_blank']} THEN 1 END) AS blank_rows,
       count(CASE WHEN {m['is_redacted']} THEN 1 END) AS redacted_star_rows,
       count(CASE WHEN {m['is_zero']} THEN 1 END) AS zero_rows,
       count(CASE WHEN {m['is_negative_raw']} THEN 1 END) AS negative_raw_rows,
       count(CASE WHEN {m['is_non_numeric']} THEN 1 END) AS non_numeric_raw_rows,
       sum({m['observed']}) AS observed_sum, min({m['observed']}) AS observed_min,
       max({m['observed']}) AS observed_max
FROM {table}""")
    return "\nUNION ALL\n".join(parts)


def _numeric_cte(audited: dict[str, dict]) -> str:
    return ", nq AS (" + "\nUNION ALL\n".join(_numeric_sql(t, t, cols) for t, cols in audited.items()) + ")"


def _numeric_quality_df(spark, sf, audited: dict[str, dict]):
    cat = views(spark, sf)
    out = None
    for t, cols in audited.items():
        d = au.audit_numeric_quality(cat.view(t), t, cols)
        out = d if out is None else out.unionByName(d)
    return out


_NQ = _numeric_cte(RAW_NUMERIC_AUDIT)


@register("audit_numeric_quality", _NQ + "\nSELECT * FROM nq", views=tuple(RAW_NUMERIC_AUDIT))
def q_audit_numeric_quality(spark, sf):
    return _numeric_quality_df(spark, sf, RAW_NUMERIC_AUDIT)


_ROLLUP_SQL = """
SELECT dataset, count(*) AS numeric_columns, cast(sum(observed_nonmissing_rows) AS bigint) AS observed_cells,
       cast(sum(zero_rows) AS bigint) AS zero_cells, cast(sum(blank_rows) AS bigint) AS blank_cells,
       cast(sum(redacted_star_rows) AS bigint) AS redacted_star_cells,
       cast(sum(negative_raw_rows) AS bigint) AS negative_raw_cells, coalesce(sum(observed_sum), 0) AS observed_sum_all_numeric
FROM nq GROUP BY dataset
"""


@register("audit_quality_rollup", _NQ + _ROLLUP_SQL, views=tuple(RAW_NUMERIC_AUDIT))
def q_audit_quality_rollup(spark, sf):
    return au.audit_quality_rollup(_numeric_quality_df(spark, sf, RAW_NUMERIC_AUDIT))


_NQ_ALL = _numeric_cte(NUMERIC_AUDIT_ALL)


@register("audit_numeric_quality_all", _NQ_ALL + "\nSELECT * FROM nq", views=tuple(NUMERIC_AUDIT_ALL))
def q_audit_numeric_quality_all(spark, sf):
    return _numeric_quality_df(spark, sf, NUMERIC_AUDIT_ALL)


@register("audit_quality_rollup_all", _NQ_ALL + _ROLLUP_SQL, views=tuple(NUMERIC_AUDIT_ALL))
def q_audit_quality_rollup_all(spark, sf):
    return au.audit_quality_rollup(_numeric_quality_df(spark, sf, NUMERIC_AUDIT_ALL))


@register("audit_country_mapping", """
SELECT 'stock' AS dataset, 'host' AS country_role, host_mapping_status AS mapping_status,
       host_map_eligible_flag AS map_eligible_flag, count(*) AS rows
FROM stock GROUP BY 3, 4
UNION ALL
SELECT 'stock', 'origin', origin_mapping_status, origin_map_eligible_flag, count(*)
FROM stock GROUP BY 3, 4
""")
def q_audit_country_mapping(spark, sf):
    return au.audit_country_mapping(views(spark, sf).stock(), "stock")


_UNMAPPED_SQL = "\nUNION ALL\n".join(f"""
SELECT 'raw_stock' AS dataset, '{role}' AS country_role, {role}_raw AS raw_country_value, count(*) AS rows
FROM raw_stock r WHERE {role}_raw IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM country_map m WHERE m.label_key = upper(trim(r.{role}_raw)))
GROUP BY {role}_raw""" for role in ("origin", "host"))


def _unmapped_df(cat):
    return au.audit_unmapped(cat.view("raw_stock"), cat.view("country_map"), "raw_stock",
                             {"origin": "origin_raw", "host": "host_raw"})


@register("audit_unmapped", _UNMAPPED_SQL, views=("raw_stock", "country_map"))
def q_audit_unmapped(spark, sf):
    return _unmapped_df(views(spark, sf))


# raw tables and the column of each country role
RAW_COUNTRIES = {"raw_stock": {"origin": "origin_raw", "host": "host_raw"}, "raw_decisions": {"origin": "origin_raw", "host": "host_raw"},
                 "raw_apps_monthly": {"host": "host_raw"}, "raw_resettlement": {"origin": "origin_raw", "host": "host_raw"},
                 "raw_poc": {"origin": "origin_raw", "host": "host_raw"}, "raw_demographics": {"host": "host_raw"}}
_LABELS_SQL = ", lab AS (" + "\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, '{role}' AS country_role, {c} AS raw_country_value, count(*) AS rows FROM {t} GROUP BY {c}"
    for t, roles in RAW_COUNTRIES.items() for role, c in roles.items()) + """)
, res AS (SELECT lab.*, CASE WHEN coalesce(trim(raw_country_value), '') = '' THEN 'missing'
                             WHEN m.label_key IS NULL THEN 'unmapped' ELSE m.mapping_status END AS mapping_status,
                 CASE WHEN m.label_key IS NULL THEN false ELSE m.map_eligible_flag END AS map_eligible_flag
          FROM lab LEFT JOIN country_map m ON m.label_key = upper(trim(lab.raw_country_value)))
"""


def _resolved_labels(spark, sf):
    cat = views(spark, sf)
    labels = reduce(DataFrame.unionByName, [au.country_labels(cat.view(t), t, roles) for t, roles in RAW_COUNTRIES.items()])
    return au.resolve_labels(labels, cat.view("country_map"))


@register("audit_country_mapping_all", _LABELS_SQL + """
SELECT dataset, country_role, mapping_status, map_eligible_flag, cast(sum(rows) AS bigint) AS rows, count(*) AS labels
FROM res GROUP BY dataset, country_role, mapping_status, map_eligible_flag
""", views=(*RAW_COUNTRIES, "country_map"))
def q_audit_country_mapping_all(spark, sf):
    return au.audit_label_mapping(_resolved_labels(spark, sf))


@register("audit_unmapped_all", _LABELS_SQL + """
SELECT dataset, country_role, raw_country_value, rows FROM res WHERE mapping_status = 'unmapped'
""", views=(*RAW_COUNTRIES, "country_map"))
def q_audit_unmapped_all(spark, sf):
    return au.unmapped_labels(_resolved_labels(spark, sf))


@register("check_no_row_loss", """
SELECT 'no_row_loss__stock' AS "check",
       CASE WHEN (SELECT count(*) FROM raw_stock) = (SELECT count(*) FROM stock) THEN 'PASS' ELSE 'FAIL' END AS status,
       'raw=' || cast((SELECT count(*) FROM raw_stock) AS varchar) || ', clean=' ||
       cast((SELECT count(*) FROM stock) AS varchar) AS detail
""", views=("raw_stock", "stock"))
def q_check_no_row_loss(spark, sf):
    cat = views(spark, sf)
    return au.check_no_row_loss(cat.view("raw_stock"), cat.stock(), "stock")


NEGATIVE_COLUMNS = {"stock": ["value_observed"],
                    "decisions": ["applications_observed", "recognized_observed", "rejected_observed",
                                  "other_decisions_observed", "otherwise_closed_observed"],
                    "resettlement": ["resettlement_observed"],
                    "apps_monthly": ["applications_monthly_observed"]}


NEGATIVE_COLUMNS_WIDE = {t: [c for c in NUMERIC_AUDIT_ALL[t] if c != "year"] for t in ("poc_wide", "demographics_wide")}


def _negative_sql(columns=NEGATIVE_COLUMNS):
    parts = []
    for t, cols in columns.items():
        n = " + ".join(f"count(CASE WHEN {c} < 0 THEN 1 END)" for c in cols)
        parts.append(f"SELECT 'no_negative_observed_values__{t}' AS \"check\", "
                     f"CASE WHEN {n} = 0 THEN 'PASS' ELSE 'FAIL' END AS status, "
                     f"'negative_cells=' || cast({n} AS varchar) AS detail FROM {t}")
    return "\nUNION ALL\n".join(parts)


def _negative_dfs(cat, columns=NEGATIVE_COLUMNS):
    return [au.check_no_negative(cat.view(t), t, cols) for t, cols in columns.items()]


@register("check_no_negative", _negative_sql(), views=tuple(NEGATIVE_COLUMNS))
def q_check_no_negative(spark, sf):
    dfs = _negative_dfs(views(spark, sf))
    out = dfs[0]
    for d in dfs[1:]:
        out = out.unionByName(d)
    return out


def _required_sql():
    parts = []
    for t, req in REQUIRED.items():
        missing = [c for c in req if c not in DATASET_COLUMNS[t]]
        parts.append(f"SELECT 'required_columns__{t}' AS \"check\", "
                     f"'{'PASS' if not missing else 'FAIL'}' AS status, 'missing={' | '.join(missing)}' AS detail")
    return "\nUNION ALL\n".join(parts)


@register("validate_required_columns", "\nUNION ALL\n".join(
    f"SELECT '{t}' AS dataset, count(*) AS rows, {len(DATASET_COLUMNS[t])} AS columns, "
    f"'{' | '.join(req)}' AS required_columns, "
    f"'{' | '.join(c for c in req if c not in DATASET_COLUMNS[t])}' AS missing_required_columns, "
    f"'{'PASS' if all(c in DATASET_COLUMNS[t] for c in req) else 'FAIL'}' AS status FROM {t}"
    for t, req in REQUIRED.items()), views=tuple(REQUIRED))
def q_validate_required_columns(spark, sf):
    cat = views(spark, sf)
    return au.required_columns_checklist({t: cat.view(t) for t in REQUIRED}, REQUIRED)


_GATE_CHECKS_SQL = RECONCILED_SQL + f"""
, checks AS (
SELECT 'no_row_loss__stock' AS "check",
       CASE WHEN (SELECT count(*) FROM raw_stock) = (SELECT count(*) FROM stock) THEN 'PASS' ELSE 'FAIL' END AS status,
       'raw=' || cast((SELECT count(*) FROM raw_stock) AS varchar) || ', clean=' ||
       cast((SELECT count(*) FROM stock) AS varchar) AS detail
UNION ALL
{_negative_sql()}
UNION ALL
{_required_sql()}
UNION ALL
SELECT 'country_mapping_unmapped_rows',
       CASE WHEN (SELECT count(*) FROM ({_UNMAPPED_SQL}) u) = 0 THEN 'PASS' ELSE 'DOCUMENTED' END,
       'unique_unmapped_values=' || cast((SELECT count(*) FROM ({_UNMAPPED_SQL}) u) AS varchar)
UNION ALL
SELECT 'asylum_decision_total_mismatch_documented', 'DOCUMENTED',
       'rows=' || cast(count(CASE WHEN decision_total_mismatch_flag THEN 1 END) AS varchar)
       || '; reported total differs from its parts' FROM rec
UNION ALL
SELECT 'literal_NA_rsd_stage_protected',
       CASE WHEN count(CASE WHEN procedure_raw LIKE '%/ NA' THEN 1 END)
               = count(CASE WHEN trim(split_part(procedure_raw, ' / ', 2)) = 'NA' THEN 1 END) THEN 'PASS' ELSE 'FAIL' END,
       'raw ''/ NA'' rows=' || cast(count(CASE WHEN procedure_raw LIKE '%/ NA' THEN 1 END) AS varchar)
       || ', parsed NEW rows=' || cast(count(CASE WHEN trim(split_part(procedure_raw, ' / ', 2)) = 'NA' THEN 1 END) AS varchar)
FROM decisions"""
_GATE_SQL = """)
SELECT "check", status, detail, status = 'FAIL' AS blocks_pipeline FROM checks
"""
_GATE_VIEWS = ("raw_stock", "stock", "decisions", "resettlement", "apps_monthly", "country_map")


def _gate_dfs(cat):
    checks = [au.check_no_row_loss(cat.view("raw_stock"), cat.stock(), "stock")]
    checks += _negative_dfs(cat)
    checks += [au.validate_required_columns(cat.view(t), t, req) for t, req in REQUIRED.items()]
    checks.append(au.check_unmapped(_unmapped_df(cat)))
    checks.append(au.check_decision_mismatch(cl.reconcile_decision_total(cat.view("decisions"))))
    checks.append(au.check_literal_na(cl.protect_literal_na(cat.view("decisions"), "procedure_raw"),
                                      "procedure_raw"))
    return checks


@register("quality_gate", _GATE_CHECKS_SQL + _GATE_SQL, views=_GATE_VIEWS)
def q_quality_gate(spark, sf):
    return au.quality_gate(_gate_dfs(views(spark, sf)))


@register("quality_gate_all", _GATE_CHECKS_SQL + "\nUNION ALL\n" + _negative_sql(NEGATIVE_COLUMNS_WIDE) + _GATE_SQL,
          views=(*_GATE_VIEWS, *NEGATIVE_COLUMNS_WIDE))
def q_quality_gate_all(spark, sf):
    cat = views(spark, sf)
    return au.quality_gate(_gate_dfs(cat) + _negative_dfs(cat, NEGATIVE_COLUMNS_WIDE))


_OVERALL_SQL = """
SELECT 'overall' AS "check", CASE WHEN bool_or(status = 'FAIL') THEN 'FAIL' ELSE 'PASS' END AS status,
       'blocking_checks=' || cast(count(CASE WHEN status = 'FAIL' THEN 1 END) AS varchar) AS detail,
       coalesce(bool_or(status = 'FAIL'), false) AS blocks_pipeline FROM checks"""


@register("quality_gate_overall", _GATE_CHECKS_SQL + "\nUNION ALL\n" + _negative_sql(NEGATIVE_COLUMNS_WIDE) + ")" + _OVERALL_SQL,
          views=(*_GATE_VIEWS, *NEGATIVE_COLUMNS_WIDE))
def q_quality_gate_overall(spark, sf):
    """The one verdict that the next step of a pipeline asks for."""
    return gate.overall(q_quality_gate_all(spark, sf))


@register("quality_gate_published", ", checks AS (\n" + _negative_sql(NEGATIVE_COLUMNS | NEGATIVE_COLUMNS_WIDE) + """
UNION ALL
SELECT 'no_row_loss__stock',
       CASE WHEN (SELECT count(*) FROM raw_stock) = (SELECT count(*) FROM stock) THEN 'PASS' ELSE 'FAIL' END,
       'raw=' || cast((SELECT count(*) FROM raw_stock) AS varchar) || ', clean=' || cast((SELECT count(*) FROM stock) AS varchar)
UNION ALL
SELECT 'year_missing__stock', CASE WHEN count(CASE WHEN year IS NULL THEN 1 END) = 0 THEN 'PASS' ELSE 'DOCUMENTED' END,
       'rows=' || cast(count(CASE WHEN year IS NULL THEN 1 END) AS varchar) FROM stock)
SELECT "check", status, detail, status = 'FAIL' AS blocks_pipeline FROM checks
UNION ALL""" + _OVERALL_SQL, views=("raw_stock", *NEGATIVE_COLUMNS, *NEGATIVE_COLUMNS_WIDE))
def q_quality_gate_published(spark, sf):
    """What the jobs that wrote the silver tables counted, and the verdict."""
    return views(spark, sf).gate()


@register("crosscheck_sources", """
, a AS (SELECT year, population_type_std, coalesce(sum(value_observed), 0) AS s FROM stock
        GROUP BY year, population_type_std)
, l AS (""" + "\nUNION ALL\n".join(
    f"SELECT year, '{t}' AS population_type_std, cast({c} AS double) AS v FROM poc_wide"
    for c, t in cl.POC_TYPE_COLUMNS.items()) + """)
, b AS (SELECT year, population_type_std, coalesce(sum(v), 0) AS s FROM l GROUP BY year, population_type_std)
SELECT coalesce(a.year, b.year) AS year, coalesce(a.population_type_std, b.population_type_std) AS population_type_std,
       a.s AS time_series_sum, b.s AS persons_of_concern_long_sum,
       abs(coalesce(a.s, 0) - coalesce(b.s, 0)) AS absolute_difference
FROM a FULL OUTER JOIN b ON a.year = b.year AND a.population_type_std = b.population_type_std
""", views=("stock", "poc_wide"))
def q_crosscheck_sources(spark, sf):
    cat = views(spark, sf)
    long = cl.melt_population_types(cat.view("poc_wide"), ["year", "origin_country_std", "host_country_std"])
    return au.crosscheck_sources(cat.stock(), long)


@register("coverage_by_component", "\nUNION ALL\n".join(
    f"SELECT '{c}' AS component, count(*) AS rows_available, min(year) AS year_min, max(year) AS year_max FROM {t}"
    for c, t in COMPONENTS.items()), views=tuple(set(COMPONENTS.values())))
def q_coverage_by_component(spark, sf):
    cat = views(spark, sf)
    return au.coverage_by_component({c: cat.view(t) for c, t in COMPONENTS.items()})



