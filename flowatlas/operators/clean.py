"""Ingest / clean: raw strings -> typed measures with flags, standard
country entities, long population types, age x sex groups, month numbers.

All projections; the only joins are broadcast joins against small maps
(country labels, population-type labels, the 16 age x sex columns), whose
size is bounded by the label vocabulary, not by the data.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowatlas.functions.columns import col, finite_or_null
from flowatlas.schemas import UNMAPPED_ISO

# English month names in calendar order.
MONTHS = ["January", "February", "March", "April", "May", "June",
          "July", "August", "September", "October", "November", "December"]

# Wide population-type columns of the persons-of-concern
# table -> standard population type.
POC_TYPE_COLUMNS = {
    "refugees": "Refugees",
    "asylum_seekers": "Asylum-seekers",
    "returned_refugees": "Returned refugees",
    "idps": "IDPs",
    "returned_idps": "Returned IDPs",
    "stateless": "Stateless persons",
    "others_of_concern": "Others of concern",
}

# Demographic columns -> (age group, sex, age order). The
# 5-17 group is the sum of its 5-11 and 12-17 parts and of cells reported
# only as 5-17; totals are not an age group.
AGE_SEX_COLUMNS = {
    "female_0_4": ("0-4", "Female", 1), "female_5_11": ("5-17", "Female", 2),
    "female_5_17": ("5-17", "Female", 2), "female_12_17": ("5-17", "Female", 2),
    "female_18_59": ("18-59", "Female", 3), "female_60": ("60+", "Female", 4),
    "female_unknown": ("Unknown", "Female", 5),
    "male_0_4": ("0-4", "Male", 1), "male_5_11": ("5-17", "Male", 2),
    "male_5_17": ("5-17", "Male", 2), "male_12_17": ("5-17", "Male", 2),
    "male_18_59": ("18-59", "Male", 3), "male_60": ("60+", "Male", 4),
    "male_unknown": ("Unknown", "Male", 5),
}


def measure_columns(raw, out: str) -> dict:
    """Column expressions of ``clean_measure`` for one raw string column."""
    t = F.trim(col(raw))
    parsed = finite_or_null(t.try_cast(T.DoubleType()))
    blank = col(raw).isNull() | (t == "")
    redacted = t == "*"
    non_numeric = ~blank & ~redacted & parsed.isNull()
    return {
        f"{out}_observed": F.when(parsed >= 0, parsed),
        f"{out}_is_blank": blank,
        f"{out}_is_redacted": F.coalesce(redacted, F.lit(False)),
        f"{out}_is_zero": F.coalesce(parsed == 0, F.lit(False)),
        f"{out}_is_negative_raw": F.coalesce(parsed < 0, F.lit(False)),
        f"{out}_is_non_numeric": F.coalesce(non_numeric, F.lit(False)),
    }


def clean_measure(df: DataFrame, raw_col: str, out: str) -> DataFrame:
    """Raw count string -> ``{out}_observed`` plus flags. Blank, ``*``,
    non-numeric and negative become null with a flag; zero is data."""
    cols = measure_columns(raw_col, out)
    return df.select("*", *[e.alias(k) for k, e in cols.items()])


def protect_literal_na(df: DataFrame, c: str) -> DataFrame:
    """``"G / NA"`` procedure codes: the literal stage ``NA`` means a new
    application and becomes ``NEW`` (it is not a missing value)."""
    proc = F.trim(F.split_part(col(c), F.lit(" / "), F.lit(1)))
    stage = F.trim(F.split_part(col(c), F.lit(" / "), F.lit(2)))
    return df.select("*", proc.alias("procedure"),
                     F.when(stage == "NA", F.lit("NEW")).otherwise(stage).alias("stage"))


def label_key(c) -> F.Column:
    """Normalised country label used as the join key of the country map."""
    return F.upper(F.trim(col(c)))


def unique_key(table: DataFrame, key: str) -> DataFrame:
    """``table``, one row per ``key``; fails when a key has two different rows
    (a join would multiply the other side's rows)."""
    rest = [c for c in table.columns if c != key]
    g = table.filter(F.col(key).isNotNull()).groupBy(key).agg(
        F.count_distinct(F.struct(*[F.struct(F.col(c)) for c in rest])).alias("_n"), *[F.first(c).alias(c) for c in rest])
    bad = F.raise_error(F.concat(F.lit(f"two rows for one {key.strip('_')}: "), F.col(key).cast("string")))
    return g.select(F.when(F.col("_n") > 1, bad.cast(table.schema[key].dataType)).otherwise(F.col(key)).alias(key), *rest)


def standardise_country(df: DataFrame, role: str, country_map: DataFrame,
                        raw_col: str | None = None) -> DataFrame:
    """Raw label -> ``{role}_country_std, _iso3, _mapping_status,
    _map_eligible_flag`` by a left join on the normalised label (a
    label that the map has twice is refused).
    Unmatched labels keep their trimmed text and become ``unmapped``."""
    raw_col = raw_col or f"{role}_raw"
    m = country_map.select(
        F.col("label_key").alias(f"_{role}_key"),
        F.col("country_std").alias(f"_{role}_std"), F.col("iso3").alias(f"_{role}_iso"),
        F.col("mapping_status").alias(f"_{role}_st"), F.col("map_eligible_flag").alias(f"_{role}_fl"),
        F.lit(True).alias(f"_{role}_hit"))
    j = df.join(unique_key(m, f"_{role}_key"), label_key(raw_col) == F.col(f"_{role}_key"), "left")
    hit = F.col(f"_{role}_hit").isNotNull()
    out = j.select(
        *[F.col(c) for c in df.columns],
        F.when(hit, F.col(f"_{role}_std")).otherwise(F.trim(col(raw_col))).alias(f"{role}_country_std"),
        F.when(hit, F.col(f"_{role}_iso")).otherwise(F.lit(UNMAPPED_ISO)).alias(f"{role}_iso3"),
        F.when(hit, F.col(f"_{role}_st")).otherwise(F.lit("unmapped")).alias(f"{role}_mapping_status"),
        F.when(hit, F.col(f"_{role}_fl")).otherwise(F.lit(False)).alias(f"{role}_map_eligible_flag"),
    )
    return out


def melt_population_types(df: DataFrame, id_cols: list[str],
                          columns: dict[str, str] | None = None) -> DataFrame:
    """Wide population-type columns -> long (one row per id and type)."""
    columns = columns or POC_TYPE_COLUMNS
    renamed = df.select(*id_cols, *[F.col(c).cast(T.DoubleType()).alias(t) for c, t in columns.items()])
    return renamed.unpivot(id_cols, list(columns.values()), "population_type_std", "value_observed")


def melt_age_sex(df: DataFrame, id_cols: list[str] | None = None,
                 columns: dict | None = None) -> DataFrame:
    """16 age x sex columns -> (year, age_group, sex, age_order, value),
    summed per year (and ``id_cols``). The column map is a 14-row fixed
    dimension, broadcast."""
    columns = columns or AGE_SEX_COLUMNS
    id_cols = id_cols or ["year"]
    spark = df.sparkSession
    dim = spark.createDataFrame(
        [(c, a, s, o) for c, (a, s, o) in columns.items()],
        "source_column string, age_group string, sex string, age_order int")
    long = df.unpivot(id_cols, list(columns), "source_column", "value_observed")
    return (long.join(F.broadcast(dim), "source_column")
            .groupBy(*id_cols, "age_group", "sex", "age_order")
            .agg(F.coalesce(F.sum("value_observed"), F.lit(0.0)).alias("value_observed")))


def normalise_population_type(df: DataFrame, type_map: DataFrame,
                              raw_col: str = "population_type_raw") -> DataFrame:
    """Raw population-type label -> standard label (map join; a label that
    the map has twice is refused); unknown labels are kept as they are."""
    m = type_map.select(F.col("population_type_raw").alias("_raw"),
                        F.col("population_type_std").alias("_std"))
    j = df.join(unique_key(m, "_raw"), F.trim(col(raw_col)) == F.col("_raw"), "left")
    return j.select(*[F.col(c) for c in df.columns],
                    F.coalesce(F.col("_std"), F.trim(col(raw_col))).alias("population_type_std"))


def month_number(c) -> F.Column:
    """Month name (any case) -> 1..12, null when not a month name."""
    m = F.initcap(F.trim(col(c)))
    expr = None
    for i, name in enumerate(MONTHS, start=1):
        expr = F.when(m == name, F.lit(i)) if expr is None else expr.when(m == name, F.lit(i))
    return expr


def month_to_num(df: DataFrame, c: str = "month") -> DataFrame:
    return df.withColumn("month_num", month_number(c))


def tag_metric_family(df: DataFrame, family: str) -> DataFrame:
    return df.withColumn("metric_family", F.lit(family))


def reconcile_decision_total(df: DataFrame) -> DataFrame:
    """Final total = reported total, or the sum of the four outcomes when
    none is reported; a reported total that differs is flagged, not fixed."""
    parts = (F.coalesce(F.col("recognized_observed"), F.lit(0.0))
             + F.coalesce(F.col("rejected_observed"), F.lit(0.0))
             + F.coalesce(F.col("other_decisions_observed"), F.lit(0.0))
             + F.coalesce(F.col("otherwise_closed_observed"), F.lit(0.0)))
    rep = F.col("total_decisions_reported")
    return df.select("*", F.coalesce(rep, parts).alias("total_decisions_final"),
                     F.coalesce(rep != parts, F.lit(False)).alias("decision_total_mismatch_flag"))
