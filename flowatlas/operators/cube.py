"""The stock cube: cells rolled up to (year, population type, origin entity,
host entity).

Every ranking, corridor, KPI, trend, concentration, role, network and
corridor-year query aggregates cells to a subset of these keys with sums
only, and sums re-aggregate exactly (integer-valued counts), so those
queries can read the cube instead of the cells. Its size is bounded by
countries^2 x years x types - tens of millions of rows at full scale,
whatever the number of cells - so a query that scanned the whole cell table
reads megabytes instead.

``value_observed`` keeps the null-when-all-missing semantics of a sum, so
``coalesce(sum(value_observed), 0)`` over cube rows equals the same over
cells. Row counts are kept as separate additive columns for callers that
need them.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.sources.bucketed import Buckets

ENTITY_COLUMNS = ["country_std", "iso3", "mapping_status", "map_eligible_flag"]
CUBE_KEYS = (["year", "population_type_std"]
             + [f"origin_{c}" for c in ENTITY_COLUMNS] + [f"host_{c}" for c in ENTITY_COLUMNS])


def build_cube(stock: DataFrame) -> DataFrame:
    """One partial + final aggregation of the cells (null keys form their
    own groups, as the cells would)."""
    return stock.groupBy(*CUBE_KEYS).agg(
        F.sum("value_observed").alias("value_observed"),
        F.count(F.lit(1)).alias("source_rows"),
        F.count("value_observed").alias("observed_rows"),
        F.count_if(F.col("value_is_redacted")).alias("redacted_rows"),
        F.count_if(F.col("value_is_blank")).alias("blank_rows"),
        F.count_if(F.col("value_is_zero")).alias("zero_rows"),
    )


#: the corridor table is dealt by these columns; at most countries^2 x years x
#: types rows (some tens of millions) share the buckets
CORRIDOR_BUCKETS = Buckets(16, ("origin_country_std", "host_country_std"), ("origin_country_std", "host_country_std", "year"))


def build_corridors(cube: DataFrame) -> DataFrame:
    """Totals per (year, population type, origin, host) of rows that name all
    of year, origin and host: what corridor-years are made of."""
    return (cube.dropna(subset=["year", *CORRIDOR_BUCKETS.by])
            .groupBy("year", "population_type_std", *CORRIDOR_BUCKETS.by)
            .agg(F.sum("value_observed").alias("value_observed")))


def row_count(df: DataFrame):
    """Rows behind a group: ``count(*)`` over cells, ``sum(source_rows)``
    over the cube."""
    return F.sum("source_rows") if "source_rows" in df.columns else F.count(F.lit(1))


def observed_count(df: DataFrame, value: str = "value_observed"):
    return F.sum("observed_rows") if "observed_rows" in df.columns else F.count(value)


def flag_count(df: DataFrame, flag: str):
    """Cells with ``value_is_<flag>``: ``count_if`` over cells, the additive
    ``<flag>_rows`` column over the cube."""
    col = f"{flag}_rows"
    return F.sum(col) if col in df.columns else F.count_if(F.col(f"value_is_{flag}"))
