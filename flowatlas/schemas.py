"""Schemas, parameters and small fixed dimensions of the data model.

Everything here is either a ``StructType`` (read schemas are explicit, never
inferred), the ``Filters`` parameter record every query takes, or a fixed
dimension whose size is known when the code is written (scopes, bands,
months). Fixed dimensions become tiny DataFrames that are broadcast-joined;
their size bound is the literal list below, not a runtime guess.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

from pyspark.sql import types as T

# ---------------------------------------------------------------- driver tables
DRIVER_SCHEMAS: dict[str, T.StructType] = {
    "region": T.StructType([
        T.StructField("r_regionkey", T.IntegerType()),
        T.StructField("r_name", T.StringType()),
    ]),
    "nation": T.StructType([
        T.StructField("n_nationkey", T.IntegerType()),
        T.StructField("n_name", T.StringType()),
        T.StructField("n_regionkey", T.IntegerType()),
    ]),
    "customer": T.StructType([
        T.StructField("c_custkey", T.LongType()),
        T.StructField("c_name", T.StringType()),
        T.StructField("c_nationkey", T.IntegerType()),
        T.StructField("c_acctbal", T.DoubleType()),
        T.StructField("c_mktsegment", T.StringType()),
    ]),
    "supplier": T.StructType([
        T.StructField("s_suppkey", T.LongType()),
        T.StructField("s_name", T.StringType()),
        T.StructField("s_nationkey", T.IntegerType()),
        T.StructField("s_acctbal", T.DoubleType()),
    ]),
    "part": T.StructType([
        T.StructField("p_partkey", T.LongType()),
        T.StructField("p_name", T.StringType()),
        T.StructField("p_brand", T.StringType()),
        T.StructField("p_type", T.StringType()),
        T.StructField("p_size", T.IntegerType()),
        T.StructField("p_retailprice", T.DoubleType()),
    ]),
    "orders": T.StructType([
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderstatus", T.StringType()),
        T.StructField("o_totalprice", T.DoubleType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_orderpriority", T.StringType()),
    ]),
    "lineitem": T.StructType([
        T.StructField("l_orderkey", T.LongType()),
        T.StructField("l_partkey", T.LongType()),
        T.StructField("l_suppkey", T.LongType()),
        T.StructField("l_linenumber", T.IntegerType()),
        T.StructField("l_quantity", T.DoubleType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_discount", T.DoubleType()),
        T.StructField("l_tax", T.DoubleType()),
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
    ]),
}

# ------------------------------------------------------------ data-model schema
STOCK_REQUIRED = [
    "year", "population_type_std", "value_observed",
    "host_country_std", "host_iso3", "host_map_eligible_flag",
    "origin_country_std", "origin_iso3", "origin_map_eligible_flag",
]

STOCK_SCHEMA = T.StructType(
    [T.StructField("year", T.IntegerType()), T.StructField("population_type_std", T.StringType()),
     T.StructField("value_observed", T.DoubleType())]
    + [T.StructField(f"{r}_{c}", t) for r in ("origin", "host")
       for c, t in (("country_std", T.StringType()), ("iso3", T.StringType()),
                    ("mapping_status", T.StringType()), ("map_eligible_flag", T.BooleanType()))]
    + [T.StructField(f"value_is_{c}", T.BooleanType()) for c in ("blank", "redacted", "zero", "negative_raw")]
    + [T.StructField("source_key", T.LongType()), T.StructField("source_line", T.IntegerType())])

# Raw tables are read as all-string columns: parsing is an explicit step.
RAW_STOCK_SCHEMA = T.StructType([
    T.StructField("year_raw", T.StringType()),
    T.StructField("origin_raw", T.StringType()),
    T.StructField("host_raw", T.StringType()),
    T.StructField("population_type_raw", T.StringType()),
    T.StructField("value_raw", T.StringType()),
    T.StructField("procedure_raw", T.StringType()),
    T.StructField("source_key", T.StringType()),
    T.StructField("source_line", T.StringType()),
])

# --------------------------------------------------------------- fixed values
POP_REFUGEES = "Refugees"
POP_ASYLUM = "Asylum-seekers"
POP_IDPS = "IDPs"
POP_OTHERS = "Others of concern"

# Population scopes (scope name -> member types); an unknown
# scope falls back to the cross-border scope.
CROSS_BORDER_TYPES = [POP_REFUGEES, POP_ASYLUM, POP_OTHERS]
ACTIVE_FORCED_TYPES = [POP_REFUGEES, POP_ASYLUM, POP_IDPS, POP_OTHERS]
SCOPES = {
    "All cross-border": CROSS_BORDER_TYPES,
    "Refugees": [POP_REFUGEES],
    "Asylum-seekers": [POP_ASYLUM],
    "Others of concern": [POP_OTHERS],
    "Active forced incl. IDPs": ACTIVE_FORCED_TYPES,
}
DEFAULT_SCOPE = "All cross-border"
ACTIVE_SCOPE = "Active forced incl. IDPs"

# Mapping statuses that exclude an entity from rankings.
EXCLUDED_STATUSES = ["special_entity", "missing", "unmapped"]
UNMAPPED_ISO = "UNMAPPED"

# Distance bands, in order, with their upper bounds in km.
BAND_NEAR = "Near (<1,000 km)"
BAND_REGIONAL = "Regional (1,000–3,000 km)"
BAND_FAR = "Far (>3,000 km)"
DISTANCE_BANDS = [BAND_NEAR, BAND_REGIONAL, BAND_FAR]
EARTH_RADIUS_KM = 6371.0

# Model feature columns, in order.
NUMERIC_FEATURES = ["year", "distance_km", "prev_flow_log", "origin_prev_total_log", "host_prev_total_log"]
BAND_FEATURES = [f"band__{b}" for b in DISTANCE_BANDS]
FEATURE_COLUMNS = NUMERIC_FEATURES + BAND_FEATURES

# Fixed values for the driver-table fixture: crisis -> origin entity, and the
# annotated events of each crisis.
CRISIS_ALL = "All Crises"
CRISIS_ORIGIN = {
    "Crisis 1": "NATION_9",
    "Crisis 2": "NATION_6",
    "Crisis 3": "NATION_11",
    "Crisis 4": "NATION_7",
    "Crisis 5": "NATION_0",
}
DEFAULT_CRISIS = "Crisis 1"
CRISIS_EVENTS = {
    c: [(1996, "Outbreak"), (1998, "Escalation"), (2000, "Peak displacement")]
    for c in CRISIS_ORIGIN
}


def scope_types(scope: str) -> list[str]:
    """Population types of a scope; unknown scopes mean cross-border."""
    return list(SCOPES.get(scope, CROSS_BORDER_TYPES))


def crisis_origin(crisis: str | None) -> str | None:
    """Origin named by a crisis; ``None`` for "All Crises" or an unknown crisis."""
    return CRISIS_ORIGIN.get(crisis or "")


def crisis_focus_origin(crisis: str | None) -> str:
    """Origin shown by the crisis views: the named crisis, else the default one."""
    return CRISIS_ORIGIN.get(crisis or "") or CRISIS_ORIGIN[DEFAULT_CRISIS]


LATEST = "latest"


@dataclass(frozen=True)
class Filters:
    """The selection every stock query takes.

    ``year``: an int, ``None`` for all years, or ``"latest"`` for the latest
    year present (resolved inside the plan, no driver round trip).
    ``origin`` beats ``crisis``; ``"All"`` means no filter.
    """

    year: int | str | None = LATEST
    scope: str = DEFAULT_SCOPE
    crisis: str = CRISIS_ALL
    origin: str = "All"
    host: str = "All"
    top_n: int = 12

    def with_(self, **kw) -> "Filters":
        return replace(self, **kw)

    @property
    def types(self) -> list[str]:
        return scope_types(self.scope)
