"""What the operators share: registration, the shared work folder, size-checked
broadcasts, quantiles from exact bin counts, and what worker processes keep."""

from __future__ import annotations

import ctypes
import os
import tempfile
import uuid
import zipfile
from collections.abc import Callable, Sequence
from functools import reduce

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowatlas.session import shared_dir

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: a word of the contracts: no ASCII white space
SPACE_CLASS = r"[\x20\x09-\x0D]+"
#: separators of the alphanumeric words (everything ASCII but 0-9 and a-z)
NON_ALNUM_CLASS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"

#: a table of ids and hashes (up to some 250 bytes a row) of at most so many
#: rows may be broadcast, about 50 MB; beyond it joins shuffle
BROADCAST_ROWS = 200_000
#: a group of more than one in so many rows is hot; there are fewer such groups
HOT_GROUPS = 10_000


def register(key: str, oracle: str | None = None):
    """Register ``fn(spark, sf_dir)`` as a query, with its DuckDB SQL if there is one."""
    def deco(fn):
        if key in QUERIES:
            raise ValueError(f"duplicate query key {key}")
        QUERIES[key] = fn
        if oracle is not None:
            ORACLES[key] = oracle
        return fn
    return deco


_shipped: set[str] = set()


def ship_package(spark: SparkSession) -> None:
    """Makes this package importable in Python workers, however the driver
    found it: sent once per application with ``addPyFile``."""
    app = spark.sparkContext.applicationId
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    if app in _shipped or not os.path.isdir(top):
        return
    path = os.path.join(tempfile.mkdtemp(prefix="ship-"), os.path.basename(top) + ".zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(names):
                if n.endswith(".py"):
                    file = os.path.join(folder, n)
                    z.write(file, os.path.relpath(file, os.path.dirname(top)))
    spark.sparkContext.addPyFile(path)
    _shipped.add(app)


#: what a worker process keeps from task to task (encoders with their words)
KEPT: dict = {}


def let_go() -> None:
    """For the start of a task that uses nothing of ``KEPT``: Spark hands the
    workers of one stage to the next, so what an earlier operator kept there would
    stay beside this one's data. Freed memory goes back to the system."""
    KEPT.clear()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError, TypeError):  # another C library: it keeps its free memory
        pass


def work_dir(spark: SparkSession, key: str) -> str:
    """A new folder of this call under the shared checkpoint folder (tables
    written there survive lost executors)."""
    return f"{shared_dir(spark)}/flowatlas_llm/{key}-{uuid.uuid4().hex}"


def save(df: DataFrame, path: str, compression: str | None = None) -> DataFrame:
    """Write ``df`` as parquet and read it back: cuts the lineage."""
    w = df.write.mode("overwrite")
    if compression:
        w = w.option("compression", compression)
    w.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ascii_lower(c: Column) -> Column:
    """A-Z to a-z, nothing else."""
    return F.translate(c, UPPER, LOWER)


def words_of(text: Column, separators: str) -> Column:
    """The non-empty pieces between ``separators``; null has none."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), separators), "")


def small(df: DataFrame, rows: int, limit: int = BROADCAST_ROWS) -> DataFrame:
    """``df`` with a broadcast hint if its counted ``rows`` are within ``limit``;
    otherwise as it is, and the join shuffles."""
    return F.broadcast(df) if rows <= limit else df


def add_group_totals(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    """``df`` (a written table) with the exact sum of a long column over the rows of
    equal ``keys``, nulls together; null where a value is null or the sum does
    not fit a long. Sums are made map-side first. Totals come back by broadcast
    while they are few; beyond, those of the largest groups still
    do, at most ``HOT_GROUPS`` groups, so no hot key meets in one task."""
    totals = df.groupBy(*keys).agg(
        F.sum(F.col(value).cast("decimal(38,0)")).alias("_s"), F.count(F.lit(1)).alias("_n"), F.count(value).alias("_v"))
    fits = F.when((F.col("_v") == F.col("_n")) & (F.abs("_s") <= F.lit((1 << 63) - 1)), F.col("_s")).cast("long")
    totals = save(totals.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], fits.alias(out), "_n"),
                  f"{work_dir(df.sparkSession, 'totals')}/all")

    def joined(left: DataFrame, right: DataFrame, how: str) -> DataFrame:
        on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
        return left.join(right, reduce(Column.__and__, on), how).select(*df.columns, out)

    n = totals.count()
    if n <= BROADCAST_ROWS:
        return joined(df, F.broadcast(totals), "inner")
    rows = totals.agg(F.sum("_n")).first()[0]
    hot = totals.filter(F.col("_n") * HOT_GROUPS > rows).withColumn("_hot", F.lit(True))
    marked = df.join(F.broadcast(hot),
                     reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]), "left")
    found = marked.filter("_hot").select(*df.columns, out)
    rest = marked.filter("_hot is null").select(*df.columns)
    return found.unionByName(joined(rest, totals, "inner"))


def binned_cut(df: DataFrame, keys: Sequence[str], value: str, share: float, out: str) -> DataFrame:
    """Per group the upper edge of the first bin of ``value`` (>= 0) up to which
    at least ``share`` of the group's rows lie. Bins are 1/64 of a power of two
    wide; their exact counts are summed map-side first, so a hot group costs
    one row per bin and task."""
    b = F.floor(F.log2(F.col(value) + F.lit(1e-9)) * 64)
    hist = df.groupBy(*keys, b.alias("_bin")).agg(F.count(F.lit(1)).alias("_n"))
    w = Window.partitionBy(*keys)
    cum = (hist.withColumn("_all", F.sum("_n").over(w))
           .withColumn("_cum", F.sum("_n").over(w.orderBy("_bin")))
           .filter(F.col("_cum") >= F.col("_all") * share))
    return cum.groupBy(*keys).agg(F.pow(F.lit(2.0), (F.min("_bin") + 1) / F.lit(64.0)).alias(out))
