"""Sinks: JSON-safe values, chart-table export, CSV -> parquet conversion.

Everything is written under a folder the caller names - in the library's
own queries that is the session's checkpoint folder (the cluster's shared
``spark.checkpoint.dir``), never a machine-local temp folder.
"""

from __future__ import annotations

import math
import uuid
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowatlas.sources.catalog import scan_table


MANIFEST = "table_name string, path string, rows long, bytes long"


def _clean_value(c: Column, dtype: T.DataType) -> Column:
    """NaN and +/-inf -> null in a value of ``dtype``, recursing into arrays,
    structs and map values with higher-order functions (JVM side)."""
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return F.when(F.isnan(c) | (F.abs(c) == F.lit(math.inf)), F.lit(None).cast(dtype)).otherwise(c)
    if isinstance(dtype, T.ArrayType):
        return F.transform(c, lambda x: _clean_value(x, dtype.elementType))
    if isinstance(dtype, T.StructType):
        return F.when(c.isNull(), F.lit(None).cast(dtype)).otherwise(
            F.struct(*[_clean_value(c.getField(f.name), f.dataType).alias(f.name) for f in dtype.fields]))
    if isinstance(dtype, T.MapType):
        return F.transform_values(c, lambda _k, v: _clean_value(v, dtype.valueType))
    return c


def _has_float(dtype: T.DataType) -> bool:
    if isinstance(dtype, (T.DoubleType, T.FloatType)):
        return True
    if isinstance(dtype, T.ArrayType):
        return _has_float(dtype.elementType)
    if isinstance(dtype, T.StructType):
        return any(_has_float(f.dataType) for f in dtype.fields)
    if isinstance(dtype, T.MapType):
        return _has_float(dtype.valueType)
    return False


def nullify_non_finite(df: DataFrame) -> DataFrame:
    """Every NaN / +inf / -inf anywhere in ``df`` (flat, array, struct or
    map value) becomes null, so that strict JSON can carry the result."""
    return df.select(*[
        _clean_value(F.col(f"`{f.name}`"), f.dataType).alias(f.name) if _has_float(f.dataType)
        else F.col(f"`{f.name}`") for f in df.schema.fields])


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """JSON-lines export with explicit nulls and no NaN / Infinity tokens."""
    nullify_non_finite(df).write.mode(mode).option("ignoreNullFields", False).json(path)


def _verbatim(w):
    """CSV with a header; blanks around values are part of them."""
    return w.option("header", True).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False)


def assert_json_safe(df: DataFrame) -> DataFrame:
    """``df`` itself; reading it fails on any NaN or infinity, nested or not."""
    keys = [f.name for f in df.schema.fields if _has_float(f.dataType)]
    checks = {f"`{k}`": _clean_value(F.col(f"`{k}`"), df.schema[k].dataType) for k in keys}
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if f.name in keys:
            changed = ~F.to_json(F.struct(c.alias("v"))).eqNullSafe(F.to_json(F.struct(checks[f"`{f.name}`"].alias("v"))))
            c = F.when(changed, F.raise_error(f"{f.name} holds a non-finite number").cast(f.dataType)).otherwise(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def export_chart_table(df: DataFrame, path: str, aliases: list[str] | None = None,
                       fmt: str = "csv") -> DataFrame:
    """Write a result once (CSV with header, or parquet) and expose it under
    every alias as a temp view - one file, several names."""
    w = nullify_non_finite(df).write.mode("overwrite")
    if fmt == "csv":
        _verbatim(w).csv(path)
        out = scan_table(df.sparkSession, path, df.schema, fmt="csv")
    else:
        w.parquet(path)
        out = df.sparkSession.read.parquet(path)
    for a in aliases or []:
        out.createOrReplaceTempView(a)
    return out


def convert_together(spark, tables: dict[str, str], out_dir: str, schemas: dict | None = None,
                     partition_by: dict[str, str] | None = None, threads: int = 4) -> DataFrame:
    """CSV tables (name -> path) to parquet by concurrent jobs, published
    together or not at all. All are written into a new version folder of
    ``out_dir``, each job counting the rows it writes; once every table is there
    the manifest (table_name, path, rows, bytes) takes its name, by one rename.
    If a table fails, the error is raised, no manifest is written and readers
    keep the version before. Returns the manifest."""
    version = f"{out_dir.rstrip('/')}/version-{uuid.uuid4().hex}"
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()

    def convert(name: str) -> tuple:
        df = scan_table(spark, tables[name], (schemas or {}).get(name), fmt="csv")
        seen = Observation(f"convert_{name}")
        df = df.observe(seen, F.count(F.lit(1)).alias("rows"))
        w, col, dst = df.write, (partition_by or {}).get(name), f"{version}/{name}.parquet"
        (w.partitionBy(col) if col else w).parquet(dst)
        path = jvm.org.apache.hadoop.fs.Path(dst)
        return name, dst, int(seen.get["rows"]), int(path.getFileSystem(conf).getContentSummary(path).getLength())

    with ThreadPoolExecutor(max_workers=threads) as pool:
        rows = list(pool.map(convert, tables))  # raises the first failure, after all have ended
    manifest = spark.createDataFrame(rows, MANIFEST)
    aside = f"{version}/manifest"
    manifest.coalesce(1).write.json(aside)
    src, dst = jvm.org.apache.hadoop.fs.Path(aside), jvm.org.apache.hadoop.fs.Path(f"{out_dir.rstrip('/')}/manifests/{version.rsplit('-', 1)[1]}")
    fs = dst.getFileSystem(conf)
    fs.mkdirs(dst.getParent())
    if not fs.rename(src, dst):
        raise RuntimeError(f"{out_dir} could not be published")
    return manifest


def converted(spark, out_dir: str) -> DataFrame | None:
    """The manifest of the latest published version, or none."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    glob = jvm.org.apache.hadoop.fs.Path(f"{out_dir.rstrip('/')}/manifests/*")
    found = glob.getFileSystem(conf).globStatus(glob) or []
    if not len(found):
        return None
    latest = max(found, key=lambda s: (s.getModificationTime(), s.getPath().getName()))
    return spark.read.schema(MANIFEST).json(latest.getPath().toString())


def write_csv(df: DataFrame, path: str, compression: str | None = None) -> None:
    w = _verbatim(df.write.mode("overwrite"))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def convert_to_parquet(spark, tables: dict[str, str], out_dir: str, schemas: dict | None = None,
                       partition_by: dict[str, str] | None = None) -> dict[str, str]:
    """CSV tables (name -> path) to parquet under ``out_dir``; large tables
    may be partitioned (name -> column). Returns name -> parquet path."""
    out = {}
    for name, src in tables.items():
        df = scan_table(spark, src, (schemas or {}).get(name), fmt="csv")
        dst = f"{out_dir.rstrip('/')}/{name}.parquet"
        w = df.write.mode("overwrite")
        col = (partition_by or {}).get(name)
        if col:
            df.sortWithinPartitions(col).write.mode("overwrite").partitionBy(col).parquet(dst)
        else:
            w.parquet(dst)
        out[name] = dst
    return out
