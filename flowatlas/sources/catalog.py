"""Table access: driver tables, fixture views and silver materialisation.

``Catalog(spark, sf_dir)`` hands out DataFrames by name. Driver tables are
read with their explicit schema. Displacement-model views come from the SQL
fixtures; the heavy ones (the stock table and its siblings, each one scan of
the line-item join) are written once as parquet, partitioned by ``year``,
under the session's checkpoint folder and read back from there - the
bronze -> silver step of the batch DAG. Later queries then get partition
pruning on ``year`` and column pruning on a narrow table instead of
re-running a four-way join. Without a checkpoint folder the views stay lazy.
"""

from __future__ import annotations

import contextlib
import hashlib
import inspect
import os
import threading
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowatlas.schemas import DRIVER_SCHEMAS
from flowatlas.session import stable_dir
from flowatlas.sources import bucketed, fixtures, gate
from flowatlas.sources.files import require_columns

# Views worth materialising: the line-item join (once), then the tables
# derived from it, which then read the silver join instead of re-joining.
SILVER_VIEWS = ("stock_base", "stock", "decisions", "resettlement", "apps_monthly", "raw_stock",
                "demographics_wide", "poc_wide", "raw_decisions")

# Those with a row per line item or order. They are written by the tasks that
# compute them: a shuffle, or a sort by year, would move all their rows once more.
CELL_VIEWS = ("stock_base", "stock", "decisions", "apps_monthly", "raw_stock", "raw_decisions")
#: years that a writing task keeps open at once; the rows of a task with more are sorted
OPEN_YEARS = 64

# What a silver table must hold to be published.
SILVER_CHECKS: dict[str, tuple[gate.Check, ...]] = {
    "stock": (gate.no_negative("value_observed"), gate.Check("year_missing", "year IS NULL", blocks=False)),
    "decisions": (gate.no_negative("applications_observed", "recognized_observed", "rejected_observed",
                                   "other_decisions_observed", "otherwise_closed_observed"),),
    "resettlement": (gate.no_negative("resettlement_observed"),),
    "apps_monthly": (gate.no_negative("applications_monthly_observed"),),
    "poc_wide": (gate.no_negative(*fixtures.POC_COLUMNS),),
    "demographics_wide": (gate.no_negative(*fixtures.DEMOGRAPHIC_COLUMNS),),
}
#: clean table -> the raw table whose rows it must all have
ROW_SOURCES = {"stock": "raw_stock"}

_LOCK = threading.RLock()
_CATALOGS: dict[tuple[str, str, bool], "Catalog"] = {}


def scan_table(spark: SparkSession, path: str, schema=None, fmt: str | None = None, spread: int | None = None) -> DataFrame:
    """Read one table by suffix: parquet, or CSV with a header (``.csv``,
    ``.csv.gz``). CSV columns are bound to ``schema`` by their names in the
    header, in any order; a missing column or a malformed typed value is an
    error. Without a schema all columns are strings. Blanks around values are
    kept. A gzip file is read by one task: its rows are rebalanced over tasks of
    the advisory size behind it (``spread``: over that many); files that can be
    split are not."""
    p = path.rstrip("/")
    kind = fmt or ("csv" if p.endswith(".csv") or p.endswith(".csv.gz") else "parquet")
    if kind == "parquet":
        r = spark.read
        if schema is not None:
            r = r.schema(schema)
        return r.parquet(path)
    r = (spark.read.option("header", True).option("inferSchema", False)
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    df = r.csv(path)  # reads the header only
    if schema is not None:
        known = {f.name: f for f in schema.fields}
        missing = [n for n in known if n not in df.columns]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
        bound = T.StructType([known.get(c, T.StructField(c, T.StringType())) for c in df.columns])
        df = r.schema(bound).option("enforceSchema", False).option("mode", "FAILFAST").csv(path).select(*known)
    if spread:
        return df.repartition(spread)
    return df.hint("rebalance") if p.endswith(UNSPLITTABLE) else df


#: suffixes of files that one task must read whole
UNSPLITTABLE = (".gz",)
#: columns that ``scan_raw_csv`` adds
LINE, FILE = "_line", "_file"


def scan_raw_csv(spark: SparkSession, path: str, columns: list[str], header: bool = True) -> DataFrame:
    """Raw CSV, every column text, no row lost and none that stops the job: a
    record with more or fewer fields than there are columns comes back with its
    whole text in ``_line`` (null for good records), and every record with its
    file in ``_file``. With a header the columns are bound by name, in any
    order, and a file with other columns is an error; without one, by place.
    Blanks around values and codes such as ``NA`` stay as they are; an empty
    field is null."""
    r = (spark.read.option("header", header).option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    order = columns
    if header:
        order = r.csv(path).columns  # reads one header only
        missing = [c for c in columns if c not in order]
        if missing:
            raise ValueError(f"{path} has no column {', '.join(missing)}")
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*order, LINE]])
    # with pruned columns the parser does not count fields
    df = (r.schema(schema).option("enforceSchema", not header).option("mode", "PERMISSIVE").option("columnPruning", False)
          .option("columnNameOfCorruptRecord", LINE).csv(path))
    return df.select(*columns, LINE, F.col("_metadata.file_path").alias(FILE))


def ingest_raw_csv(spark: SparkSession, path: str, columns: list[str], out: str, header: bool = True) -> tuple[DataFrame, DataFrame]:
    """One pass over raw CSV into the table ``out``: (good rows, quarantine).
    The quarantine holds file and text of every malformed record."""
    raw = scan_raw_csv(spark, path, columns, header)
    bad = F.col(LINE).isNotNull()
    kept = raw.select(*[F.when(~bad, F.col(c)).alias(c) for c in columns], LINE, FILE, bad.alias("_quarantined"))
    kept.write.mode("overwrite").partitionBy("_quarantined").parquet(out)
    table = spark.read.schema(kept.schema).parquet(out)
    return table.filter("not _quarantined").select(*columns), table.filter("_quarantined").select(FILE, LINE)


def path_exists(spark: SparkSession, path: str) -> bool:
    """Existence check through the Hadoop file system of the path (works for
    local, HDFS and object stores alike)."""
    jvm = spark.sparkContext._jvm
    hpath = jvm.org.apache.hadoop.fs.Path(path)
    fs = hpath.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(fs.exists(hpath))


def scan_first_available(spark: SparkSession, candidates: list[str], schema=None,
                         required: bool = False) -> DataFrame:
    """First existing path of an ordered candidate list. None exists: an
    empty table of ``schema`` or, if ``required``, ``FileNotFoundError``."""
    for c in candidates:
        if path_exists(spark, c):
            return scan_table(spark, c, schema)
    if required:
        raise FileNotFoundError(f"none of these tables exist: {candidates}")
    if schema is None:
        raise ValueError("an empty fallback needs a schema")
    return spark.createDataFrame([], schema)


def source_key(spark: SparkSession, sf_dir: str) -> str:
    """Names a data folder's state: its base name and a hash of the qualified
    path, of every source file's name, size and time, and of the view
    definitions and checks. Another folder, changed files or changed views get another
    name."""
    from flowatlas.operators import cube
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    h = hashlib.sha256()
    for module in (fixtures, cube, gate, bucketed):
        h.update(inspect.getsource(module).encode())
    h.update(repr(SILVER_CHECKS).encode())
    for t in fixtures.DRIVER_TABLES:
        path = jvm.org.apache.hadoop.fs.Path(f"{sf_dir.rstrip('/')}/{t}.parquet")
        fs = path.getFileSystem(conf)
        h.update(f"\n{fs.makeQualified(path)}".encode())
        if fs.exists(path):
            for s in sorted((f.getPath().getName(), f.getLen(), f.getModificationTime()) for f in fs.listStatus(path)):
                h.update(repr(s).encode())
    return f"{os.path.basename(sf_dir.rstrip('/')) or 'root'}-{h.hexdigest()[:16]}"


class Catalog:
    def __init__(self, spark: SparkSession, sf_dir: str, materialize: bool | None = None, key: str | None = None):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self.key = key or source_key(spark, sf_dir)
        base = stable_dir(spark) if materialize is not False else None
        self.silver_dir = f"{base}/flowatlas_silver/{self.key}" if base else None
        self._views: dict[str, DataFrame] = {}
        self._guarded = False
        self._locks: dict[str, threading.Lock] = {}

    # driver tables ---------------------------------------------------------
    def driver(self, name: str) -> DataFrame:
        return self.spark.read.schema(DRIVER_SCHEMAS[name]).parquet(f"{self.sf_dir}/{name}.parquet")

    def _drivers(self) -> dict:
        return {t: self.driver(t) for t in fixtures.DRIVER_TABLES}

    def _tables(self) -> dict:
        if not self._views:
            self._views.update(self._drivers())
        return self._views

    # displacement views ---------------------------------------------------
    def _lock_for(self, name: str) -> threading.Lock:
        with _LOCK:
            return self._locks.setdefault(name, threading.Lock())

    def view(self, name: str) -> DataFrame:
        """The view as a DataFrame; silver views are written once and read
        back. One lock per view: different views build concurrently."""
        key = f"__final__{name}"
        with _LOCK:
            tables = self._tables()
            if key in tables:
                return tables[key]
        for dep in fixtures.VIEWS[name][1]:
            self.view(dep)  # silver dependencies are materialised first
        with self._lock_for(name):
            with _LOCK:
                if key in tables:
                    return tables[key]
                df = fixtures.spark_view(self.spark, dict(tables), name)
            if name in SILVER_VIEWS and self.silver_dir:
                df = self._materialize(name, df)
            with _LOCK:
                tables[name] = df  # dependants built later read the silver copy
                tables[key] = df
            return df

    def build_silver(self, threads: int = 4) -> None:
        """Write every silver view: the line-item join first (the others read
        it), then the rest as concurrent Spark jobs."""
        from concurrent.futures import ThreadPoolExecutor
        self.view(SILVER_VIEWS[0])
        with ThreadPoolExecutor(max_workers=threads) as ex:
            list(ex.map(self.view, SILVER_VIEWS[1:]))
        self.corridors()  # built from the cube

    def _materialize(self, name: str, df: DataFrame, buckets: bucketed.Buckets | None = None) -> DataFrame:
        """Writes a silver table aside, with its checks counted by the writing
        job, and publishes it only if none of them blocks. With ``buckets`` it
        is bucketed, else partitioned by year where it has one."""
        path = f"{self.silver_dir}/{name}"
        if not path_exists(self.spark, f"{path}/_SUCCESS"):
            self.guard()
            # written aside and renamed: other applications see all of it or nothing
            aside = f"{self.silver_dir}/.{name}-{uuid.uuid4().hex}"
            checks = SILVER_CHECKS.get(name, ())
            if buckets:
                out, seen = gate.observe(bucketed.deal(df, buckets), name, checks)
                bucketed.write(out, aside, buckets)
            elif name in CELL_VIEWS:
                # as many files per year as there are tasks (at most), of the
                # shares of a split or of a partition that AQE sized
                out, seen = gate.observe(df, name, checks)
                w = out.write.mode("overwrite").option("maxRecordsPerFile", 5_000_000)
                with unsorted_writes(self.spark, OPEN_YEARS):
                    (w.partitionBy("year") if "year" in df.columns else w).parquet(aside)
            elif "year" in df.columns:
                # aggregated rows, few. REBALANCE by year: AQE sizes the output
                # partitions to the advisory size and splits a hot year over
                # several tasks, so each year gets a few well-sized files
                # instead of one small file per task
                out, seen = gate.observe(df.hint("rebalance", "year").sortWithinPartitions("year"), name, checks)
                (out.write.mode("overwrite").option("maxRecordsPerFile", 5_000_000)
                 .partitionBy("year").parquet(aside))
            else:
                out, seen = gate.observe(df.hint("rebalance"), name, checks)
                out.write.mode("overwrite").parquet(aside)
            rows = gate.verdicts(name, checks, seen.get)
            if any(r["blocks_pipeline"] for r in rows):
                raise gate.QualityGateError(name, rows, aside)
            gate.record(self.spark, f"{self.silver_dir}/gate-{name}.json", rows)
            _publish(self.spark, aside, path)
        if buckets:
            return bucketed.read(self.spark, df.schema, path, buckets)
        # the fixture's schema and column order: nothing is read for it
        return self.spark.read.schema(df.schema).parquet(path).select(*df.columns)

    def guard(self) -> None:
        """Before the first job that reads the driver tables: every file of them
        is there and has the columns that the views read (from the footers)."""
        with _LOCK:
            if not self._guarded:
                require_columns(self.spark, {t: f"{self.sf_dir}/{t}.parquet" for t in fixtures.USED_COLUMNS}, fixtures.USED_COLUMNS)
                self._guarded = True

    def published(self, name: str) -> str | None:
        """Where the view's silver table is, if it has been published."""
        path = f"{self.silver_dir}/{name}"
        return path if name in SILVER_VIEWS and self.silver_dir and path_exists(self.spark, f"{path}/_SUCCESS") else None

    def defined(self, name: str) -> DataFrame:
        """The view, building nothing: its silver table where that is published,
        else its definition over the driver tables. Starts no job."""
        return self._defined(name, dict(self._drivers()))

    def _defined(self, name: str, tables: dict) -> DataFrame:
        for dep in fixtures.VIEWS[name][1]:
            if dep not in tables:
                self._defined(dep, tables)
        df = fixtures.spark_view(self.spark, tables, name)
        path = self.published(name)
        if path:
            df = self.spark.read.schema(df.schema).parquet(path).select(*df.columns)
        tables[name] = df
        return df

    def gate(self) -> DataFrame:
        """The gate rows of all silver tables (built first if need be), the row
        counts of clean against raw tables, and the overall verdict."""
        self.build_silver()
        names = [n for n in SILVER_VIEWS if n in SILVER_CHECKS or n in ROW_SOURCES.values()]
        if self.silver_dir:
            rows = self.spark.read.schema(gate.GATE_SCHEMA).json([f"{self.silver_dir}/gate-{n}.json" for n in names])
        else:  # nothing is written: the counters run by themselves
            found = [gate.verdicts(n, checks, self.view(n).agg(*gate.counters(checks)).first().asDict())
                     for n in names for checks in [SILVER_CHECKS.get(n, ())]]
            rows = self.spark.createDataFrame([tuple(r.values()) for f in found for r in f], gate.GATE_SCHEMA)
        count = {r["table"]: r["rows"] for r in rows.select(F.substring_index("check", "__", -1).alias("table"), "rows").distinct().collect()}
        loss = [(f"no_row_loss__{c}", "PASS" if count[c] == count[r] else "FAIL", f"raw={count[r]}, clean={count[c]}", count[c] != count[r])
                for c, r in ROW_SOURCES.items()]
        columns = "check string, status string, detail string, blocks_pipeline boolean"
        checks = rows.filter(~F.col("check").startswith("written__")).drop("rows").unionByName(self.spark.createDataFrame(loss, columns))
        return checks.unionByName(gate.overall(checks))

    def year_bounds(self, names=None) -> DataFrame:
        """(table_name, year_min, year_max) of the published tables that are
        partitioned by year, from the partitions' names: no data is read."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        out = []
        for name in names or SILVER_VIEWS:
            path = self.published(name)
            if not path:
                continue
            glob = jvm.org.apache.hadoop.fs.Path(f"{path}/year=*")
            found = [s.getPath().getName().split("=", 1)[1] for s in glob.getFileSystem(conf).globStatus(glob)]
            years = [int(y) for y in found if y.lstrip("-").isdigit()]
            out.append((name, min(years, default=None), max(years, default=None)))
        return self.spark.createDataFrame(out, "table_name string, year_min int, year_max int")

    def stock(self) -> DataFrame:
        return self.view("stock")

    def cube(self) -> DataFrame:
        """The stock cube (``operators.cube``), written once as silver."""
        from flowatlas.operators.cube import build_cube
        return self._derived("stock_cube", self.stock, build_cube)

    def corridors(self) -> DataFrame:
        """Corridor totals (``operators.cube``), written once, bucketed by
        (origin, host): per-pair grouping and lags read them without a shuffle."""
        from flowatlas.operators.cube import CORRIDOR_BUCKETS, build_corridors
        return self._derived("corridors", self.cube, build_corridors, CORRIDOR_BUCKETS)

    def _derived(self, name: str, source, build, buckets: bucketed.Buckets | None = None) -> DataFrame:
        """A silver table built from another one, once per catalog."""
        key = f"__final__{name}"
        with _LOCK:
            tables = self._tables()
            if key in tables:
                return tables[key]
        src = source()
        with self._lock_for(name):
            with _LOCK:
                if key in tables:
                    return tables[key]
            df = build(src)
            if self.silver_dir:
                df = self._materialize(name, df, buckets)
            with _LOCK:
                tables[key] = df
            return df


#: per session: (writes that want it now, what the setting was before)
_UNSORTED: dict[SparkSession, tuple[int, str | None]] = {}
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


@contextlib.contextmanager
def unsorted_writes(spark: SparkSession, folders: int):
    """Partitioned writes inside keep up to ``folders`` files open in a task
    instead of sorting its rows first. The last of several concurrent ones sets
    the session back to what it was."""
    with _LOCK:
        n, before = _UNSORTED.get(spark) or (0, spark.conf.get(_WRITERS, None))
        _UNSORTED[spark] = n + 1, before
        spark.conf.set(_WRITERS, str(folders))
    try:
        yield
    finally:
        with _LOCK:
            n, before = _UNSORTED.pop(spark)
            if n > 1:
                _UNSORTED[spark] = n - 1, before
            elif before is None:
                spark.conf.unset(_WRITERS)
            else:
                spark.conf.set(_WRITERS, before)


def _publish(spark: SparkSession, aside: str, path: str) -> None:
    """Gives a written table its name, unless another application was first
    (its table holds the same rows)."""
    jvm = spark.sparkContext._jvm
    src, dst = jvm.org.apache.hadoop.fs.Path(aside), jvm.org.apache.hadoop.fs.Path(path)
    fs = dst.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(dst):
        fs.rename(src, dst)
    if not path_exists(spark, f"{path}/_SUCCESS"):
        raise RuntimeError(f"{path} could not be written")


def catalog(spark: SparkSession, sf_dir: str, materialize: bool | None = None) -> Catalog:
    """One catalog per (application, data folder), so silver tables are
    built once per run."""
    state = source_key(spark, sf_dir)
    key = (spark.sparkContext.applicationId, state, materialize is not False)
    with _LOCK:
        c = _CATALOGS.get(key)
        if c is None or c.spark is not spark:
            c = Catalog(spark, sf_dir, materialize, state)
            _CATALOGS[key] = c
        return c


def load_catalog(spark: SparkSession, sf_dir: str, prefix: str = "") -> dict[str, DataFrame]:
    """Register every displacement view as a temp view, so that ``spark.sql``
    can query them. Nothing is built or read until a query uses one: a view
    whose silver table is published reads that, any other its definition."""
    cat = catalog(spark, sf_dir)
    out = {}
    for name in fixtures.VIEWS:
        if name == "stock_base":
            continue
        df = cat.defined(name)
        df.createOrReplaceTempView(prefix + name)
        out[name] = df
    return out
