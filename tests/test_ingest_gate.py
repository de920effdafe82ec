"""The ingest side: raw files with malformed records, checks that block a
publication, the lazy catalog and its metadata."""

import os

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from conftest import SF_SMALL
from flowatlas.operators import audit as au
from flowatlas.plans.io_plans import RAW_TABLES
from flowatlas.sources import catalog as cat_mod
from flowatlas.sources import fixtures, gate, sinks
from flowatlas.sources.catalog import LINE, Catalog, ingest_raw_csv, load_catalog, scan_raw_csv
from flowatlas.sources.files import MissingColumnsError, validate_files

import __spark_entry__ as E

Q = E.queries()


@pytest.fixture
def own_silver(spark, tmp_path, monkeypatch):
    """Silver tables in a folder of this test alone."""
    monkeypatch.setattr(cat_mod, "stable_dir", lambda s: str(tmp_path / "stable"))
    return str(tmp_path / "stable")


def driver_copy(spark, folder, **changed):
    for t in fixtures.DRIVER_TABLES:
        df = spark.read.parquet(f"{SF_SMALL}/{t}.parquet")
        changed.get(t, lambda d: d)(df).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


# ------------------------------------------------------------------ gate
def negative_line(df):
    # one that the fixture neither redacts nor zeroes
    k, n = df.filter("l_orderkey % 50 <> 0 AND l_orderkey % 41 <> 0").agg(F.min(F.struct("l_orderkey", "l_linenumber"))).first()[0]
    assert df.filter((F.col("l_orderkey") == k) & (F.col("l_linenumber") == n)).count() == 1
    hit = (F.col("l_orderkey") == k) & (F.col("l_linenumber") == n)
    return df.withColumn("l_quantity", F.when(hit, F.lit(-7.0)).otherwise(F.col("l_quantity")))


def test_a_planted_negative_cell_blocks_publication(spark, own_silver, tmp_path):
    cat = Catalog(spark, driver_copy(spark, tmp_path / "data", lineitem=negative_line))
    with pytest.raises(gate.QualityGateError, match="no_negative_observed_values__stock: negative_cells=1") as e:
        cat.view("stock")
    assert not os.path.exists(f"{cat.silver_dir}/stock")
    assert not os.path.exists(f"{cat.silver_dir}/gate-stock.json")
    assert cat.published("stock") is None and os.path.exists(e.value.kept)
    with pytest.raises(gate.QualityGateError):  # again: it was not taken as built
        cat.cube()
    assert cat.view("raw_stock").count() > 0  # raw tables may hold anything


def test_clean_data_is_published_with_its_counts(spark, own_silver):
    cat = Catalog(spark, SF_SMALL)
    cat.build_silver()
    got = {r["check"]: r for r in cat.gate().collect()}
    n = cat.stock().count()
    assert got["no_row_loss__stock"]["detail"] == f"raw={n}, clean={n}"
    assert got["no_negative_observed_values__poc_wide"]["detail"] == "negative_cells=0"
    assert (got["overall"]["status"], got["overall"]["blocks_pipeline"]) == ("PASS", False)
    plain = Catalog(spark, SF_SMALL, materialize=False).gate()
    assert {tuple(r) for r in plain.collect()} == {tuple(r) for r in got.values()}


def test_verdicts_count_cells_rows_and_nulls(spark):
    df = spark.createDataFrame([(1, -1.0, -2.0), (None, 3.0, None), (2, None, -1.0)], "year int, a double, b double")
    checks = (gate.no_negative("a", "b"), gate.Check("year_missing", "year IS NULL", blocks=False), gate.Check("big", "a > 100"))
    rows = gate.verdicts("t", checks, df.agg(*gate.counters(checks)).first().asDict())
    assert [(r["status"], r["detail"], r["blocks_pipeline"]) for r in rows] == [
        ("FAIL", "negative_cells=3", True), ("DOCUMENTED", "rows=1", False), ("PASS", "rows=0", False)]
    assert all(r["rows"] == 3 for r in rows)
    table = spark.createDataFrame([(r["check"], r["status"], r["detail"], r["blocks_pipeline"]) for r in rows],
                                  "check string, status string, detail string, blocks_pipeline boolean")
    assert tuple(gate.overall(table).first()) == ("overall", "FAIL", "blocking_checks=1", True)
    assert tuple(gate.overall(table.limit(0)).first()) == ("overall", "PASS", "blocking_checks=0", False)


def test_counters_ride_on_the_write(spark, own_silver):
    """One job's plan: the observed metrics sit under the write, no second scan."""
    df = Catalog(spark, SF_SMALL, materialize=False).view("apps_monthly")
    out, seen = gate.observe(df, "apps_monthly", cat_mod.SILVER_CHECKS["apps_monthly"])
    assert "CollectMetrics" in out._jdf.queryExecution().executedPlan().toString()
    out.write.format("noop").mode("overwrite").save()
    assert seen.get["rows"] == df.count() and seen.get["c0"] == 0


# ---------------------------------------------------------------- guards
def test_one_file_without_a_column_is_named(spark, tmp_path, own_silver):
    data = driver_copy(spark, tmp_path / "data")
    spark.read.parquet(f"{data}/supplier.parquet").drop("s_nationkey").coalesce(1).write.mode("append").parquet(f"{data}/supplier.parquet")
    rows = validate_files(spark, {"supplier": f"{data}/supplier.parquet"}, {"supplier": fixtures.USED_COLUMNS["supplier"]}).collect()
    bad = [r for r in rows if r.status == "FAIL"]
    assert len(rows) > 1 and len(bad) == 1 and bad[0].missing_required_columns == "s_nationkey"
    cat = Catalog(spark, data)
    with pytest.raises(MissingColumnsError, match=os.path.basename(bad[0].file) + ": lacks s_nationkey"):
        cat.view("stock")
    assert not os.path.exists(f"{own_silver}/flowatlas_silver/{cat.key}")


def test_headers_of_plain_and_compressed_csv(spark, tmp_path):
    import gzip
    (tmp_path / "t.csv" / "year=1999").mkdir(parents=True)
    (tmp_path / "t.csv" / "a.csv").write_text('k,"v, w"\r\n1,2\n')
    (tmp_path / "t.csv" / "year=1999" / "b.csv.gz").write_bytes(gzip.compress(b"k\n1\n"))
    (tmp_path / "t.csv" / "_SUCCESS").write_text("")
    (tmp_path / "t.csv" / "c.csv").write_text("")
    rows = {os.path.basename(r.file): r for r in validate_files(spark, {"t": f"{tmp_path}/t.csv", "u": f"{tmp_path}/none"},
                                                               {"t": ["k", "v, w"], "u": ["x"]}).collect()}
    assert {f: (r.status, r.missing_required_columns, r.columns_in_preview) for f, r in rows.items()} == {
        "a.csv": ("PASS", "", 2), "b.csv.gz": ("FAIL", "v, w", 2), "c.csv": ("FAIL", "k | v, w", 0), "none": ("MISSING", "x", 0)}


def test_conversions_are_published_together(spark, tmp_path):
    for t, text in (("a", "k,v\n1,x\n2,y\n"), ("b", "k,v\n1,x\n")):
        (tmp_path / f"{t}.csv").write_text(text)
    tables = {t: f"{tmp_path}/{t}.csv" for t in "ab"}
    schemas = {t: T.StructType([T.StructField("k", T.IntegerType()), T.StructField("v", T.StringType())]) for t in "ab"}
    out = f"{tmp_path}/out"
    assert sinks.converted(spark, out) is None
    first = {r.table_name: r for r in sinks.convert_together(spark, tables, out, schemas, partition_by={"a": "v"}).collect()}
    assert {t: r.rows for t, r in first.items()} == {"a": 2, "b": 1} and all(r.bytes > 0 for r in first.values())
    assert spark.read.parquet(first["a"].path).count() == 2 and os.path.exists(first["a"].path + "/v=x")
    (tmp_path / "b.csv").write_text("k,v\nnot a number,x\n")
    with pytest.raises(Exception):
        sinks.convert_together(spark, tables, out, schemas)
    assert {r.path for r in sinks.converted(spark, out).collect()} == {r.path for r in first.values()}


# --------------------------------------------------------------- raw files
def test_malformed_records_are_set_aside(spark, tmp_path):
    folder = tmp_path / "in.csv"
    folder.mkdir()
    (folder / "a.csv").write_text('v,k,note\n1,a,x\n2,b\n3,c,y,z\n , NA ,"q,u"\n4,,\n')
    (folder / "b.csv").write_text("v,k,note\n5,e,*\nlonely\n")
    raw = scan_raw_csv(spark, str(folder), ["k", "v"])
    rows = {(r.k, r.v) for r in raw.collect() if r[LINE] is None}
    assert rows == {("a", "1"), (" NA ", " "), (None, "4"), ("e", "5")}
    good, bad = ingest_raw_csv(spark, str(folder), ["k", "v"], str(tmp_path / "out"))
    assert {tuple(r) for r in good.collect()} == rows
    assert {(os.path.basename(r[0]), r[1]) for r in bad.collect()} == {("a.csv", "2,b"), ("a.csv", "3,c,y,z"), ("b.csv", "lonely")}
    # quarantine and good rows are partitions: neither reads the other
    assert "PartitionFilters: [isnotnull(_quarantined" in good._jdf.queryExecution().executedPlan().toString()
    with pytest.raises(ValueError, match="no column w"):
        scan_raw_csv(spark, str(folder), ["k", "w"])
    (folder / "c.csv").write_text("v,other,note\n1,a,x\n")
    with pytest.raises(Exception, match="(?i)header"):
        scan_raw_csv(spark, str(folder), ["k", "v"]).collect()


def test_every_raw_file_has_malformed_records(spark):
    rows = Q["scan_raw_csv_all"](spark, "/root/testdata/sf0.01").collect()
    assert [r.dataset for r in rows] == list(RAW_TABLES)
    assert all(r.file_rows == r.good_rows + r.quarantined_rows for r in rows)
    assert sum(r.quarantined_rows > 0 for r in rows) == 6


# ------------------------------------------------------------------ audit
def test_numeric_audit_of_defective_cells(spark):
    cells = [(" 5 ", "0"), ("*", " "), ("", None), ("-2", "n/a"), ("1e3", "NaN"), ("inf", "7")]
    out = {r.column: r.asDict() for r in au.audit_numeric_quality(
        spark.createDataFrame(cells, "a string, `b c` string"), "t", {"a": "A's", "b c": "B"}).collect()}
    assert out["A's"] == dict(dataset="t", column="A's", rows=6, observed_nonmissing_rows=2, blank_rows=1, redacted_star_rows=1, zero_rows=0,
                              negative_raw_rows=1, non_numeric_raw_rows=1, observed_sum=1005.0, observed_min=5.0, observed_max=1000.0)
    assert out["B"] == dict(dataset="t", column="B", rows=6, observed_nonmissing_rows=2, blank_rows=2, redacted_star_rows=0, zero_rows=1,
                            negative_raw_rows=0, non_numeric_raw_rows=2, observed_sum=7.0, observed_min=0.0, observed_max=7.0)


@pytest.mark.parametrize("key", ["audit_numeric_quality", "audit_numeric_quality_all"])
def test_numeric_audit_multiplies_no_rows(spark, key):
    plan = Q[key](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Expand" not in plan


def test_all_kinds_of_defects_are_audited(spark):
    by = {}
    for r in Q["audit_numeric_quality"](spark, "/root/testdata/sf0.01").collect():
        t = by.setdefault(r.dataset, dict(blank=0, star=0, negative=0, text=0))
        for k, v in (("blank", r.blank_rows), ("star", r.redacted_star_rows), ("negative", r.negative_raw_rows), ("text", r.non_numeric_raw_rows)):
            t[k] += v
    assert set(by) == set(RAW_TABLES)
    assert all(n > 0 for t in by.values() for n in t.values()), by


# ---------------------------------------------------------------- catalog
def jobs_of(spark, run):
    sc = spark.sparkContext
    group = f"jobs-{os.urandom(4).hex()}"
    sc.setJobGroup(group, group)
    try:
        run()
    finally:
        sc.setLocalProperty("spark.jobGroup.id", None)
    return len(sc.statusTracker().getJobIdsForGroup(group))


def test_registering_starts_no_job_and_writes_nothing(spark, own_silver):
    assert jobs_of(spark, lambda: load_catalog(spark, SF_SMALL + "/.", "lazy_")) == 0
    assert not os.path.exists(own_silver)
    n = spark.sql("SELECT count(*) FROM lazy_stock").first()[0]
    assert n == spark.read.parquet(f"{SF_SMALL}/lineitem.parquet").count()
    assert not os.path.exists(own_silver)
    cat = Catalog(spark, SF_SMALL)
    cat.build_silver()
    assert all("/flowatlas_silver/" in f for f in cat.defined("stock").inputFiles())
    assert jobs_of(spark, lambda: cat.defined("stock")) == 0


def test_year_bounds_read_no_data(spark, own_silver):
    cat = Catalog(spark, SF_SMALL)
    assert cat.year_bounds().count() == 0
    cat.build_silver()
    bounds = cat.year_bounds(["stock", "raw_stock", "apps_monthly"])
    assert "Scan parquet" not in bounds._jdf.queryExecution().executedPlan().toString()
    assert jobs_of(spark, lambda: cat.year_bounds()) == 0
    want = cat.stock().agg(F.min("year"), F.max("year")).first()
    got = {r[0]: tuple(r)[1:] for r in bounds.collect()}
    assert got["stock"] == tuple(want) and got["raw_stock"] == (None, None)
