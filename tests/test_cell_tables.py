"""Tables with a row per line item or order are written by the tasks that
compute them: no shuffle and no sort of all their rows for the write."""

import glob
import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from flowatlas.schemas import DRIVER_SCHEMAS
from flowatlas.sources import catalog as cat_mod
from flowatlas.sources import fixtures, gate
from flowatlas.sources.catalog import _WRITERS, CELL_VIEWS, Catalog, unsorted_writes


def own_tables(spark, folder):
    """300 line items of 100 orders over seven years, some keys twice, some null."""
    day = lambda i: datetime(2012 + i % 7, 1 + i % 12, 1 + i % 28)
    rows = {
        "nation": [{"n_nationkey": i, "n_name": f"LAND {i}", "n_regionkey": i % 5} for i in range(25)],
        "customer": [{"c_custkey": i, "c_nationkey": i % 25} for i in range(30)] + [{"c_custkey": 3, "c_nationkey": 9}],
        "supplier": [{"s_suppkey": i, "s_nationkey": (i * 7) % 25} for i in range(20)],
        "orders": [{"o_orderkey": i, "o_custkey": i % 30 if i % 17 else None, "o_totalprice": 1000.0 * i, "o_orderdate": day(i)} for i in range(100)],
        "lineitem": [{"l_orderkey": i % 100, "l_linenumber": 1 + i // 100, "l_partkey": i, "l_suppkey": i % 20, "l_quantity": float(i % 50),
                      "l_returnflag": "RAN"[i % 3], "l_linestatus": "OF"[i % 2], "l_shipdate": day(i) if i % 19 else None} for i in range(300)],
        "region": [], "part": []}
    for t in fixtures.DRIVER_TABLES:
        names = DRIVER_SCHEMAS[t].names
        df = spark.createDataFrame([tuple(r.get(c) for c in names) for r in rows[t]], DRIVER_SCHEMAS[t])
        df.repartition(3).write.parquet(f"{folder}/{t}.parquet")
    return str(folder)


@pytest.fixture(scope="module")
def written(spark, tmp_path_factory):
    """(catalog with its silver tables, what was handed to each write)."""
    folder = tmp_path_factory.mktemp("cells")
    frames, real = {}, gate.observe
    with pytest.MonkeyPatch.context() as m:
        m.setattr(cat_mod, "stable_dir", lambda s: str(folder / "stable"))
        m.setattr(gate, "observe", lambda df, name, checks: (frames.__setitem__(name, df), real(df, name, checks))[1])
        cat = Catalog(spark, own_tables(spark, folder / "data"))
        cat.build_silver()
    return cat, frames


def moved(df) -> list[str]:
    """Rebalancing shuffles and sorts of a whole table in its plan."""
    text = df._jdf.queryExecution().optimizedPlan().toString()
    return [op for op in ("RebalancePartitions", "RepartitionByExpression", "Sort [") if op in text]


def plain(df):
    return sorted(map(repr, df.select(*sorted(df.columns)).collect()))


@pytest.mark.parametrize("names", [("stock",), ("decisions", "apps_monthly"), ("stock_base",), ("raw_stock", "raw_decisions")])
def test_cell_tables_are_written_where_they_are_computed(spark, written, names):
    cat, frames = written
    lazy = Catalog(spark, cat.sf_dir, materialize=False)
    for name in names:
        assert name in CELL_VIEWS and not moved(frames[name]), name
        assert plain(cat.view(name)) == plain(lazy.view(name)) != [], name
    assert moved(frames["poc_wide"])  # a few aggregated rows still become few files


def test_years_stay_folders_with_null_years_too(spark, written):
    cat, _ = written
    years = {os.path.basename(p) for p in glob.glob(f"{cat.silver_dir}/stock/year=*")}
    assert years == {f"year={y}" for y in range(2012, 2019)} | {"year=__HIVE_DEFAULT_PARTITION__"}
    assert cat.stock().filter("year IS NULL").count() == cat.view("stock_base").filter("year IS NULL").count() > 0


def test_a_task_with_more_years_than_open_files_keeps_all_rows(spark, tmp_path):
    df = spark.range(1000).select("id", (F.col("id") % 40).cast("int").alias("year")).coalesce(1)
    with unsorted_writes(spark, 5):
        df.write.partitionBy("year").parquet(str(tmp_path / "t"))
    got = spark.read.parquet(str(tmp_path / "t"))
    assert got.count() == 1000 and got.filter("id % 40 <> year").count() == 0


def test_the_session_gets_its_setting_back(spark):
    spark.conf.unset(_WRITERS)
    default = spark.conf.get(_WRITERS)
    spark.conf.set(_WRITERS, "3")
    with unsorted_writes(spark, 9):
        with pytest.raises(ValueError), unsorted_writes(spark, 9):
            raise ValueError
        assert spark.conf.get(_WRITERS) == "9"
    assert spark.conf.get(_WRITERS) == "3"
    spark.conf.unset(_WRITERS)
    assert spark.conf.get(_WRITERS) == default
