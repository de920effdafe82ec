"""What physical files hold, from their footers and headers alone.

One row per file: tasks open the files and read Parquet footers or the first
line of (compressed) CSV, never the data. ``require_columns`` is the guard that
runs before a job: a folder in which one file lacks a column would otherwise
be read with silent nulls.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

FILE_SCHEMA = "dataset string, file string, exists boolean, columns array<string>"


class MissingColumnsError(ValueError):
    """A file lacks required columns, or is not there."""


def list_files(spark: SparkSession, path: str) -> list[str]:
    """The data files at or below ``path`` (hidden ones left out); none if it does not exist."""
    jvm = spark.sparkContext._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if not fs.exists(root):
        return []
    found, it = [], fs.listFiles(root, True)
    base = fs.makeQualified(root).toString()
    while it.hasNext():
        p = it.next().getPath().toString()
        if not any(s.startswith(("_", ".")) for s in p[len(base):].split("/") if s):
            found.append(p)
    return sorted(found)


def file_columns(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """(dataset, file, exists, columns) for every file of each dataset (name ->
    path); a path without files is one row that does not exist."""
    rows = []
    for name, path in paths.items():
        files = list_files(spark, path)
        rows += [(name, f, True) for f in files] or [(name, path, False)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import csv
        import pyarrow.parquet as pq
        from pyarrow import fs as afs

        def columns(uri: str) -> list[str]:
            if "://" in uri:
                files, path = afs.FileSystem.from_uri(uri)
            else:
                files, path = afs.LocalFileSystem(), uri.replace("file:", "", 1)
            folders = [s.split("=", 1)[0] for s in path.split("/")[:-1] if "=" in s]
            if path.endswith(".parquet"):
                with files.open_input_file(path) as src:
                    return pq.read_schema(src).names + folders
            with files.open_input_stream(path) as src:  # decompressed by its suffix
                head = b""
                while b"\n" not in head and (more := src.read(1 << 16)):
                    head += more
            line = head.split(b"\n", 1)[0].decode("utf-8", "replace").rstrip("\r")
            return (next(csv.reader([line])) if line else []) + folders

        for batch in batches:
            names = [columns(f) if there else None for f, there in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.list_(pa.string()))],
                                             names=["dataset", "file", "exists", "columns"])

    # a local table of names: Spark deals it over its cores without a shuffle
    table = spark.createDataFrame(rows, "dataset string, file string, exists boolean")
    return table.mapInArrow(run, FILE_SCHEMA)


def validate_files(spark: SparkSession, paths: dict[str, str], required: dict[str, list[str]]) -> DataFrame:
    """Per physical file: exists, number of columns, required and missing
    columns, status PASS, FAIL (columns missing) or MISSING (no such file)."""
    need = [(n, c) for n, c in required.items()]
    wanted = spark.createDataFrame(need, "dataset string, _need array<string>")
    missing = F.when(F.col("exists"), F.array_except("_need", "columns")).otherwise(F.col("_need"))
    return (file_columns(spark, paths).join(F.broadcast(wanted), "dataset").select(
        "dataset", "file", "exists", F.coalesce(F.size("columns"), F.lit(0)).alias("columns_in_preview"),
        F.array_join("_need", " | ").alias("required_columns"), F.array_join(missing, " | ").alias("missing_required_columns"),
        F.when(~F.col("exists"), "MISSING").when(F.size(missing) > 0, "FAIL").otherwise("PASS").alias("status")))


def require_columns(spark: SparkSession, paths: dict[str, str], required: dict[str, list[str]]) -> None:
    """Raises, naming the files, unless every file is there with its columns."""
    bad = validate_files(spark, paths, required).filter("status <> 'PASS'").orderBy("dataset", "file").limit(20).collect()
    if bad:
        raise MissingColumnsError("; ".join(f"{r['file']}: " + ("does not exist" if not r["exists"] else f"lacks {r['missing_required_columns']}")
                                            for r in bad))
