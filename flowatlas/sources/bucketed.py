"""Tables dealt by hash into buckets, so that grouping and windows on the
bucket columns need no shuffle.

Spark keeps the number of buckets in its table catalog, not beside the files.
``write`` therefore writes through a table name of its own and forgets the
name; ``read`` declares an external table over the folder, under a name that
follows from folder, schema and buckets, so any application can read files that
another one wrote. Dropping either name leaves the files in place.
"""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


@dataclass(frozen=True)
class Buckets:
    n: int
    by: tuple[str, ...]
    #: order of the rows of a file
    sort: tuple[str, ...] = ()


def deal(df: DataFrame, buckets: Buckets) -> DataFrame:
    """One partition per bucket, so that the write makes one file of each."""
    dealt = df.repartition(buckets.n, *buckets.by)
    return dealt.sortWithinPartitions(*buckets.sort) if buckets.sort else dealt


def write(df: DataFrame, path: str, buckets: Buckets) -> None:
    """``df`` as bucketed parquet in the new folder ``path``."""
    spark = df.sparkSession
    name = f"flowatlas_write_{uuid.uuid4().hex}"
    w = df.write.format("parquet").option("path", path).bucketBy(buckets.n, *buckets.by)
    (w.sortBy(*buckets.sort) if buckets.sort else w).saveAsTable(name)
    spark.sql(f"DROP TABLE {name}")


def read(spark: SparkSession, schema: T.StructType, path: str, buckets: Buckets) -> DataFrame:
    """The table that ``write`` left in ``path``; nothing is read for it."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    place = path.replace("\\", "\\\\").replace("'", "\\'")
    clustered = f"CLUSTERED BY ({', '.join(buckets.by)})"
    if buckets.sort:
        clustered += f" SORTED BY ({', '.join(buckets.sort)})"
    ddl = f"({columns}) USING parquet {clustered} INTO {buckets.n} BUCKETS LOCATION '{place}'"
    name = f"flowatlas_{hashlib.sha256(ddl.encode()).hexdigest()[:32]}"
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} {ddl}")
    return spark.table(name)
