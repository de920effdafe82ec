"""Integer vectors: scaled components, whole batches as matrices, exact sums
over all tasks, and the least distinct values of a column.

Components are ``floor(scale * x)``. Matrices are ``int64`` while every
intermediate result surely fits, and hold Python integers beyond.
"""

from __future__ import annotations

from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: components a matrix of one step holds at most
CELLS = 1 << 20
LONG_MAX = (1 << 63) - 1
EXACT = pa.decimal128(38, 0)


def usable(vector: Column, scale: int) -> Column:
    """Not null, and all components finite, not null and, scaled, within a long."""
    limit = F.lit(2.0**63 / scale)
    return vector.isNotNull() & F.forall(vector, lambda x: F.coalesce(F.abs(x.cast("double")) < limit, F.lit(False)))


def scaled(vector: Column, scale: int) -> Column:
    """floor(scale * x) of every component, as longs."""
    return F.transform(vector, lambda x: F.floor(x.cast("double") * F.lit(float(scale))).cast("long"))


def matrix(column: pa.Array, width: int) -> np.ndarray:
    """Rows of a list column, shorter ones followed by zeros."""
    flat = column.flatten().to_numpy(zero_copy_only=False)
    n = column.value_lengths().to_numpy(zero_copy_only=False)
    if len(flat) == len(n) * width:
        return flat.reshape(len(n), width)
    out = np.zeros((len(n), width), flat.dtype)
    out[np.arange(width) < n[:, None]] = flat
    return out


def pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """The batches cut so that a matrix of ``width`` columns stays small."""
    step = max(1, CELLS // max(1, width))
    for batch in batches:
        for at in range(0, batch.num_rows, step):
            yield batch.slice(at, step)


def roomy(bits: int, *arrays: np.ndarray) -> list[np.ndarray]:
    """The arrays as ``int64`` if all values are below 2^bits, else as Python integers."""
    fits = all(a.dtype != object and (not a.size or int(a.max()) < 1 << bits and int(a.min()) > -(1 << bits)) for a in arrays)
    return [a.astype(np.int64 if fits else object) for a in arrays]


def longs(values: np.ndarray) -> pa.Array:
    """As longs; null where one does not fit."""
    if values.dtype != object:
        return pa.array(values, pa.int64())
    return pa.array([int(v) if abs(v) <= LONG_MAX else None for v in values], pa.int64())


class Sums:
    """Exact sums and counts of rows per group, for one task."""

    def __init__(self, groups: int, width: int):
        self.n = np.zeros(groups, np.int64)
        self.total = np.zeros((groups, width), object)

    def add(self, group: np.ndarray, rows: np.ndarray) -> None:
        for g in np.unique(group).tolist():
            at = group == g
            self.n[g] += int(at.sum())
            self.total[g] += rows[at].sum(0)

    def batch(self) -> pa.RecordBatch:
        """(g, place, total): the sum of each component, and at place -1 the count."""
        used = np.flatnonzero(self.n)
        width = self.total.shape[1]
        cells = np.concatenate([self.n[used, None].astype(object), self.total[used]], axis=1).ravel()
        return pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(used, width + 1), pa.int32()), pa.array(np.tile(np.arange(-1, width), len(used)), pa.int32()),
             pa.array([Decimal(int(c)) for c in cells], EXACT)], names=["g", "place", "total"])


SUMS = "g int, place int, total decimal(38,0)"


def floor_means(partial: DataFrame, centres: np.ndarray) -> np.ndarray:
    """``centres`` (Python integers) with floor(sum / count) for every group
    that has rows. ``partial`` holds the tasks' sums; one row per component
    comes to the driver."""
    out = centres.copy()
    rows = partial.groupBy("g", "place").agg(F.sum("total").alias("total")).collect()
    count = {r["g"]: int(r["total"]) for r in rows if r["place"] < 0}
    for r in rows:
        if r["place"] >= 0:
            out[r["g"], r["place"]] = int(r["total"]) // count[r["g"]]
    return out


def least(df: DataFrame, column: str, n: int) -> DataFrame:
    """The ``n`` least distinct values of a column, nulls last. Each task hands
    on its ``n`` least, so repeats cost nothing."""
    one = df.select(column)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            held = pc.unique(batch.column(0) if held is None else pa.concat_arrays([held, batch.column(0)]))
            held = held.take(pc.array_sort_indices(held, null_placement="at_end")[:n])
        if held is not None:
            yield pa.RecordBatch.from_arrays([held], names=[column])

    kind = one.schema[0].dataType.simpleString()
    return one.mapInArrow(run, f"`{column}` {kind}").distinct().orderBy(F.col(column).asc_nulls_last()).limit(n)


def vectors_of(df: DataFrame, column: str, values: DataFrame) -> DataFrame:
    """For each of a few ``values`` (as of ``least``) the least vector ``v`` that a
    row with it holds, in the same order."""
    few = F.broadcast(values.withColumnRenamed(column, "_value"))
    hit = df.join(few, F.col(column).eqNullSafe(F.col("_value")))
    return hit.groupBy("_value").agg(F.min("v").alias("v")).orderBy(F.col("_value").asc_nulls_last())
