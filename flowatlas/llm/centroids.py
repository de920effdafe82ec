"""Centroid clustering of integer vectors, with a rotated filter in front of
the exact distances.

The vectors' principal axes (of the covariance of all rows, summed task by
task) give a rotation. Per vector its first few rotated coordinates and the
norm of the others are stored beside its integer components. For a vector x
and a centroid c the distance of the stored coordinates plus the squared
difference of the residual norms never exceeds the squared distance of x and
c, so it is a lower bound. The exact integer distance to the centroid of the
least bound is taken first; only centroids whose bound does not exceed the
best distance so far are then measured, in integers as well. Bounds are
floating-point numbers, so they are lowered by far more than their rounding
can be; which centroids are skipped can depend on rounding, the result cannot.

Each round is one job: tasks assign their rows and sum them per centroid, and
one row per centroid and component comes back for the floored means.

Defined results: a vector that is null, has another number of components than
``dims``, or holds a null or non-finite component (or one beyond a long after
scaling) is left out. Centroids start as the vectors of the ids whose salted
SHA-256 is least; an id that occurs several times starts one centroid, with
the least of its vectors; null ids come last. Ties go to the smaller number,
empty centroids stay. With fewer ids than centroids there are as many as ids.
Distances and sums beyond a long are null. An empty table gives an empty
result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.llm.common import add_group_totals, register, save, ship_package, work_dir
from flowatlas.llm.vectors import (LONG_MAX, SUMS, Sums, floor_means, least, longs, matrix, pieces, roomy, scaled, usable, vectors_of)

CENTROIDS, ROUNDS, DIMS, SCALE, SALT = 8, 10, 64, 1024, "3:"
#: leading rotated coordinates that are stored
LEAD = 8
#: bounds are lowered by this share of the squared norms; rounding is some 1e-13 of them
SLACK = 1e-9


# ---------------------------------------------------------------- rotation
def _moments(shift: np.ndarray, dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((dims + 1, dims + 1))
        for batch in pieces(batches, dims):
            x = matrix(batch.column(0), dims).astype(np.float64) - shift
            x = np.concatenate([np.ones((len(x), 1)), x], axis=1)
            total += x.T @ x
        i, j = np.indices(total.shape)
        yield pa.RecordBatch.from_arrays([pa.array(i.ravel(), pa.int32()), pa.array(j.ravel(), pa.int32()), pa.array(total.ravel())],
                                         names=["i", "j", "s"])
    return run


def rotation(vectors: DataFrame, shift: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(mean, principal axes as columns, largest variance first) of the integer
    vectors ``v``; sums are taken of differences to ``shift``. (dims + 1)^2 sums
    come to the driver."""
    dims = len(shift)
    sums = vectors.select("v").mapInArrow(_moments(shift, dims), "i int, j int, s double").groupBy("i", "j").agg(F.sum("s").alias("s"))
    m = np.zeros((dims + 1, dims + 1))
    for r in sums.collect():
        m[r["i"], r["j"]] = r["s"]
    n = max(m[0, 0], 1.0)
    mean = m[0, 1:] / n
    cov = m[1:, 1:] / n - np.outer(mean, mean)
    values, axes = np.linalg.eigh((cov + cov.T) / 2)
    return shift + mean, axes[:, np.argsort(-values, kind="stable")]


def rotate(x: np.ndarray, mean: np.ndarray, axes: np.ndarray, lead: int) -> tuple[np.ndarray, np.ndarray]:
    """(the first ``lead`` rotated coordinates, the norm of the others)."""
    y = (x.astype(np.float64) - mean) @ axes
    return y[:, :lead], np.sqrt((y[:, lead:] ** 2).sum(1))


# -------------------------------------------------------------- assignment
def nearest(rows: np.ndarray, lead: np.ndarray, rest: np.ndarray, centres: np.ndarray, centre_lead: np.ndarray,
            centre_rest: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, exact squared distance) of each row's nearest centroid, and how
    many distances were measured in integers."""
    bound = ((lead[:, None] - centre_lead[None]) ** 2).sum(2) + (rest[:, None] - centre_rest[None]) ** 2
    norm = (lead**2).sum(1) + rest**2
    slack = SLACK * (norm[:, None] + ((centre_lead**2).sum(1) + centre_rest**2)[None]) + 1e-6
    number = bound.argmin(1)
    best = ((rows - centres[number]) ** 2).sum(1)
    first, measured = number.copy(), len(rows)
    for k in range(len(centres)):
        at = np.flatnonzero((bound[:, k] - slack[:, k] <= best.astype(np.float64) * (1 + SLACK)) & (first != k))
        if len(at):
            d = ((rows[at] - centres[k]) ** 2).sum(1)
            better = ((d < best[at]) | ((d == best[at]) & (k < number[at]))).astype(bool)
            best[at[better]], number[at[better]] = d[better], k
            measured += len(at)
    return number, best, measured


def _assign(batch: pa.RecordBatch, centres: np.ndarray, turned: tuple[np.ndarray, np.ndarray], lead: int):
    """(integer rows, numbers, distances) of a batch (v, lead, rest)."""
    dims = centres.shape[1]
    rows, middle = roomy((60 - dims.bit_length()) // 2, matrix(batch.column(0), dims), centres)
    number, d, _ = nearest(rows, matrix(batch.column(1), lead), batch.column(2).to_numpy(), middle, *turned)
    return rows, number, d


def cluster(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", centroids: int = CENTROIDS, rounds: int = ROUNDS,
            dims: int = DIMS, scale: int = SCALE, salt: str = SALT, lead: int = LEAD) -> tuple[DataFrame, np.ndarray]:
    """(id, cluster, distance) of every usable vector, written in the shared
    folder, and the final centroids (Python integers)."""
    spark = vectors.sparkSession
    ship_package(spark)
    folder = work_dir(spark, "clusters")
    v = F.col(vector_col)
    given = vectors.filter(usable(v, scale) & (F.size(v) == dims)).select(F.col(id_col).alias("id"), scaled(v, scale).alias("v"))
    kind = given.schema["id"].dataType.simpleString()
    result = f"id {kind}, cluster int, distance long"
    key = F.sha2(F.concat(F.lit(salt), F.col("id").cast("string")).cast("binary"), 256)
    keyed = given.withColumn("_key", key)
    start = [r["v"] for r in vectors_of(keyed, "_key", least(keyed, "_key", centroids)).collect()]  # at most ``centroids`` rows
    if not start:
        return spark.createDataFrame([], result), np.zeros((0, dims), object)
    centres = np.array(start, dtype=object).reshape(len(start), dims)
    lead = min(lead, dims)
    mean, axes = rotation(given, centres[0].astype(np.float64))

    def turn(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, dims):
            first, rest = rotate(matrix(batch.column(1), dims), mean, axes, lead)
            offsets = pa.array(np.arange(0, first.size + 1, lead), pa.int32())
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.ListArray.from_arrays(offsets, pa.array(first.ravel())), pa.array(rest)],
                                             names=["id", "v", "lead", "rest"])

    kept = save(given.mapInArrow(turn, f"id {kind}, v array<bigint>, lead array<double>, rest double"), f"{folder}/vectors", "zstd")

    def sums(centres: np.ndarray, turned: tuple[np.ndarray, np.ndarray]):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = Sums(len(centres), dims)
            for batch in pieces(batches, dims):
                rows, number, _ = _assign(batch, centres, turned, lead)
                total.add(number, roomy(40, rows)[0])
            yield total.batch()
        return run

    for _ in range(rounds):
        partial = kept.select("v", "lead", "rest").mapInArrow(sums(centres.astype(np.int64), rotate(centres, mean, axes, lead)), SUMS)
        moved = floor_means(partial, centres)
        if (moved == centres).all():  # the remaining rounds would change nothing
            break
        centres = moved
    last, turned = centres.astype(np.int64), rotate(centres, mean, axes, lead)

    def final(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, dims):
            _, number, d = _assign(pa.RecordBatch.from_arrays(batch.columns[1:], names=["v", "lead", "rest"]), last, turned, lead)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(number, pa.int32()), longs(d)], names=["id", "cluster", "distance"])

    return save(kept.mapInArrow(final, result), f"{folder}/assigned"), centres


def digest(centre) -> str:
    """SHA-256 of a centroid's components, joined by commas."""
    return hashlib.sha256(",".join(str(int(c)) for c in centre).encode()).hexdigest()


#: the same rounds, each a table of one row per centroid and place
def _oracle(centroids: int = CENTROIDS, rounds: int = ROUNDS, dims: int = DIMS, scale: int = SCALE, salt: str = SALT) -> str:
    sql = f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, embedding AS e FROM embeddings
  WHERE len(embedding) = {dims} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT vec_id, i, CAST(floor({scale}.0::DOUBLE * x::DOUBLE) AS BIGINT) AS x
  FROM (SELECT vec_id, unnest(e) AS x, unnest(range({dims})) AS i FROM kept)),
b0 AS MATERIALIZED (
  SELECT k, i, x AS y FROM cells
  JOIN (SELECT vec_id, row_number() OVER (ORDER BY sha256('{salt}' || vec_id)) - 1 AS k FROM kept QUALIFY k < {centroids}) USING (vec_id))"""
    for r in range(rounds + 1):
        sql += f""",
a{r} AS MATERIALIZED (
  SELECT vec_id, k, d FROM (
    SELECT vec_id, k, sum((x - y) * (x - y))::BIGINT AS d FROM cells JOIN b{r} USING (i) GROUP BY vec_id, k)
  QUALIFY row_number() OVER (PARTITION BY vec_id ORDER BY d, k) = 1)"""
        if r < rounds:
            sql += f""",
m{r} AS (SELECT k, i, sum(x)::BIGINT AS s, count(*) AS n FROM cells JOIN a{r} USING (vec_id) GROUP BY k, i),
b{r + 1} AS MATERIALIZED (
  SELECT k, i, CASE WHEN s IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END AS y FROM b{r} LEFT JOIN m{r} USING (k, i))"""
    return sql + f""",
final AS (SELECT k, sha256(string_agg(y::VARCHAR, ',' ORDER BY i)) AS centroid_sha256 FROM b{rounds} GROUP BY k)
SELECT vec_id, k::INTEGER AS cluster, d AS distance, sum(d) OVER (PARTITION BY k)::BIGINT AS cluster_inertia,
  sum(d) OVER ()::BIGINT AS inertia, centroid_sha256
FROM a{rounds} JOIN final USING (k)"""


@register("op12_centroid_clusters", _oracle())
def q_centroid_clusters(spark: SparkSession, sf: str) -> DataFrame:
    found, centres = cluster(spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding"))
    totals = add_group_totals(found, ["cluster"], "distance", "cluster_inertia")
    whole = found.agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s"), F.count_if(F.col("distance").isNull()).alias("n")).first()
    inertia = int(whole["s"]) if whole["s"] is not None and not whole["n"] and whole["s"] <= LONG_MAX else None
    names = spark.createDataFrame([(k, digest(c)) for k, c in enumerate(centres)], "cluster int, centroid_sha256 string")
    return totals.join(F.broadcast(names), "cluster").select(
        F.col("id").alias("vec_id"), "cluster", "distance", "cluster_inertia",
        F.lit(inertia).cast("long").alias("inertia"), "centroid_sha256")
