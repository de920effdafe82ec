"""Vector codes: each of several equal parts of a vector is replaced by the
number of the nearest entry of that part's codebook, all in integers.

Distances are compared after an integer Walsh-Hadamard transform of the parts
and entries, padded with zeros to a power of two, P. The transform multiplies
squared distances by exactly P, and coefficients in sequency order (fewest
sign changes first) carry most of it early. So squared differences are summed
in that order, and an entry is dropped as soon as its sum so far is above the
whole scaled distance of the entry that leads after the first coefficients.
Sums only grow, so no dropped entry could win; what is left is exact.

Codebooks start as the parts of the least ids and are moved for a fixed number
of rounds to the floored means of their parts: each round is one job in which
every task sums its own parts, and one row per component (parts x entries x
part width) comes back.

Defined results: a vector that is null or holds a null or non-finite component
(or one beyond a long after scaling) is left out. Vectors shorter than the
longest, whose length is taken up to a multiple of the number of parts, count
as followed by zeros; an empty vector is all zeros. An id that occurs several
times starts one entry, with the least of its vectors; null ids come last.
Ties go to the lower entry. With fewer ids than entries the codebook is as
long as there are ids. Errors and sums beyond a long are null. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.llm.common import add_group_totals, register, save, ship_package, work_dir
from flowatlas.llm.vectors import (SUMS, Sums, floor_means, least, longs, matrix, pieces, roomy, scaled, usable, vectors_of)

PARTS, ENTRIES, ROUNDS, SCALE = 8, 16, 6, 4096


def walsh(x: np.ndarray) -> np.ndarray:
    """Walsh-Hadamard transform of each row (a power of two wide), in natural order."""
    n, size = x.shape
    h = 1
    while h < size:
        y = x.reshape(n, size // (2 * h), 2, h)
        a, b = y[:, :, :1], y[:, :, 1:]
        x = np.concatenate([a + b, a - b], axis=2).reshape(n, size)
        h *= 2
    return x


def sequency(size: int) -> np.ndarray:
    """Places of the transform's coefficients by their number of sign changes."""
    signs = walsh(np.eye(size, dtype=np.int64))
    return np.argsort((signs[:, 1:] != signs[:, :-1]).sum(1), kind="stable")


def coefficients(x: np.ndarray) -> np.ndarray:
    """Rows padded with zeros to a power of two and transformed, in sequency order."""
    size = 1 << (x.shape[1] - 1).bit_length()
    padded = np.concatenate([x, np.zeros((len(x), size - x.shape[1]), x.dtype)], axis=1)
    return walsh(padded)[:, sequency(size)]


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray, int]:
    """(number, squared distance) of each row's nearest entry, both given by their
    coefficients, and how many squared differences were summed."""
    size = x.shape[1]
    lead = max(1, size // 4)
    so_far = ((x[:, None, :lead] - entries[None, :, :lead]) ** 2).sum(2)
    bound = ((x - entries[so_far.argmin(1)]) ** 2).sum(1)
    row, entry = np.nonzero(so_far <= bound[:, None])
    total, work = so_far[row, entry], so_far.size * lead
    for j in range(lead, size):
        total = total + (x[row, j] - entries[entry, j]) ** 2
        work += len(total)
        alive = (total <= bound[row]).astype(bool)
        row, entry, total = row[alive], entry[alive], total[alive]
    # every row still has its leader; pairs lie by row, then entry
    first = np.flatnonzero(np.diff(row, prepend=-1))
    best = np.minimum.reduceat(total, first) if len(first) else total
    hit = np.flatnonzero((total == best[row]).astype(bool))
    _, at = np.unique(row[hit], return_index=True)
    return entry[hit[at]], best // size, work


@dataclass
class Codebooks:
    """``entries[part][number]`` is a list of integer components."""
    entries: np.ndarray  # (parts, entries, part width), Python integers

    def digest(self) -> str:
        """SHA-256 of all components by part, entry and place, joined by commas."""
        return hashlib.sha256(",".join(str(int(c)) for c in self.entries.ravel()).encode()).hexdigest()

    def decode(self, code: bytes) -> list[int]:
        """The vector that a code stands for."""
        return [int(c) for part, number in enumerate(code) for c in self.entries[part, number]]


def encode(rows: np.ndarray, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Codes (rows x parts) and squared errors of integer vectors."""
    parts, _, width = books.shape
    # of 2^k coefficients, sums of 2^k components each, the squared differences sum to less than 2^63 over all parts
    bits = max(0, (60 - 3 * (width - 1).bit_length() - parts.bit_length()) // 2)
    rows, books = roomy(bits, rows, books)
    codes, error = np.zeros((len(rows), parts), np.int64), np.zeros(len(rows), rows.dtype)
    for p in range(parts):
        codes[:, p], d, _ = nearest(coefficients(rows[:, p * width:(p + 1) * width]), coefficients(books[p]))
        error = error + d
    return codes, error


def compress(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", keep: tuple[str, ...] = (),
             parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> tuple[DataFrame, Codebooks]:
    """(id, ``keep`` as k0, k1, ..., code binary, error) of every usable vector, written
    in the shared folder, and the codebooks. At most 256 entries (one byte a part)."""
    if not 1 <= entries <= 256:
        raise ValueError("1 to 256 entries")
    spark = vectors.sparkSession
    ship_package(spark)
    folder = work_dir(spark, "codes")
    v = F.col(vector_col)
    others = [F.col(c).alias(f"k{i}") for i, c in enumerate(keep)]
    kept = save(vectors.filter(usable(v, scale)).select(F.col(id_col).alias("id"), *others, scaled(v, scale).alias("v")),
                f"{folder}/vectors", "zstd")
    longest = kept.agg(F.max(F.size("v"))).first()[0]
    kinds = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept.schema if f.name != "v")
    result = f"{kinds}, code binary, error long"
    if longest is None:
        return spark.createDataFrame([], result), Codebooks(np.zeros((parts, 0, 0), object))
    width = max(1, -(-longest // parts))
    start = [r["v"] for r in vectors_of(kept, "id", least(kept, "id", entries)).collect()]  # at most ``entries`` rows
    books = np.zeros((len(start), parts * width), object)
    for k, vector in enumerate(start):
        books[k, :len(vector)] = vector
    books = books.reshape(len(start), parts, width).transpose(1, 0, 2)

    def sums(books: np.ndarray):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            total = Sums(parts * books.shape[1], width)
            for batch in pieces(batches, parts * width):
                rows = matrix(batch.column(0), parts * width)
                codes, _ = encode(rows, books)
                rows, = roomy(40, rows)
                for p in range(parts):
                    total.add(codes[:, p] + p * books.shape[1], rows[:, p * width:(p + 1) * width])
            yield total.batch()
        return run

    for _ in range(rounds):
        partial = kept.select("v").mapInArrow(sums(books.astype(np.int64)), SUMS)
        moved = floor_means(partial, books.reshape(-1, width)).reshape(books.shape)
        if (moved == books).all():  # the remaining rounds would change nothing
            break
        books = moved
    last = books.astype(np.int64)

    def codes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches, parts * width):
            code, error = encode(matrix(batch.column(batch.num_columns - 1), parts * width), last)
            code = pa.array([c.tobytes() for c in code.astype(np.uint8)], pa.binary())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], code, longs(error)], names=[*batch.schema.names[:-1], "code", "error"])

    return save(kept.mapInArrow(codes, result), f"{folder}/codes"), Codebooks(books)


#: the same rounds, each a table of one row per part, entry and place
def _oracle(parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE) -> str:
    sql = f"""WITH kept AS MATERIALIZED (
  SELECT vec_id, label, embedding AS e, len(embedding) // {parts} AS w FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
cells AS MATERIALIZED (
  SELECT vec_id, i // w AS p, i % w AS i, CAST(floor({scale}.0::DOUBLE * x::DOUBLE) AS BIGINT) AS x
  FROM (SELECT vec_id, w, unnest(e) AS x, unnest(range(len(e))) AS i FROM kept)),
b0 AS MATERIALIZED (
  SELECT p, k, i, x AS y FROM cells
  JOIN (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS k FROM kept QUALIFY k < {entries}) USING (vec_id))"""
    for r in range(rounds + 1):
        sql += f""",
a{r} AS MATERIALIZED (
  SELECT vec_id, p, k, d FROM (
    SELECT vec_id, p, k, sum((x - y) * (x - y))::BIGINT AS d FROM cells JOIN b{r} USING (p, i) GROUP BY vec_id, p, k)
  QUALIFY row_number() OVER (PARTITION BY vec_id, p ORDER BY d, k) = 1)"""
        if r < rounds:
            sql += f""",
m{r} AS (SELECT p, k, i, sum(x)::BIGINT AS s, count(*) AS n FROM cells JOIN a{r} USING (vec_id, p) GROUP BY p, k, i),
b{r + 1} AS MATERIALIZED (
  SELECT p, k, i, CASE WHEN s IS NULL THEN y ELSE (s - ((s % n) + n) % n) // n END AS y FROM b{r} LEFT JOIN m{r} USING (p, k, i))"""
    return sql + f""",
coded AS (
  SELECT vec_id, string_agg(printf('%02x', k), '' ORDER BY p) AS code, sum(d)::BIGINT AS error FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, sum(error) OVER (PARTITION BY label)::BIGINT AS label_error,
  (SELECT sha256(string_agg(y::VARCHAR, ',' ORDER BY p, k, i)) FROM b{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)"""


@register("op11_vector_codes", _oracle())
def q_vector_codes(spark: SparkSession, sf: str) -> DataFrame:
    table = spark.read.parquet(f"{sf}/embeddings.parquet").select("vec_id", "embedding", "label")
    coded, books = compress(table, keep=("label",))
    out = add_group_totals(coded, ["k0"], "error", "label_error")
    return out.select(F.col("id").alias("vec_id"), F.lower(F.hex("code")).alias("code"), "error", "label_error",
                      F.lit(books.digest()).alias("codebooks_sha256"))
