"""Best-fit packing of token pieces into sequences of a fixed capacity.

Lengths are whole numbers up to the capacity, so how many pieces of each
length there are says all that packing needs: the table of counts has at most
``capacity`` rows whatever the corpus. On these counts the plan is made:

* pieces above a third of the capacity fit at most twice in a sequence; the
  longest takes the longest other that still fits (greedy matching);
* smaller ones, longest first, go to the sequences with the tightest gap that
  holds them, and to new sequences once none does.

All pieces of one length that are treated alike are one entry of the plan. A
piece finds its entry by its rank among the pieces of its length, which is
the rank within its writing task plus the count in earlier tasks, so no task
ever holds all pieces of a length, however hot.

Defined results: null or empty text is a document of the end id alone.
Repeated rows and null ids are documents of their own. Only documents longer
than the capacity are cut, into full pieces and a rest. An empty table gives
an empty result. Other columns are not read.
"""

from __future__ import annotations

from bisect import bisect_left, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowatlas.llm.common import register, save, ship_package, work_dir
from flowatlas.llm.tokens import END_ID, encoder, tokenizer_path

CAPACITY = 4096
PIECES = "doc_id {id}, piece int, start long, length int, ids binary, bucket int, pos long"


# ------------------------------------------------------------------- plan
def pack_counts(lengths: list[int], counts: list[int], capacity: int) -> tuple[np.ndarray, int]:
    """Plan entries (length, first rank, first sequence, pieces per sequence,
    offset), one row for each run of equally treated pieces, and the number of
    sequences. Entry i of a length holds ranks up to the next entry's first."""
    left = {n: c for n, c in zip(lengths, counts) if c}
    rank = dict.fromkeys(left, 0)
    entries: list[tuple[int, int, int, int, int]] = []
    gaps: dict[int, list[list[int]]] = {}  # gap -> runs [first sequence, number]
    order: list[int] = []                  # the gaps in use, ascending
    used = 0

    def place(n: int, k: int, first: int, per: int, offset: int) -> None:
        entries.append((n, rank[n], first, per, offset))
        rank[n] += k
        left[n] -= k

    def add(gap: int, first: int, number: int) -> None:
        if gap > 0 and number:
            if gap not in gaps:
                gaps[gap] = []
                insort(order, gap)
            gaps[gap].append([first, number])

    large = sorted(n for n in left if 3 * n > capacity)
    while large:
        a = large[-1]
        if 2 * a <= capacity and left[a] >= 2:
            b, k = a, left[a] // 2
            place(a, 2 * k, used, 2, 0)
        else:
            at = bisect_left(large, capacity - a + 1) - 1
            while at >= 0 and large[at] == a:
                at -= 1
            b = large[at] if at >= 0 else 0
            k = min(left[a], left[b]) if b else left[a]
            place(a, k, used, 1, 0)
            if b:
                place(b, k, used, 1, a)
        add(capacity - a - b, used, k)
        used += k
        for n in {a, b} - {0}:
            if not left[n]:
                large.remove(n)
    for n in sorted((n for n in left if left[n]), reverse=True):
        while left[n]:
            at = bisect_left(order, n)
            if at == len(order):
                gap, per = capacity, capacity // n
                number = -(-left[n] // per)
                run = [used, number]
                used += number
            else:
                gap = order[at]
                per, run = gap // n, gaps[gap].pop()
                if not gaps[gap]:
                    del gaps[gap]
                    order.pop(at)
            first, number = run
            full = min(number, left[n] // per)
            if full:
                place(n, full * per, first, per, capacity - gap)
                add(gap - per * n, first, full)
            rest = left[n] if full < number and left[n] < per else 0
            if rest:
                place(n, rest, first + full, per, capacity - gap)
                add(gap - rest * n, first + full, 1)
            if gap < capacity:
                add(gap, first + full + bool(rest), number - full - bool(rest))
    plan = np.array(entries, np.int64).reshape(-1, 5)
    return plan[np.lexsort((plan[:, 1], plan[:, 0]))], used


# ----------------------------------------------------------------- pieces
def cut_pieces(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
               text_col: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids, bucket, pos): every document's ids
    (little-endian unsigned 32-bit) with the end id, cut at the capacity;
    ``pos`` counts the pieces of one length in the task ``bucket``."""
    ship_package(docs.sparkSession)
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, seen, bucket = encoder(tokenizer), np.zeros(capacity + 1, np.int64), TaskContext.get().partitionId()
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                out: list[list] = [[], [], [], [], [], []]
                rows = []
                for i, raw in enumerate(enc.encode(part.column(1).to_pylist())):
                    ids = np.append(np.frombuffer(raw, enc.dtype), END_ID).astype("<u4")
                    for p, s in enumerate(range(0, len(ids), capacity)):
                        piece = ids[s:s + capacity]
                        rows.append(i)
                        for column, x in zip(out, (p, s, len(piece), piece.tobytes(), bucket, int(seen[len(piece)]))):
                            column.append(x)
                        seen[len(piece)] += 1
                types = (pa.int32(), pa.int64(), pa.int32(), pa.binary(), pa.int32(), pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0).take(pa.array(rows, pa.int32())), *[pa.array(c, t) for c, t in zip(out, types)]],
                    names=["doc_id", "piece", "start", "length", "ids", "bucket", "pos"])

    narrow = docs.select(F.col(id_col).alias("doc_id"),
                         F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    return narrow.mapInArrow(run, PIECES.format(id=kind))


def place_pieces(pieces: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """``pieces`` with sequence_id and offset instead of bucket and pos."""
    spark = pieces.sparkSession
    counts = pieces.groupBy("length", "bucket").agg((F.max("pos") + 1).alias("_n"))
    before = Window.partitionBy("length").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("length", "bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_first"))
    table = counts.groupBy("length").agg(F.sum("_n").alias("n")).collect()  # at most ``capacity`` rows
    plan, _ = pack_counts([r["length"] for r in table], [r["n"] for r in table], capacity)
    shared = spark.sparkContext.broadcast(plan)  # bounded by the capacity as well
    cols = [c for c in pieces.columns if c not in ("bucket", "pos")]
    ranked = pieces.join(first, ["length", "bucket"]).select(*cols, (F.col("_first") + F.col("pos")).alias("_rank"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        plan = shared.value
        keys = (plan[:, 0] << 48) + plan[:, 1]
        for b in batches:
            n = b.column(cols.index("length")).to_numpy().astype(np.int64)
            rank = b.column(len(cols)).to_numpy()
            e = plan[np.searchsorted(keys, (n << 48) + rank, side="right") - 1]
            k = rank - e[:, 1]
            yield pa.RecordBatch.from_arrays(
                [*b.columns[:-1], pa.array(e[:, 2] + k // e[:, 3]), pa.array(e[:, 4] + k % e[:, 3] * n)],
                names=[*cols, "sequence_id", "offset"])

    kinds = ", ".join(f"`{c}` {pieces.schema[c].dataType.simpleString()}" for c in cols)
    return ranked.mapInArrow(run, f"{kinds}, sequence_id long, offset long")


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, ids): the packed sequences, at most ``capacity`` ids each."""
    g = packed.groupBy("sequence_id").agg(F.sum("length").alias("n_tokens"),
                                          F.array_sort(F.collect_list(F.struct("offset", "ids"))).alias("_p"))
    return g.select("sequence_id", "n_tokens", F.aggregate(
        "_p", F.lit(b"").cast("binary"), lambda a, p: F.concat(a, p["ids"])).alias("ids"))


def pack_documents(docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """Pieces of all documents, written once, with crc32 of their ids and place."""
    cut = cut_pieces(docs, tokenizer, capacity, id_col, text_col)
    pieces = save(cut, work_dir(docs.sparkSession, "pieces"), "zstd")
    narrow = pieces.select("doc_id", "piece", "start", F.col("length"), F.crc32("ids").alias("ids_crc32"), "bucket", "pos")
    return place_pieces(narrow, capacity).withColumn("length", F.col("length").cast("long"))


@register("op5_packing")
def q_packing(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return pack_documents(docs, tokenizer_path())
