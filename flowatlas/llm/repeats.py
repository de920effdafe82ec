"""Substring dedup by sliding sentence spans.

A text is cut into sentences: after an end mark or a line, and before a
capitalised word, so that a passage pasted into a sentence starts one. Where
``WINDOW`` places in a row have no such cut, the text is also cut after the
word of the least hash among them (all of them, if a word repeats). From every
sentence the run of consecutive sentences with at least ``MIN_SENTENCES`` and
``MIN_WORDS`` is hashed, and likewise backwards from every sentence end. A run
that an earlier document has, or that stands earlier in the same document, is a
repeat; every sentence of a repeat is removed. Earlier is by document id.

Whether a place is cut depends on the words around it only, not on the length
of its sentence, and no sentence has more than ``WINDOW`` words. Any 51 equal
words therefore share a run, wherever they stand: a cut in the first window
(at word 13 at the latest), and the first cut 25 words on (at word 50 at the
latest), before which a window that reaches beyond the passage adds none.

The hashes are grouped globally with the least and greatest document of each,
added up map-side, so a passage in a third of all documents is one row per
task; only hashes of several documents are joined back, and a hot one is an
ordinary skewed join key.

Defined results: null or empty text has no sentences and stays as it is; rows
of one id are one document and not compared with each other, but each text
loses its own repeats only; documents without
an id come last, told apart by their text. Ids that are not whole numbers are
ordered by their hash. An empty table gives an empty result; other columns of
the table are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.llm.common import register, save, ship_package, work_dir
from flowatlas.llm.textops import SPACE, WordHasher, mix, powers

MIN_SENTENCES = 2
MIN_WORDS = 25
WINDOW = 13  # 2 * WINDOW + MIN_WORDS = 51


def order_key(docs: DataFrame, id_col: str, text: Column) -> Column:
    """A document's place in the order, a long that is never null."""
    whole = docs.schema[id_col].dataType.simpleString() in ("tinyint", "smallint", "int", "bigint")
    own = F.col(id_col).cast("long") if whole else F.shiftright(F.xxhash64(id_col), 2)
    return F.when(F.col(id_col).isNull(), F.lit(1 << 62) + F.shiftrightunsigned(F.xxhash64(text), 2)).otherwise(own)


def least_in_windows(rank: np.ndarray, size: int) -> np.ndarray:
    """Marks what is the least of some ``size`` consecutive values."""
    if len(rank) < size:
        return np.zeros(len(rank), bool)

    def slide(a: np.ndarray, pick) -> np.ndarray:
        n = 1
        while 2 * n <= size:
            a, n = pick(a[:-n], a[n:]), 2 * n
        return pick(a[:len(a) - (size - n)], a[size - n:])

    least = slide(rank, np.minimum)
    edge = np.zeros(size - 1, np.uint64)
    return slide(np.concatenate([edge, least, edge]), np.maximum) == rank


class Sentences:
    """Sentence starts and runs of a batch of texts."""

    def __init__(self):
        self.hasher = WordHasher(SPACE, lower=False)

    def cut(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(word hashes, first word of each text and the total, sentence starts as word numbers)."""
        words, first = self.hasher(texts)
        h = self.hasher
        a, s, e = h.text, h.start, h.end
        starts = np.zeros(len(words) + 1, bool)
        starts[first] = True
        if len(words):
            byte, follow = a[s], a[np.minimum(s + 1, len(a) - 1)]
            upper = (byte >= 65) & (byte <= 90) | (byte == 0xC3) & (follow >= 0x80) & (follow <= 0x9E) & (follow != 0x97)
            last = a[e - 1]
            after = (last == 46) | (last == 33) | (last == 63)  # . ! ?
            lines = np.concatenate([[0], np.cumsum(a == 10)])
            line = lines[s[1:]] != lines[e[:-1]]
            starts[:-1] |= upper
            starts[1:-1] |= after[:-1] | line
            starts[-1] = True
            rank = np.maximum(words, np.uint64(1))
            rank = np.where(starts, np.uint64(0), np.concatenate([rank[:1], rank]))
            starts |= least_in_windows(rank, WINDOW)
        return words, first, np.flatnonzero(starts)

    def runs(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """(hash, text number, first word, end) of every run; words are counted per text."""
        words, first, cuts = self.cut(texts)
        n = len(cuts) - 1
        if n < MIN_SENTENCES:
            z = np.zeros(0, np.int64)
            return z.view(np.uint64), z, z, z
        doc = np.searchsorted(first, cuts[:-1], side="right") - 1
        # forwards: from sentence i to the first cut that is far enough
        i = np.arange(n - MIN_SENTENCES + 1)
        far = np.searchsorted(cuts, np.maximum(cuts[i] + MIN_WORDS, cuts[i + MIN_SENTENCES]))
        ok = far <= n
        i, far = i[ok], far[ok]
        # backwards: to cut j from the last cut that is far enough
        j = np.arange(MIN_SENTENCES, n + 1)
        near = np.searchsorted(cuts, np.minimum(cuts[j] - MIN_WORDS, cuts[j - MIN_SENTENCES]), side="right") - 1
        ok = near >= 0
        j, near = j[ok], near[ok]
        pair = np.unique(np.concatenate([i * (n + 1) + far, near * (n + 1) + j]))
        i, j = pair // (n + 1), pair % (n + 1)
        inside = doc[i] == doc[j - 1]
        a, b, d = cuts[i[inside]], cuts[j[inside]], doc[i[inside]]
        total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(words * powers(len(words)), dtype=np.uint64)])
        h = mix((total[b] - total[a]) * powers(len(words) + 1, inverse=True)[a] + (b - a).astype(np.uint64))
        return h, d, a - first[d], b - first[d]


def span_rows(docs: DataFrame) -> DataFrame:
    """(hash, _k, _h, first, end, again) of all runs of (_k, _h, t); ``again``: it stands earlier in the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cutter = Sentences()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                h, d, a, b = cutter.runs(part.column(2).to_pylist())
                order = np.lexsort((a, h, d))
                again = np.zeros(len(h), bool)
                again[order[1:]] = (h[order[1:]] == h[order[:-1]]) & (d[order[1:]] == d[order[:-1]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(h.view(np.int64)), part.column(0).take(pa.array(d)), part.column(1).take(pa.array(d)), pa.array(a.astype(np.int32)),
                     pa.array(b.astype(np.int32)), pa.array(again)], names=["hash", "_k", "_h", "first", "end", "again"])

    return docs.mapInArrow(run, "hash long, _k long, _h long, first int, end int, again boolean")


def merge(ranges: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(ranges):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, text without its repeats, n_words, n_removed and the
    removed spans (first word, end) of the original text."""
    spark = docs.sparkSession
    ship_package(spark)
    path = work_dir(spark, "repeats")
    kind = docs.schema[id_col].dataType.simpleString()
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    # ranges of words belong to a text, not to an id, which may repeat with other texts
    keyed = docs.select(order_key(docs, id_col, t).alias("_k"), F.xxhash64(t).alias("_h"), t.cast("binary").alias("t"))
    spans = span_rows(keyed)
    shared = save(spans.groupBy("hash").agg(F.min("_k").alias("least"), F.max("_k").alias("_x")).filter("least < _x")
                  .select("hash", "least"), f"{path}/shared")
    found = spans.join(shared, "hash", "left").filter(F.col("again") | (F.col("least") < F.col("_k")))
    ranges = save(found.groupBy("_k", "_h").agg(F.collect_set(F.struct("first", "end")).alias("ranges")), f"{path}/ranges")
    rows = docs.select(order_key(docs, id_col, t).alias("_k"), F.xxhash64(t).alias("_h"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).cast("string").alias("text"))
    rows = rows.join(ranges, ["_k", "_h"], "left").select("doc_id", F.col("text").cast("binary").alias("text"), "ranges")
    span = pa.struct([("first", pa.int32()), ("end", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(SPACE, lower=False)
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                texts, ranges = part.column(1).to_pylist(), part.column(2).to_pylist()
                _, first = hasher([x or b"" for x in texts])
                begin = np.cumsum([0, *(len(x or b"") + 1 for x in texts)])
                out, gone, merged = [], [], []
                for i, (x, r) in enumerate(zip(texts, ranges)):
                    m = merge([(s["first"], s["end"]) for s in r]) if r else []
                    if m:
                        where = np.append(hasher.start[first[i]:first[i + 1]] - begin[i], len(x))
                        keep, at_byte = [], 0
                        for a, b in m:
                            keep.append(x[at_byte:where[a]])
                            at_byte = where[b]
                        x = b"".join([*keep, x[at_byte:]])
                    out.append(x)
                    gone.append(sum(b - a for a, b in m))
                    merged.append([{"first": a, "end": b} for a, b in m])
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), pa.array(out, pa.binary()).cast(pa.string()), pa.array(np.diff(first).astype(np.int64)),
                     pa.array(gone, pa.int64()), pa.array(merged, pa.list_(span))],
                    names=["doc_id", "text", "n_words", "n_removed", "spans"])

    return rows.mapInArrow(run, f"doc_id {kind}, text string, n_words long, n_removed long, spans array<struct<first:int,end:int>>")


@register("op4_sentence_spans")
def q_sentence_spans(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return remove_repeats(docs)
