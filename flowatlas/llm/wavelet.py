"""Token ids in wavelet-matrix shards: succinct, searchable, one file each.

A shard holds the ids of consecutive documents. Plane by plane, from the
highest bit of an id to the lowest, the bit of every id is stored and the ids
are stably parted, zeros first (a wavelet matrix). A plane is cut into blocks
of ``BLOCK`` bits, compressed one by one, with the number of ones before each
block. From this one file a reader gets the id at a place (``access``), how
often an id occurs before a place (``rank``), where its k-th occurrence is
(``select``), all its occurrences, and the whole sequence.

Layout: magic, length of the header, header (Arrow stream: document ids and
token counts, and the planes' sizes as JSON metadata), blocks.

``write_shards`` deals the documents out by ranges of their id, sorts each
range and writes its shards in the task; the text is shuffled once and ids
never are. Shards of lost task attempts are in no manifest.

Defined results: null or empty text is a document of the end id alone; null
ids sort first; rows that repeat an id are documents of their own, in order of
their text. An empty table has no shards. Other columns are not read.
"""

from __future__ import annotations

import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowatlas.llm.common import register, save, ship_package, work_dir
from flowatlas.llm.files import read_bytes, unique, write_bytes
from flowatlas.llm.tokens import END_ID, crc32_u32, encoder, tokenizer_path

MAGIC = b"TOKWM01\n"
BLOCK = 1 << 18        # bits of a plane per compressed block
SHARD_TOKENS = 1 << 21  # a shard is closed once it holds so many ids


# ------------------------------------------------------------------ format
def encode_shard(ids: np.ndarray, doc_ids: pa.Array, n_tokens: list[int], bits: int) -> bytes:
    """The file of one shard; ``bits``: planes, enough for every id."""
    zip_ = zstandard.ZstdCompressor(level=1)
    planes, blobs = [], []
    s = ids
    for shift in range(bits - 1, -1, -1):
        b = ((s >> s.dtype.type(shift)) & s.dtype.type(1)).view(bool) if s.dtype.itemsize == 1 else (s & s.dtype.type(1 << shift)) != 0
        # places first: numpy finds them without a branch per bit, unlike s[b]
        ones_at, zeros_at = np.flatnonzero(b), np.flatnonzero(~b)
        packed = np.packbits(b)
        sizes, ones, at = [], [], 0
        for k in range(0, len(packed), BLOCK // 8):
            raw = packed[k:k + BLOCK // 8]
            blobs.append(zip_.compress(raw.tobytes()))
            sizes.append(len(blobs[-1]))
            ones.append(at)
            at += int(np.bitwise_count(raw).sum())
        planes.append({"zeros": len(zeros_at), "sizes": sizes, "ones": ones})
        s = np.concatenate([s[zeros_at], s[ones_at]])
    meta = {"n": len(ids), "bits": bits, "block": BLOCK, "planes": planes}
    table = pa.table({"doc_id": doc_ids, "n_tokens": pa.array(n_tokens, pa.int64())}).replace_schema_metadata(
        {"shard": json.dumps(meta, separators=(",", ":"))})
    sink = pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as w:
        w.write_table(table)
    header = sink.getvalue().to_pybytes()
    return b"".join([MAGIC, struct.pack("<Q", len(header)), header, *blobs])


class Shard:
    """Reader of one shard's bytes; a block is unpacked only when needed."""

    def __init__(self, data: bytes):
        if data[:len(MAGIC)] != MAGIC:
            raise ValueError("not a token shard")
        at = len(MAGIC) + 8
        size, = struct.unpack("<Q", data[at - 8:at])
        table = pa.ipc.open_stream(data[at:at + size]).read_all()
        meta = json.loads(table.schema.metadata[b"shard"])
        self.n, self.bits, self.block, self.planes = meta["n"], meta["bits"], meta["block"], meta["planes"]
        self.documents, self.data = table, memoryview(data)
        self.offsets, at = [], at + size
        for p in self.planes:
            ends = np.cumsum([at, *p["sizes"]])
            self.offsets.append(ends[:-1].tolist())
            at = int(ends[-1])
        self._zip = zstandard.ZstdDecompressor()
        self._bits: dict[tuple[int, int], np.ndarray] = {}

    def _packed(self, plane: int, k: int) -> np.ndarray:
        at = self.offsets[plane][k]
        return np.frombuffer(self._zip.decompress(self.data[at:at + self.planes[plane]["sizes"][k]]), np.uint8)

    def _block(self, plane: int, k: int) -> np.ndarray:
        if (plane, k) not in self._bits:
            if len(self._bits) >= 64:
                self._bits.pop(next(iter(self._bits)))
            self._bits[plane, k] = np.unpackbits(self._packed(plane, k))
        return self._bits[plane, k]

    def _ones(self, plane: int, i: int) -> int:
        """Ones among the first ``i`` bits of a plane."""
        k, rest = divmod(i, self.block)
        ones = self.planes[plane]["ones"]
        if k >= len(ones):
            return self.n - self.planes[plane]["zeros"]
        return ones[k] + (int(self._block(plane, k)[:rest].sum()) if rest else 0)

    def _where(self, plane: int, bit: int, j: int) -> int:
        """Position of the j-th (from 0) one or zero of a plane."""
        ones = np.array(self.planes[plane]["ones"])
        before = ones if bit else np.arange(len(ones)) * self.block - ones
        k = int(np.searchsorted(before, j, side="right")) - 1
        hits = np.flatnonzero(self._block(plane, k)[: self.n - k * self.block] == bit)
        return k * self.block + int(hits[j - before[k]])

    def access(self, i: int) -> int:
        if not 0 <= i < self.n:
            raise IndexError(i)
        v = 0
        for p in range(self.bits):
            bit = int(self._block(p, i // self.block)[i % self.block])
            one = self._ones(p, i)
            i = self.planes[p]["zeros"] + one if bit else i - one
            v = v << 1 | bit
        return v

    def _range(self, token: int, i: int) -> tuple[int, int]:
        """Where the token's occurrences before ``i`` lie after the last plane."""
        lo, hi = 0, min(max(i, 0), self.n)
        if token >> self.bits:
            return 0, 0
        for p in range(self.bits):
            a, b = self._ones(p, lo), self._ones(p, hi)
            if token >> (self.bits - 1 - p) & 1:
                lo, hi = self.planes[p]["zeros"] + a, self.planes[p]["zeros"] + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def rank(self, token: int, i: int) -> int:
        """Occurrences of ``token`` among the first ``i`` ids."""
        lo, hi = self._range(token, i)
        return hi - lo

    def count(self, token: int) -> int:
        return self.rank(token, self.n)

    def select(self, token: int, k: int) -> int:
        """Place of the k-th (from 0) occurrence."""
        lo, hi = self._range(token, self.n)
        if not 0 <= k < hi - lo:
            raise IndexError(k)
        i = lo + k
        for p in range(self.bits - 1, -1, -1):
            zeros = self.planes[p]["zeros"]
            i = self._where(p, 1, i - zeros) if i >= zeros else self._where(p, 0, i)
        return i

    def occurrences(self, token: int) -> list[int]:
        return [self.select(token, k) for k in range(self.count(token))]

    def ids(self) -> np.ndarray:
        """The whole sequence, rebuilt from the last plane to the first."""
        s = np.zeros(self.n, np.uint16 if self.bits <= 16 else np.uint32)
        for p in range(self.bits - 1, -1, -1):
            packed = [self._packed(p, k) for k in range(len(self.offsets[p]))]
            b = np.unpackbits(np.concatenate(packed), count=self.n).view(bool) if packed else np.zeros(0, bool)
            zeros = self.planes[p]["zeros"]
            up = np.empty_like(s)
            up[np.flatnonzero(b)] = s[zeros:] | s.dtype.type(1 << (self.bits - 1 - p))
            up[np.flatnonzero(~b)] = s[:zeros]
            s = up
        return s


# ------------------------------------------------------------------ writing
def write_shards(docs: DataFrame, folder: str, tokenizer: str, id_col: str = "doc_id", text_col: str = "text",
                 shard_tokens: int = SHARD_TOKENS) -> DataFrame:
    """Writes the shards and returns the manifest (part, seq, path, n_docs,
    n_tokens, n_bytes), itself a table in ``folder``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, part = encoder(tokenizer), TaskContext.get().partitionId()
        bits = max(enc.size - 1, END_ID).bit_length()
        ids: list[np.ndarray] = []
        doc_ids: list[pa.Array] = []
        counts: list[int] = []
        held, seq = 0, 0

        def flush() -> pa.RecordBatch:
            nonlocal held, seq
            whole = pa.concat_arrays(doc_ids)
            data = encode_shard(np.concatenate(ids), whole, counts, bits)
            path = unique(folder + "/shards", f"part-{part:06d}-{seq:05d}", ".tokwm")
            write_bytes(path, data)
            row = [[part], [seq], [path], [len(counts)], [held], [len(data)]]
            ids.clear(), doc_ids.clear(), counts.clear()
            held, seq = 0, seq + 1
            return pa.RecordBatch.from_arrays(
                [pa.array(x, t) for x, t in zip(row, (pa.int32(), pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int64()))],
                names=["part", "seq", "path", "n_docs", "n_tokens", "n_bytes"])

        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                piece = batch.slice(at, 128)
                doc_ids.append(piece.column(0))
                for raw in enc.encode(piece.column(1).to_pylist()):
                    x = np.append(np.frombuffer(raw, enc.dtype), enc.dtype.type(END_ID))
                    ids.append(x)
                    counts.append(len(x))
                    held += len(x)
                if held >= shard_tokens:
                    yield flush()
        if counts:
            yield flush()

    ship_package(docs.sparkSession)
    narrow = docs.select(F.col(id_col).alias("doc_id"),
                         F.coalesce(F.col(text_col).cast("binary"), F.lit(b"")).alias("text"))
    ranged = narrow.repartitionByRange("doc_id").sortWithinPartitions("doc_id", "text")
    return save(ranged.mapInArrow(run, "part int, seq int, path string, n_docs long, n_tokens long, n_bytes long"),
                f"{folder}/manifest")


def shard_starts(manifest: DataFrame) -> DataFrame:
    """The manifest with ``first``: ids in all shards before. One row per
    shard, i.e. per ``SHARD_TOKENS`` ids: counts per part are summed first."""
    parts = manifest.groupBy("part").agg(F.sum("n_tokens").alias("_n"))
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_p"))
    inner = Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1)
    return (manifest.withColumn("_s", F.coalesce(F.sum("n_tokens").over(inner), F.lit(0))).join(parts, "part")
            .withColumn("first", F.col("_p") + F.col("_s")).drop("_p", "_s"))


def read_documents(manifest: DataFrame, id_type: str = "long") -> DataFrame:
    """Per document, from the shards: doc_id, start, n_tokens, ids_crc32, path, place (within the shard)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, first in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                shard = Shard(read_bytes(path))
                ids, n = shard.ids(), shard.documents["n_tokens"].to_numpy()
                place = np.concatenate([[0], np.cumsum(n)[:-1]])
                crc = [crc32_u32(ids[a:a + k]) for a, k in zip(place.tolist(), n.tolist())]
                yield pa.RecordBatch.from_arrays(
                    [shard.documents["doc_id"].combine_chunks(), pa.array(place + first), pa.array(n),
                     pa.array(crc, pa.int64()), pa.array([path] * len(n), pa.string()), pa.array(place)],
                    names=["doc_id", "start", "n_tokens", "ids_crc32", "path", "place"])

    ship_package(manifest.sparkSession)
    n = max(1, manifest.count())
    tasks = min(n, 4 * int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    return (shard_starts(manifest).select("path", "first").repartition(tasks)
            .mapInArrow(run, f"doc_id {id_type}, start long, n_tokens long, ids_crc32 long, path string, place long"))


def occurrences(manifest: DataFrame, token: int) -> DataFrame:
    """(path, place): every occurrence of one id, found without unpacking whole shards."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                at = Shard(read_bytes(path)).occurrences(token)
                yield pa.RecordBatch.from_arrays([pa.array([path] * len(at), pa.string()), pa.array(at, pa.int64())],
                                                 names=["path", "place"])

    ship_package(manifest.sparkSession)
    return manifest.select("path").mapInArrow(run, "path string, place long")


@register("op2_wavelet_shards")
def q_wavelet_shards(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    manifest = write_shards(docs, work_dir(spark, "wavelet"), tokenizer_path())
    return read_documents(manifest, docs.schema["doc_id"].dataType.simpleString())
