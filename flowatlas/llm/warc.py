"""WARC archives: written by tasks, read back in splits, record chains verified.

Writing. Each task writes its pages as WARC 1.0 records into files of a bounded
size. Of the records with equal payloads of at least ``MIN_REVISIT`` bytes,
the one of the smallest id is a ``response``; the others are ``revisit``
records that name it and carry no payload.

Reading. Files are cut into splits. A task scans its split for the magic of a
record, wherever it stands - also inside payloads - and emits, for every
header that parses, the candidate (offset, offset of its successor). Within a
split each candidate is followed to the first offset beyond the split; these
jumps are then doubled (pointer jumping) from the start of each file until no
new offset is reached: log2 of the splits per file rounds. The offsets that
are reached enter a split, and the chain from there marks its true records. A
record's head therefore counts only if the chain of lengths from the file's
start leads to it; magic inside a payload is never reached. A head may be of
any length (a URL is written whole): a task reads on beyond its split until the
last head has ended. The chain must end at the file's length and hold as many
records as the manifest says, else the file is broken: ``strict`` reading
raises, otherwise the records up to the break are returned.

Defined results: a null payload is empty. Null ids are written as such and
never stand for others while an id is there. Rows that repeat an id are
records of their own; equal rows with one id count as one page, the first
record being the response. An empty table has no files. Other columns are not
read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.llm.common import register, save, ship_package, small, work_dir
from flowatlas.llm.files import open_fs, read_range, unique, write_bytes

MIN_REVISIT = 100
FILE_BYTES = 32 << 20     # a file is closed once it holds so much
SPLIT_BYTES = 8 << 20     # a reading task's share of a file
AHEAD = 1 << 16           # read beyond a split at first; more if a header block is longer
MAGIC = b"WARC/1.0\r\n"
_DATE = "2024-01-01T00:00:00Z"
_LENGTH = re.compile(rb"\r\nContent-Length:[ \t]*([0-9]{1,18})[ \t]*(?=\r\n)", re.I)


# ----------------------------------------------------------------- writing
def _record(kind: str, fields: list[tuple[str, str]], body: bytes) -> bytes:
    head = [("WARC-Type", kind), ("WARC-Date", _DATE), *fields, ("Content-Length", str(len(body)))]
    text = "".join(f"{k}: {v}\r\n" for k, v in head)
    return MAGIC + text.encode() + b"\r\n" + body + b"\r\n\r\n"


def _clean(value: str | None) -> str:
    """A header value on one line; a URL keeps its characters otherwise."""
    return re.sub(r"[\x00-\x20\x7f]", lambda m: f"%{ord(m[0]):02X}", value or "")


def digests(pages: DataFrame, id_col: str, payload: str, path: str, least: int = MIN_REVISIT) -> DataFrame:
    """(digest, original): digests that several rows share, with the smallest id."""
    p = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    d = pages.select(F.col(id_col).alias("id"), F.sha2(p, 256).alias("digest"), F.octet_length(p).alias("n"))
    return save(d.filter(F.col("n") >= least).groupBy("digest").agg(F.min("id").alias("original"), F.count(F.lit(1)).alias("n"))
                .filter("n > 1").select("digest", "original"), path)


def write_archives(pages: DataFrame, folder: str, id_col: str = "page_id", payload: str = "html", url: str = "url",
                   least: int = MIN_REVISIT, file_bytes: int = FILE_BYTES) -> DataFrame:
    """Writes the archives; returns the manifest (path, n_bytes, n_records), a table in ``folder``."""
    spark = pages.sparkSession
    ship_package(spark)
    shared = digests(pages, id_col, payload, f"{folder}/digests", least)
    p = F.coalesce(F.col(payload).cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col(id_col).cast("string").alias("id"), F.col(url).cast("string").alias("url"), p.alias("body"),
                        F.sha2(p, 256).alias("digest"))
    rows = rows.join(small(shared.withColumn("original", F.col("original").cast("string")), shared.count()), "digest", "left")
    rows = rows.select("id", "url", "body", "digest", "original")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, seq, held, size = TaskContext.get().partitionId(), 0, [], 0

        def flush() -> pa.RecordBatch:
            nonlocal seq, held, size
            path = unique(folder + "/archives", f"part-{part:06d}-{seq:05d}", ".warc")
            write_bytes(path, b"".join(held))
            out = pa.RecordBatch.from_pydict({"path": [path], "n_bytes": pa.array([size], pa.int64()),
                                              "n_records": pa.array([len(held)], pa.int64())})
            seq, held, size = seq + 1, [], 0
            return out

        for batch in batches:
            for i, link, body, digest, original in zip(*(batch.column(c).to_pylist() for c in range(5))):
                record_id = f"<urn:page:{_clean(i)}>" if i is not None else "<urn:page>"
                fields = [("WARC-Record-ID", record_id), ("WARC-Target-URI", _clean(link)),
                          ("WARC-Payload-Digest", "sha256:" + digest), ("X-Payload-Length", str(len(body)))]
                if original is not None and original != i:
                    fields += [("WARC-Refers-To", f"<urn:page:{_clean(original)}>"),
                               ("WARC-Profile", "http://netpreserve.org/warc/1.0/revisit/identical-payload-digest")]
                    held.append(_record("revisit", fields, b""))
                else:
                    held.append(_record("response", [*fields, ("Content-Type", "text/html; charset=utf-8")], body))
                size += len(held[-1])
                if size >= file_bytes:
                    yield flush()
        if held:
            yield flush()

    return save(rows.mapInArrow(run, "path string, n_bytes long, n_records long"), f"{folder}/manifest")


# ----------------------------------------------------------------- reading
def read_split(path: str, start: int, end: int, size: int) -> bytes:
    """Bytes from ``start`` to ``end`` and as far on as the last head in there goes."""
    data, ahead = read_range(path, start, end - start + AHEAD), AHEAD
    last = data.rfind(MAGIC, 0, end - start + len(MAGIC) - 1)
    while last >= 0 and start + len(data) < size and data.find(b"\r\n\r\n", last) < 0:
        more = read_range(path, start + len(data), ahead)
        if not more:
            break
        data, ahead = data + more, 2 * ahead
    return data


def candidates_in(data: bytes, start: int, end: int) -> list[tuple[int, int]]:
    """(offset, successor) of every parsable head at an offset in [start, end);
    ``data`` begins at ``start`` and reaches far enough beyond ``end``."""
    out, at, stop, lengths = [], data.find(MAGIC), -1, []
    while 0 <= at < end - start:
        if stop < at:  # heads up to the same blank line share its lengths
            stop = data.find(b"\r\n\r\n", at)
            if stop < 0:
                break
            lengths = list(_LENGTH.finditer(data, at, stop + 2))
        # exactly one length from here on
        if lengths and lengths[-1].start() >= at and (len(lengths) == 1 or lengths[-2].start() < at):
            out.append((start + at, start + stop + 4 + int(lengths[-1][1]) + 4))
        at = data.find(MAGIC, at + 1)
    return out


def exits(pairs: list[tuple[int, int]], end: int) -> list[tuple[int, int]]:
    """Where the chain from each candidate first leaves the split (offset >= end),
    or the offset at which it breaks off, and its records up to there.
    Successors lie behind, so one pass from the last candidate suffices."""
    leave: dict[int, tuple[int, int]] = {}
    for at, nxt in reversed(pairs):
        to, n = leave.get(nxt, (nxt, 0)) if nxt < end else (nxt, 0)
        leave[at] = to, n + 1
    return [leave[at] for at, _ in pairs]


def splits(manifest: DataFrame, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """(path, n_bytes, start): the shares that files are read in."""
    last = F.greatest(F.ceil(F.col("n_bytes") / split_bytes).cast("long") - 1, F.lit(0))
    return manifest.select("path", "n_bytes", F.explode(F.sequence(F.lit(0).cast("long"), last)).alias("k")).select(
        "path", "n_bytes", (F.col("k") * split_bytes).alias("start"))


def reachable(found: DataFrame, folder: str, split_bytes: int) -> DataFrame:
    """(path, start, entry): the offsets by which the chains of their files
    enter the splits. ``found``: (path, start, at, exit)."""
    split_of = lambda c: (F.floor(c / split_bytes) * split_bytes).cast("long")
    jump = save(found.select("path", "at", F.col("exit").alias("to")), f"{folder}/jump0")
    seen = save(found.select("path", F.lit(0).cast("long").alias("at")).distinct(), f"{folder}/seen0")
    n, k = seen.count(), 0
    while True:  # offsets within 2^k entries of a file's start are seen; jumps are 2^k entries long
        k += 1
        new = seen.join(jump, ["path", "at"]).select("path", F.col("to").alias("at"))
        seen = save(seen.union(new).distinct(), f"{folder}/seen{k}")
        m = seen.count()
        if m == n:
            break
        n = m
        far = jump.select("path", F.col("at").alias("to"), F.col("to").alias("_far"))
        jump = save(jump.join(far, ["path", "to"]).select("path", "at", F.col("_far").alias("to")), f"{folder}/jump{k}")
    return seen.select("path", split_of(F.col("at")).alias("start"), F.col("at").alias("entry"))


def read_archives(manifest: DataFrame, folder: str, split_bytes: int = SPLIT_BYTES, payloads: bool = False,
                  strict: bool = False) -> DataFrame:
    """The records of all archives, verified: path, offset, type, id, url,
    payload_bytes, payload_digest (both of the full payload, taken from the
    record itself where it has one), refers_to, and payload if asked for.
    ``strict``: raises if a file is broken."""
    ship_package(manifest.sparkSession)
    shares = splits(manifest, split_bytes)
    tasks = max(1, min(shares.count(), 4 * int(manifest.sparkSession.conf.get("spark.sql.shuffle.partitions"))))

    def load(path: str, size: int, start: int) -> tuple[bytes, int]:
        end = min(start + split_bytes, size)
        return read_split(path, start, end, size), end

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start in zip(*(batch.column(c).to_pylist() for c in range(3))):
                data, end = load(path, size, start)
                pairs = candidates_in(data, start, end)
                left = exits(pairs, end)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([path] * len(pairs), pa.string()), pa.array([start] * len(pairs), pa.int64()),
                     pa.array([a for a, _ in pairs], pa.int64()), pa.array([b for _, b in pairs], pa.int64()),
                     pa.array([to for to, _ in left], pa.int64()), pa.array([n for _, n in left], pa.int64())],
                    names=["path", "start", "at", "next", "exit", "hops"])

    found = save(shares.repartition(tasks).mapInArrow(scan, "path string, start long, at long, next long, exit long, hops long"),
                 f"{folder}/candidates")
    entries = reachable(found, f"{folder}/chains", split_bytes)
    if strict:
        broken = broken_files(manifest, entries, found).limit(5).collect()
        if broken:
            raise ValueError(f"broken archives: {[r.asDict() for r in broken]}")
    chosen = entries.join(manifest, "path").filter(F.col("entry") < F.col("n_bytes")).select("path", "n_bytes", "start", "entry")

    def records(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, size, start, entry in zip(*(batch.column(c).to_pylist() for c in range(4))):
                data, end = load(path, size, start)
                follow, at, rows = dict(candidates_in(data, start, end)), entry, []
                fs, name = open_fs(path)
                with fs.open_input_file(name) as src:
                    while at < end and at in follow:
                        nxt = follow[at]
                        if nxt > size:  # cut off: not a whole record
                            break
                        stop = data.find(b"\r\n\r\n", at - start) + start + 4
                        body_end = nxt - 4
                        inside = body_end - start <= len(data)
                        body = data[stop - start:body_end - start] if inside else src.read_at(body_end - stop, stop)
                        rows.append((path, at, *_parse(data[at - start:stop - start], body), body if payloads else None))
                        at = nxt
                names = ["path", "offset", "type", "id", "url", "payload_bytes", "payload_digest", "refers_to", "payload"]
                kinds = [pa.string(), pa.int64(), *[pa.string()] * 3, pa.int64(), pa.string(), pa.string(), pa.binary()]
                yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], k) for i, k in enumerate(kinds)], names=names)

    return chosen.repartition(tasks).mapInArrow(
        records, "path string, offset long, type string, id string, url string, payload_bytes long, "
                 "payload_digest string, refers_to string, payload binary")


def broken_files(manifest: DataFrame, entries: DataFrame, found: DataFrame) -> DataFrame:
    """Paths whose chain does not end at the file's length, or has not the
    manifest's number of records."""
    hops = found.select("path", F.col("at").alias("entry"), "hops")
    ends = entries.join(hops, ["path", "entry"], "left").groupBy("path").agg(
        F.max("entry").alias("end"), F.coalesce(F.sum("hops"), F.lit(0)).alias("n_read"))
    whole = F.col("end").eqNullSafe(F.col("n_bytes")) & F.col("n_read").eqNullSafe(F.col("n_records"))
    return manifest.join(ends, "path", "left").filter(~whole).select("path", "n_bytes", "end", "n_records", "n_read")


def _parse(head: bytes, body: bytes) -> tuple:
    fields = {}
    for line in head.decode("utf-8", "replace").split("\r\n")[1:]:
        k, _, v = line.partition(":")
        fields.setdefault(k.strip().lower(), v.strip())
    page = lambda v: v[len("<urn:page:"):-1] if v and v.startswith("<urn:page:") else None
    kind = fields.get("warc-type")
    if kind == "revisit":
        size, digest = int(fields.get("x-payload-length", 0)), fields.get("warc-payload-digest", "").removeprefix("sha256:")
    else:
        size, digest = len(body), hashlib.sha256(body).hexdigest()
    return kind, page(fields.get("warc-record-id")), fields.get("warc-target-uri"), size, digest, page(fields.get("warc-refers-to"))


ORACLE = f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
d AS (SELECT page_id, strlen(h) AS n, sha256(h) AS x FROM p),
o AS (SELECT x, min(page_id) AS first FROM d WHERE n >= {MIN_REVISIT} GROUP BY x)
SELECT page_id, CAST(n AS bigint) AS payload_bytes, x AS payload_digest,
       CASE WHEN first IS NULL OR first = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN first <> page_id THEN first END AS refers_to
FROM d LEFT JOIN o USING (x)
"""


@register("op1_warc", ORACLE)
def q_warc(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url", "html")
    folder = work_dir(spark, "warc")
    records = read_archives(write_archives(pages, folder), folder, strict=True)
    return records.select(F.col("id").cast("long").alias("page_id"), "payload_bytes", "payload_digest",
                          F.col("type").alias("record_type"), F.col("refers_to").cast("long").alias("refers_to"))
