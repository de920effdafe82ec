"""MinHash near-duplicates with sequential Bayesian verification.

1. Every text becomes its set of word shingles, named by a 128-bit hash of the
   set (``fp``), with a MinHash signature. Texts of equal sets are one node.
2. Signatures are cut into bands; nodes that agree in a band share a bucket.
   All buckets with the same least member form a cell, so two nodes that share
   a bucket share a cell, and a node is in few cells.
3. Within a cell, signatures are compared in batches of hashes. After each,
   pairs whose posterior probability of reaching the threshold (uniform
   prior) is below ``miss`` are pruned. Nodes with a pair left go on.
4. What is left is confirmed on the full shingle sets. Pairs that are already
   connected within the task need no test, and only the links that join two
   parts are put out: at most one per node.
5. Cells of more than ``chunk`` nodes are split at random, and step 4 runs
   within the chunks. Then the nodes that are not yet in a cell's main
   component meet the other chunks of the cell, pair by pair of chunks.
6. Connected components of the links; the least document id names each.

Nothing is dropped or capped: every pair of a bucket is either connected,
pruned by its posterior, or confirmed or rejected on the full sets.

Defined results: null or empty texts have no shingles and are linked with
nothing; a text of fewer words than a shingle is one shingle. Repeated rows
share a node. A null id takes no part in naming a component. An empty table
gives an empty result. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.llm.common import let_go, register, save, ship_package, small, work_dir
from flowatlas.llm.graph import components
from flowatlas.llm.textops import SPACE, WordHasher, groups, shingle_sets

BANDS, ROWS = 32, 5          # a pair of similarity 0.8 shares no band with probability 3e-6
HASHES = BANDS * ROWS
BATCH = 32                   # hashes compared before each posterior test
MISS = 1e-7                  # probability of pruning a pair that reaches the threshold
CHUNK = 1000                 # nodes of a cell that one task compares with each other
NUMERATOR, DENOMINATOR = 80, 100
SHINGLE = 4

_rng = np.random.Generator(np.random.PCG64(20240607))
_A = _rng.integers(0, 1 << 31, HASHES, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_C = _rng.integers(0, 1 << 32, HASHES, dtype=np.uint32)


def least_matches(threshold: float, miss: float, hashes: int = HASHES, batch: int = BATCH) -> list[tuple[int, int]]:
    """(hashes compared, matches a pair needs by then). With a uniform prior,
    P(similarity >= t | m of n match) = P(Binomial(n + 1, t) <= m)."""
    out = []
    for n in range(batch, hashes + 1, batch):
        total, m = 0.0, 0
        while True:
            total += math.comb(n + 1, m) * threshold ** m * (1 - threshold) ** (n + 1 - m)
            if total >= miss:
                break
            m += 1
        out.append((n, m))
    return out


def signature(shingles: np.ndarray) -> np.ndarray:
    h = (shingles >> np.uint64(32)).astype(np.uint32)
    sig = np.full(HASHES, 0xFFFFFFFF, np.uint32)
    for at in range(0, len(h), 4096):
        np.minimum(sig, (_A[:, None] * h[None, at:at + 4096] + _C[:, None]).min(axis=1), out=sig)
    return sig


def _sets(batches: Iterator[pa.RecordBatch], k: int) -> Iterator[tuple[pa.RecordBatch, list[np.ndarray]]]:
    let_go()
    hasher = WordHasher(SPACE)
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            words, first = hasher(part.column(part.num_columns - 1).to_pylist())
            yield part, list(shingle_sets(words, first, k))


def _fingerprint(shingles: np.ndarray) -> bytes | None:
    return hashlib.blake2b(shingles.tobytes(), digest_size=16).digest() if len(shingles) else None


def signatures(docs: DataFrame, id_col: str, text_col: str, k: int) -> DataFrame:
    """(doc_id, _h, fp, n_shingles, sig) per row; fp and sig null without shingles."""
    kind = docs.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, k):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([_fingerprint(s) for s in sets], pa.binary()),
                 pa.array([len(s) for s in sets], pa.int64()),
                 pa.array([signature(s).tobytes() if len(s) else None for s in sets], pa.binary())],
                names=["doc_id", "_h", "fp", "n_shingles", "sig"])

    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(t).alias("_h"), t.cast("binary").alias("t")).mapInArrow(
        run, f"doc_id {kind}, _h long, fp binary, n_shingles long, sig binary")


def _name(fp):
    """64 bits of a fingerprint as a number."""
    return F.xxhash64(fp)


def cells_of(sigs: DataFrame, path: str) -> DataFrame:
    """(hub, node): the cells with two or more nodes; both are 64-bit names."""
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)),
                       lambda b: F.xxhash64(F.substring("sig", b * (4 * ROWS) + 1, F.lit(4 * ROWS)), b))
    rows = sigs.filter("sig is not null").select(_name(F.col("fp")).alias("node"), F.explode(keys).alias("key"))
    buckets = save(rows.groupBy("key").agg(F.min("node").alias("hub"), F.max("node").alias("_x"))
                   .filter("hub <> _x").select("key", "hub"), f"{path}/buckets")
    members = rows.join(small(buckets, buckets.count()), "key")
    return save(members.select("hub", "node").distinct(), f"{path}/cells")


def candidate_sets(docs: DataFrame, sigs: DataFrame, cells: DataFrame, path: str, id_col: str, text_col: str, k: int) -> DataFrame:
    """(fp, node, sig, shingles) of the nodes of cells: one document of each
    is read again for its full set."""
    key = F.coalesce(F.col("doc_id").cast("string"), F.lit("-"))
    nodes = cells.select("node").distinct()
    have = sigs.filter("fp is not null").select("fp", _name(F.col("fp")).alias("node"), key.alias("_k"), "_h")
    one = save(have.join(small(nodes, nodes.count()), "node", "left_semi")
               .groupBy("fp", "node").agg(F.min(F.struct("_k", "_h")).alias("_d"))
               .select("fp", "node", "_d._k", "_d._h"), f"{path}/nodes")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, sets in _sets(batches, k):
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array([signature(s).tobytes() for s in sets], pa.binary()),
                 pa.array([s.tobytes() for s in sets], pa.binary())], names=["fp", "node", "sig", "shingles"])

    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("-")).alias("_k"), F.xxhash64(t).alias("_h"),
                        t.cast("binary").alias("t"))
    found = texts.join(small(one, one.count()), ["_k", "_h"]).select("fp", "node", "t")
    return save(found.mapInArrow(run, "fp binary, node long, sig binary, shingles binary").dropDuplicates(["fp"]), f"{path}/sets")


# ------------------------------------------------------------ verification
class _Forest:
    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, i: int) -> int:
        while self.up[i] != i:
            self.up[i] = i = self.up[self.up[i]]
        return i


def _alive(sig: np.ndarray, i: int, among: np.ndarray, needs: list[tuple[int, int]]) -> np.ndarray:
    """Rows of ``among`` whose pair with row ``i`` no batch prunes."""
    done, matches = 0, np.zeros(len(among), np.int64)
    for n, m in needs:
        matches = matches + (sig[among, done:n] == sig[i, done:n]).sum(axis=1)
        keep = matches >= m
        among, matches, done = among[keep], matches[keep], n
        if not len(among):
            break
    return among


def _linked(a: np.ndarray, b: np.ndarray, num: int, den: int) -> bool:
    """den * |a & b| >= num * |a | b| for sorted sets."""
    if den * min(len(a), len(b)) < num * max(len(a), len(b)):
        return False
    if len(a) > len(b):
        a, b = b, a
    at = np.searchsorted(b, a)
    at[at == len(b)] = 0
    both = int((b[at] == a).sum())
    return den * both >= num * (len(a) + len(b) - both)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint32).reshape(-1, HASHES)


def _links(t: pa.Table, left: np.ndarray, right: np.ndarray, labels: list | None, needs, num: int, den: int):
    """Links between rows ``left`` and ``right`` that join two parts; rows of
    equal label are one part from the start."""
    sig, sets = _matrix(t["sig"]), [np.frombuffer(s, np.uint64) for s in t["shingles"].to_pylist()]
    forest = _Forest(t.num_rows)
    if labels is not None:
        seen: dict = {}
        for i, x in enumerate(labels):
            forest.up[i] = seen.setdefault(x, i)
    same = left is right
    for p, i in enumerate(left.tolist()):
        among = right[p + 1:] if same else right
        roots = np.fromiter((forest.root(j) for j in among.tolist()), np.int64, len(among))
        for j in _alive(sig, i, among[roots != forest.root(i)], needs).tolist():
            a, b = forest.root(i), forest.root(j)
            if a != b and _linked(sets[i], sets[j], num, den):
                forest.up[max(a, b)] = min(a, b)
                yield i, j


def _out(pairs: list[tuple[bytes, bytes]]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([p[0] for p in pairs], pa.binary()), pa.array([p[1] for p in pairs], pa.binary())],
                                      names=["a", "b"])


def verified_links(cells: DataFrame, sets: DataFrame, path: str, num: int, den: int, miss: float, chunk: int) -> DataFrame:
    """(a, b) fingerprints: links that connect whatever the candidate pairs connect."""
    needs = least_matches(num / den, miss)
    parts = cells.groupBy("hub").agg(F.ceil(F.count(F.lit(1)) / chunk).cast("int").alias("parts"))
    split = (cells.join(parts, "hub").join(sets.select("fp", "node", "sig"), "node")
             .select("hub", F.pmod(F.xxhash64("fp", "hub"), F.col("parts")).cast("int").alias("part"), "parts", "fp", "sig"))

    def prune(batches):
        for t in groups(batches, 2):
            keep = np.arange(t.num_rows)
            if t["parts"][0].as_py() == 1:
                sig, on = _matrix(t["sig"]), np.zeros(t.num_rows, bool)
                for i in range(t.num_rows - 1):
                    with_i = _alive(sig, i, np.arange(i + 1, t.num_rows), needs)
                    on[with_i] = True
                    on[i] |= len(with_i) > 0
                keep = np.flatnonzero(on)
            if len(keep):
                yield t.select(["hub", "part", "parts", "fp"]).take(pa.array(keep)).combine_chunks().to_batches()[0]

    alive = save(split.repartition("hub", "part").sortWithinPartitions("hub", "part")
                 .mapInArrow(prune, "hub long, part int, parts int, fp binary"), f"{path}/alive")

    def verify(batches):
        for t in groups(batches, 2):
            every, fp = np.arange(t.num_rows), t["fp"].to_pylist()
            found = [(fp[i], fp[j]) for i, j in _links(t, every, every, None, needs, num, den)]
            if found:
                yield _out(found)

    full = sets.select("fp", "sig", "shingles")
    within = alive.join(full, "fp").select("hub", "part", "fp", "sig", "shingles")
    links = save(within.repartition("hub", "part").sortWithinPartitions("hub", "part").mapInArrow(verify, "a binary, b binary"),
                 f"{path}/links")
    # cells of several chunks: what is outside a cell's main component meets the other chunks
    large = alive.filter("parts > 1")
    if large.isEmpty():
        return links
    comp = components(links, f"{path}/first")
    labelled = (large.join(comp, large["fp"] == comp["node"], "left")
                .select("hub", "part", "parts", "fp", F.coalesce("component", "fp").alias("label")))
    labelled = save(labelled, f"{path}/labelled")
    main = labelled.groupBy("hub", "label").agg(F.count(F.lit(1)).alias("n")).groupBy("hub").agg(
        F.max(F.struct("n", "label"))["label"].alias("main"), F.count(F.lit(1)).alias("labels"))
    rest = labelled.join(main.filter("labels > 1").drop("labels"), "hub").withColumn("out", F.col("label") != F.col("main"))
    asks = rest.filter("out").select("hub", F.col("part").alias("p"), "parts").distinct()
    # the rows of a pair of chunks (p asks, q answers): those outside of p, all of q
    here = F.filter(F.sequence(F.lit(0), F.col("parts") - 1), lambda q: q != F.col("part"))
    ask = rest.filter("out").select("hub", F.col("part").alias("p"), F.explode(here).alias("q"), F.lit(True).alias("asks"), "fp", "label")
    answer = rest.join(asks.select("hub", "p"), "hub").filter("p <> part").select(
        "hub", "p", F.col("part").alias("q"), F.lit(False).alias("asks"), "fp", "label")

    def across(batches):
        for t in groups(batches, 3):
            side = t["asks"].to_numpy()
            fp = t["fp"].to_pylist()
            found = [(fp[i], fp[j]) for i, j in _links(t, np.flatnonzero(side), np.flatnonzero(~side), t["label"].to_pylist(),
                                                       needs, num, den)]
            if found:
                yield _out(found)

    pairs = ask.union(answer).join(full, "fp").select("hub", "p", "q", "asks", "fp", "label", "sig", "shingles")
    more = save(pairs.repartition("hub", "p", "q").sortWithinPartitions("hub", "p", "q").mapInArrow(across, "a binary, b binary"),
                f"{path}/more")
    return links.union(more)


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, num: int = NUMERATOR,
                    den: int = DENOMINATOR, miss: float = MISS, chunk: int = CHUNK) -> DataFrame:
    """One row per row of ``docs``: doc_id, _h (text hash), n_shingles,
    component_id (least id reachable), component (its own name, null without
    shingles), kept (doc_id = component_id)."""
    ship_package(docs.sparkSession)
    path = work_dir(docs.sparkSession, "neardup")
    sigs = save(signatures(docs, id_col, text_col, shingle), f"{path}/signatures")
    cells = cells_of(sigs, path)
    sets = candidate_sets(docs, sigs, cells, path, id_col, text_col, shingle)
    links = verified_links(cells, sets, path, num, den, miss, chunk)
    comp = components(links, f"{path}/all")
    nodes = sigs.filter("fp is not null").groupBy("fp").agg(F.min("doc_id").alias("least"))
    named = nodes.join(comp, nodes["fp"] == comp["node"], "left").select(
        "fp", "least", F.coalesce("component", "fp").alias("component"))
    named = save(named, f"{path}/named")
    names = named.groupBy("component").agg(F.min("least").alias("component_id"))
    by_fp = named.join(names, "component").select("fp", "component_id", "component")
    # rows without shingles match nothing: their join key is null
    out = sigs.filter("fp is not null").select("doc_id", "_h", "n_shingles", "fp").join(by_fp, "fp").select(
        "doc_id", "_h", "n_shingles", "component_id", "component")
    none = sigs.filter("fp is null").select("doc_id", "_h", "n_shingles", F.col("doc_id").alias("component_id"),
                                            F.lit(None).cast("binary").alias("component"))
    return out.union(none).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


ORACLE = r"""
WITH RECURSIVE
w AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
s AS (SELECT DISTINCT doc_id, g FROM (SELECT doc_id, unnest(
        CASE WHEN len(w) >= 4 THEN list_transform(range(1, len(w) - 2), lambda i: array_to_string(w[i:i + 3], ' '))
             WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS g FROM w)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS i FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL),
e AS (SELECT a, b FROM p JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * i >= 80 * (na.n + nb.n - i)),
u AS (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r(doc_id, c) AS (SELECT doc_id, doc_id FROM documents UNION SELECT r.doc_id, u.b FROM r JOIN u ON u.a = r.c)
SELECT r.doc_id, coalesce(max(n.n), 0) AS n_shingles, min(c) AS component_id, r.doc_id = min(c) AS kept
FROM r LEFT JOIN n USING (doc_id) GROUP BY r.doc_id
"""


@register("op6_near_duplicates", ORACLE)
def q_near_duplicates(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    return near_duplicates(docs, shingle=SHINGLE).select("doc_id", "n_shingles", "component_id", "kept")
