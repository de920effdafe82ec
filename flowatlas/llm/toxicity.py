"""Toxicity by maximum-scoring segments of token log-odds.

Learning. Labelled texts (equal ones once) give, per word, the number of toxic
and clean texts that hold it. A word's log-odds have a Dirichlet prior from
its first six bytes, theirs from its first four, theirs from the overall
share. What a word scores is its log-odds, shrunk to the confidence bound on
the side of zero: the lower bound if that is positive, the upper bound if that
is below ``-DRIFT``, else ``-DRIFT``; words of few texts score as their
beginning does. Only words and beginnings that score otherwise than their
beginning make the lexicon.

Search. The maximal scoring segments of a text (Ruzzo and Tompa) are found in
one pass over its scoring words, in linear time.

Calibration. The texts of each half of the labels are scored with the lexicon
of the other half. The clean ones give the Karlin-Altschul parameters: lambda
from the distribution of word scores, K from the mean best segment. A
segment's E-value is ``K * words * exp(-lambda * score)``; a text's evidence
is the sum of -ln E over its segments with E < 1. A logistic curve from
evidence to probability is fitted on counts per evidence bin and label.

Sizes: counts are grouped by Spark; the lexicon is broadcast after its rows
are counted (it holds significant words only, so it grows with the
vocabulary, not with the corpus). Beyond ``LEXICON_ROWS`` it stays a table and
words meet it in a shuffle join, one row per distinct word of 256 texts, so a
word of a third of all texts is 256 times rarer there, and AQE divides what is
still skewed; scores are the same. The curve is fitted on at most a few hundred
counts.

Defined results: null or empty text has no words and the evidence of none.
Labels that are null or contradict each other evenly are not learned from;
repeated labels count once. Without toxic or without clean labels the score is
the toxic share (0 without labels). Repeated rows are each scored; labels,
language, source and id never enter a score. Other columns are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.llm.common import let_go, register, save, ship_package, small, work_dir
from flowatlas.llm.textops import NON_ALNUM, WordHasher

PREFIXES = (6, 4)       # bytes of a word that its prior is taken from, in turn
PRIOR = 10.0            # pseudo-texts of each prior
BOUND = 3.0             # standard deviations that a score is below the log-odds
CLEAN_BOUND = 3.0       # standard deviations that a clean word's score is above its log-odds
DRIFT = 0.1             # what any other word costs
MIN_TEXTS = 5           # texts that a word or beginning needs to speak for itself
E_VALUE = 0.05          # a passage is significant up to this E-value
THRESHOLD = 0.7
LEXICON_ROWS = 5_000_000  # rows that are broadcast; larger lexicons are joined
TEXTS = 256             # texts that are hashed together
_EULER = 0.5772156649015329


def held_out(id_col: str) -> Column:
    return F.coalesce(F.crc32(F.col(id_col).cast("string").cast("binary")) % 3 == 1, F.lit(False))


# --------------------------------------------------------------- learning
def training_texts(docs: DataFrame, labels: DataFrame, path: str) -> DataFrame:
    """(doc_id, fold, toxic): one labelled row of each distinct text; two folds."""
    y = (labels.filter(F.col("toxic").isNotNull() & F.col("doc_id").isNotNull() & ~held_out("doc_id"))
         .groupBy("doc_id").agg(F.avg("toxic").alias("_y")).filter("_y <> 0.5")
         .select("doc_id", (F.col("_y") > 0.5).cast("int").alias("toxic")))
    y = save(y, f"{path}/labels")
    t = docs.select("doc_id", F.xxhash64(F.coalesce(F.col("text"), F.lit(""))).alias("_h"))
    one = (t.join(small(y, y.count()), "doc_id").groupBy("_h").agg(F.min(F.struct("doc_id", "toxic")).alias("_d"))
           .select("_d.doc_id", "_d.toxic", F.pmod("_h", F.lit(2)).cast("int").alias("fold"))).groupBy("doc_id").agg(
               F.min("toxic").alias("toxic"), F.min("fold").alias("fold"))
    return save(one, f"{path}/training")


def word_counts(texts: DataFrame) -> DataFrame:
    """(word, p6, p4, fold, toxic, n): texts of each kind that hold each word, added up per batch."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hasher = WordHasher(NON_ALNUM, prefixes=PREFIXES)
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                levels, first = hasher.levels(part.column(2).to_pylist())
                kind = np.repeat(part.column(0).to_numpy() * 2 + part.column(1).to_numpy(), np.diff(first))
                doc = np.repeat(np.arange(part.num_rows), np.diff(first))
                order = np.lexsort((doc, levels[0]))
                w, d, k = levels[0][order], doc[order], kind[order]
                once = np.ones(len(w), bool)
                once[1:] = (w[1:] != w[:-1]) | (d[1:] != d[:-1])
                order, w, k = order[once], w[once], k[once]
                by = np.lexsort((k, w))
                w, k, order = w[by], k[by], order[by]
                start = np.flatnonzero(np.concatenate([np.ones(min(1, len(w)), bool), (w[1:] != w[:-1]) | (k[1:] != k[:-1])]))
                n = np.diff(np.append(start, len(w)))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.array(x[order[start]].view(np.int64)) for x in levels], pa.array((k[start] // 2).astype(np.int32)),
                     pa.array((k[start] % 2).astype(np.int32)), pa.array(n.astype(np.int64))],
                    names=["word", "p6", "p4", "fold", "toxic", "n"])

    return texts.select("fold", "toxic", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("t")).mapInArrow(
        run, "word long, p6 long, p4 long, fold int, toxic int, n long")


@dataclass
class Lexicon:
    """Sorted hashes and scores of each level (whole words, then beginnings)."""
    keys: list[np.ndarray]
    scores: list[np.ndarray]

    def __post_init__(self):
        self.maps = []
        for k in self.keys:
            seen = np.zeros(1 << 20, bool)
            seen[k & np.uint64((1 << 20) - 1)] = True
            self.maps.append(seen)

    def score(self, levels: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Places of scoring words and what they score: the longest level that is known decides."""
        found = np.zeros(len(levels[0]), bool)
        places, values = [], []
        for key, score, seen, h in zip(self.keys, self.scores, self.maps, levels):
            maybe = np.flatnonzero(seen[h & np.uint64((1 << 20) - 1)] & ~found)
            if not len(maybe) or not len(key):
                continue
            at = np.searchsorted(key, h[maybe])
            at[at == len(key)] = 0
            hit = key[at] == h[maybe]
            places.append(maybe[hit])
            values.append(score[at[hit]])
            found[maybe[hit]] = True
        if not places:
            return np.zeros(0, np.int64), np.zeros(0)
        place, value = np.concatenate(places), np.concatenate(values)
        place, value = place[value != 0], value[value != 0]
        order = np.argsort(place)
        return place[order], value[order]


@dataclass
class LexiconTable:
    """A lexicon too large to broadcast: (level, k, s), one row per hash of a level."""
    rows: DataFrame


def lexicon(counts: DataFrame, folds: tuple[int, ...], limit: int | None = None) -> Lexicon | LexiconTable:
    """Scores learned from the given folds of ``counts`` (word, p6, p4, c00, c01, c10, c11);
    a table beyond ``limit`` rows (``LEXICON_ROWS``)."""
    c0, c1 = (sum((F.col(f"c{f}{y}") for f in folds[1:]), F.col(f"c{folds[0]}{y}")) for y in (0, 1))
    base = counts.select("word", "p6", "p4", c0.alias("c0"), c1.alias("c1")).filter("c0 + c1 > 0")
    share = base.agg(F.sum("c0"), F.sum("c1")).first()
    if not share[0] or not share[1]:
        return Lexicon([np.zeros(0, np.uint64)] * 3, [np.zeros(0)] * 3)
    root = share[1] / (share[0] + share[1])

    def level(df: DataFrame, q: str, parent: Column) -> DataFrame:
        a, b = F.col("c1") + PRIOR * parent, F.col("c0") + PRIOR * (1 - parent)
        # half a text on either side keeps the bound finite where the prior leaves none
        odds = F.log((a + 0.5) / (b + 0.5)) - math.log(root / (1 - root))
        error = F.sqrt(1 / (a + 0.5) + 1 / (b + 0.5))
        low, high = odds - BOUND * error, odds + CLEAN_BOUND * error
        return df.withColumn(q, a / (a + b)).withColumn("s", F.when(low > 0, low).when(high < -DRIFT, high).otherwise(0.0))

    l4 = level(base.groupBy("p4").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")), "q4", F.lit(root))
    known = F.col("c0") + F.col("c1") >= MIN_TEXTS
    l4 = l4.withColumn("s4", F.when(known, F.col("s")).otherwise(0.0))
    l6 = level(base.groupBy("p6", "p4").agg(F.sum("c0").alias("c0"), F.sum("c1").alias("c1")).join(
        l4.select("p4", "q4", "s4"), "p4"), "q6", F.col("q4"))
    l6 = l6.withColumn("s6", F.when(known, F.col("s")).otherwise(F.col("s4")))
    lw = level(base.join(l6.select("p6", "p4", "q6", "s6"), ["p6", "p4"]), "q", F.col("q6"))
    lw = lw.withColumn("s", F.when(known, F.col("s")).otherwise(F.col("s6")))
    rows = (lw.filter("s <> s6").select(F.lit(0).alias("level"), F.col("word").alias("k"), "s")
            .union(l6.filter("s6 <> s4").select(F.lit(1), "p6", "s6"))
            .union(l4.filter("s4 <> 0").select(F.lit(2), "p4", "s4")))
    rows = save(rows, work_dir(counts.sparkSession, "lexicon"))
    if rows.count() > (LEXICON_ROWS if limit is None else limit):
        return LexiconTable(rows)
    t = rows.toArrow()
    lv, k, s = t["level"].to_numpy(), t["k"].to_numpy().view(np.uint64), t["s"].to_numpy()
    keys, scores = [], []
    for i in range(3):
        order = np.argsort(k[lv == i])
        keys.append(k[lv == i][order])
        scores.append(s[lv == i][order])
    return Lexicon(keys, scores)


# ------------------------------------------------------------------ search
def segments(place: np.ndarray, value: np.ndarray, drift: float = DRIFT) -> list[tuple[int, int, float]]:
    """All maximal scoring segments (first word, end, score) of a text whose
    word at ``place[i]`` scores ``value[i]`` and all others ``-drift``.

    Every candidate keeps a link to the nearest earlier one with a smaller sum
    before it; the search for that one follows links only, and a candidate that
    was passed over is never looked at again, so the time is linear."""
    out: list[list] = []  # first, end, sum before, sum after, link
    gained = 0.0
    for n, (p, v) in enumerate(zip(place.tolist(), value.tolist())):
        before = gained - drift * (p - n)
        gained += v
        if v <= 0:
            continue
        j = len(out) - 1
        while j >= 0 and out[j][2] >= before:
            j = out[j][4]
        first, after = p, before + v
        while j >= 0 and out[j][3] < after:  # joined with all since j, whose link holds for the whole
            first, before, j, keep = out[j][0], out[j][2], out[j][4], j
            del out[keep:]
        out.append([first, p + 1, before, after, j])
    return [(a, b, r - le) for a, b, le, r, _ in out]


@dataclass
class Calibration:
    lam: float
    k: float
    slope: float
    intercept: float
    share: float

    def evidence(self, scores: list[float], words: int) -> float:
        """Sum of -ln E over the segments with E < 1."""
        return sum(max(0.0, self.lam * s - math.log(self.k * max(words, 1))) for s in scores)

    def probability(self, evidence: float) -> float:
        if not self.slope:
            return self.share
        z = self.slope * evidence + self.intercept
        return 1 / (1 + math.exp(-z)) if z > -700 else 0.0


def _scored(batches: Iterator[pa.RecordBatch], lex, text: int) -> Iterator[tuple[pa.RecordBatch, int, int, list]]:
    let_go()
    hasher = WordHasher(NON_ALNUM, prefixes=PREFIXES)
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            part = batch.slice(at, TEXTS)
            levels, first = hasher.levels(part.column(text).to_pylist())
            use = lex(part)
            place, value = use.score(levels)
            ends = np.searchsorted(place, first)
            yield part, [(int(b - a), segments(place[i:j] - a, value[i:j]))
                         for a, b, i, j in zip(first[:-1], first[1:], ends[:-1], ends[1:])]


def joined_hits(texts: DataFrame, lex: LexiconTable) -> DataFrame:
    """The columns of ``texts`` but the last, its binary text, of which come
    ``_n`` (words), ``_place`` and ``_value`` (of its scoring words): what
    ``Lexicon.score`` finds, by a join.

    One written table holds a row per text and a row per distinct word of each
    ``TEXTS`` texts, so both sides of the later joins agree on the texts' numbers
    whatever is computed again. A text's hits meet in one row, as its words did."""
    spark = texts.sparkSession
    carry, text = texts.columns[:-1], len(texts.columns) - 1
    path = work_dir(spark, "words")
    like = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in texts.schema.fields[:-1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        hasher, done = WordHasher(NON_ALNUM, prefixes=PREFIXES), TaskContext.get().partitionId() << 40
        longs = pa.list_(pa.int64())
        for batch in batches:
            for at in range(0, batch.num_rows, TEXTS):
                part = batch.slice(at, TEXTS)
                levels, first = hasher.levels(part.column(text).to_pylist())
                ids = done + np.arange(part.num_rows)
                done += part.num_rows
                size = np.diff(first)
                none = pa.nulls(part.num_rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:-1], pa.array(ids), pa.array(size.astype(np.int64)), none, none, none,
                     pa.nulls(part.num_rows, longs), pa.nulls(part.num_rows, longs)], names=names)
                doc = np.repeat(np.arange(part.num_rows), size)
                place = np.arange(len(doc)) - np.repeat(first[:-1], size)
                order = np.argsort(levels[0], kind="stable")
                w = levels[0][order]
                start = np.flatnonzero(np.concatenate([np.ones(min(1, len(w)), bool), w[1:] != w[:-1]]))
                bounds = pa.array(np.append(start, len(w)).astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [*[pa.nulls(len(start), c.type) for c in part.columns[:-1]], pa.nulls(len(start), pa.int64()),
                     pa.nulls(len(start), pa.int64()), *[pa.array(x[order[start]].view(np.int64)) for x in levels],
                     pa.ListArray.from_arrays(bounds, pa.array(ids[doc[order]])),
                     pa.ListArray.from_arrays(bounds, pa.array(place[order].astype(np.int64)))], names=names)

    names = [*carry, "_text", "_n", "_w0", "_w1", "_w2", "_texts", "_places"]
    both = save(texts.mapInArrow(run, f"{like}, _text long, _n long, _w0 long, _w1 long, _w2 long, "
                                      "_texts array<long>, _places array<long>"), path + "/all")
    words = both.filter("_texts is not null").select("_w0", "_w1", "_w2", "_texts", "_places")
    for i in range(len(PREFIXES) + 1):
        level = lex.rows.filter(F.col("level") == i).select(F.col("k").alias(f"_w{i}"), F.col("s").alias(f"_s{i}"))
        words = words.join(level, f"_w{i}", "left")
    value = F.coalesce(*[F.col(f"_s{i}") for i in range(len(PREFIXES) + 1)])
    hits = (words.select("_texts", "_places", value.alias("_v")).filter("_v <> 0")
            .select("_v", F.explode(F.arrays_zip("_texts", "_places")).alias("_e"))
            .groupBy(F.col("_e._texts").alias("_text"))
            .agg(F.array_sort(F.collect_list(F.struct(F.col("_e._places").alias("p"), F.col("_v").alias("v")))).alias("_hits")))
    return (both.filter("_texts is null").join(hits, "_text", "left")
            .select(*carry, "_n", F.coalesce(F.col("_hits.p"), F.array().cast("array<long>")).alias("_place"),
                    F.coalesce(F.col("_hits.v"), F.array().cast("array<double>")).alias("_value")))


def _scored_hits(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, list]]:
    """As ``_scored``, of rows from ``joined_hits``."""
    for part in batches:
        n, place, value = (part.column(i) for i in range(part.num_columns - 3, part.num_columns))
        yield part, [(n[i].as_py(), segments(place[i].values.to_numpy(), value[i].values.to_numpy()))
                     for i in range(part.num_rows)]


def fit(docs: DataFrame, labels: DataFrame) -> tuple[Lexicon | LexiconTable, Calibration]:
    spark = docs.sparkSession
    ship_package(docs.sparkSession)
    path = work_dir(spark, "toxicity")
    train = training_texts(docs, labels, path)
    rows = train.count()
    texts = docs.join(small(train, rows), "doc_id").select("fold", "toxic", "text")
    counts = save(word_counts(texts).groupBy("word", "p6", "p4").agg(
        *[F.sum(F.when((F.col("fold") == f) & (F.col("toxic") == y), F.col("n")).otherwise(0)).alias(f"c{f}{y}")
          for f in (0, 1) for y in (0, 1)]), f"{path}/counts")
    final = lexicon(counts, (0, 1))
    shares = {r["toxic"]: r["n"] for r in train.groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    share = shares.get(1, 0) / max(1, sum(shares.values()))
    if len(shares) < 2:
        return final, Calibration(1.0, 1.0, 0.0, 0.0, share)
    other = [lexicon(counts, (1 - f,)) for f in (0, 1)]
    binary = texts.select("fold", "toxic", F.coalesce(F.col("text").cast("binary"), F.lit(b"")).alias("t"))
    joined = any(isinstance(x, LexiconTable) for x in other)
    if joined:
        binary = reduce(DataFrame.unionByName, [joined_hits(binary.filter(F.col("fold") == f), _table(spark, x))
                                                for f, x in enumerate(other)])
    by_fold = None if joined else spark.sparkContext.broadcast(other)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, found in (_scored_hits(batches) if by_fold is None else
                            _scored(_halves(batches), lambda p: by_fold.value[p.column(0)[0].as_py()], 2)):
            yield pa.RecordBatch.from_arrays(
                [part.column(1), pa.array([n for n, _ in found], pa.int64()),
                 pa.array([[s for _, _, s in seg] for _, seg in found], pa.list_(pa.float64()))],
                names=["toxic", "words", "scores"])

    held = save(binary.mapInArrow(run, "toxic int, words long, scores array<double>"), f"{path}/held")
    # lambda: sum over clean words of p * exp(lambda * score) = 1, segments standing for their scoring words
    clean = held.filter("toxic = 0")
    words = clean.agg(F.sum("words")).first()[0] or 1
    hist = clean.select(F.explode("scores").alias("s")).groupBy(F.ceil(F.col("s") * 10).alias("b")).agg(
        F.count(F.lit(1)).alias("n")).collect()  # at most ten bins per unit of score
    s = np.array([r["b"] / 10 for r in hist] + [5.0])
    n = np.array([r["n"] for r in hist] + [1])  # one more, so that lambda is finite
    lo, hi = 1e-6, 50.0
    for _ in range(100):
        lam = (lo + hi) / 2
        total = float((n * np.exp(np.minimum(lam * s, 700))).sum()) / words + max(0.0, 1 - n.sum() / words) * math.exp(-lam * DRIFT)
        lo, hi = (lam, hi) if total < 1 else (lo, lam)
    top = F.coalesce(F.array_max("scores"), F.lit(0.0))
    mean = clean.agg(F.avg(lo * top - F.log(F.greatest("words", F.lit(1))))).first()[0] or 0.0
    k = math.exp(mean - _EULER)
    c = Calibration(lo, k, 1.0, 0.0, share)
    ev = F.aggregate(F.transform("scores", lambda x: lo * x - F.log(k * F.greatest("words", F.lit(1)))),
                     F.lit(0.0), lambda a, x: a + F.greatest(x, F.lit(0.0)))
    bins = held.groupBy(F.least(F.lit(400), F.round(ev * 4)).alias("b"), "toxic").agg(
        F.count(F.lit(1)).alias("n")).collect()  # at most 802 rows
    x, y, m = (np.array([float(r[f]) for r in bins]) for f in ("b", "toxic", "n"))
    c.slope, c.intercept = _logistic(x / 4, y, m)
    return final, c


def _table(spark: SparkSession, lex: Lexicon | LexiconTable) -> LexiconTable:
    """``lex`` as a table (the other half's lexicon may be the one that is too large)."""
    if isinstance(lex, LexiconTable):
        return lex
    rows = [pa.table({"level": np.full(len(k), i, np.int32), "k": k.view(np.int64), "s": s})
            for i, (k, s) in enumerate(zip(lex.keys, lex.scores))]
    return LexiconTable(spark.createDataFrame(pa.concat_tables(rows)))


def _halves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Cuts batches so that each holds rows of one fold."""
    for b in batches:
        fold = b.column(0).to_numpy()
        for f in (0, 1):
            at = np.flatnonzero(fold == f)
            if len(at):
                yield b.take(pa.array(at))


def _logistic(x: np.ndarray, y: np.ndarray, n: np.ndarray, ridge: float = 1e-2) -> tuple[float, float]:
    """Slope (not below 0.01) and intercept by Newton steps on counted rows."""
    scale = max(float(np.abs(x).max()), 1.0)
    design = np.stack([x / scale, np.ones_like(x)], axis=1)
    w = np.zeros(2)
    for _ in range(200):
        p = 1 / (1 + np.exp(-np.clip(design @ w, -35, 35)))
        g = design.T @ (n * (p - y)) + ridge * w
        h = (design * (n * p * (1 - p))[:, None]).T @ design + ridge * np.eye(2)
        step = np.linalg.solve(h, g)
        step *= min(1.0, 2.0 / max(float(np.abs(step).max()), 1e-12))
        w -= step
        if np.abs(step).max() < 1e-9:
            break
    return max(float(w[0]) / scale, 0.01), float(w[1])


def score_documents(docs: DataFrame, lex: Lexicon | LexiconTable, cal: Calibration, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per row: doc_id, _h, score, n_words and the significant passages
    (first word, end, segment score, E-value)."""
    kind = docs.schema[id_col].dataType.simpleString()
    ship_package(docs.sparkSession)
    joined = isinstance(lex, LexiconTable)
    shared = docs.sparkSession.sparkContext.broadcast((None if joined else lex, cal))
    passage = pa.struct([("first", pa.int64()), ("end", pa.int64()), ("score", pa.float64()), ("e_value", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, cal = shared.value
        for part, found in _scored_hits(batches) if joined else _scored(batches, lambda _: lex, 2):
            rows = []
            for n, seg in found:
                e = [cal.k * max(n, 1) * math.exp(-min(cal.lam * s, 700)) for _, _, s in seg]
                rows.append([{"first": a, "end": b, "score": s, "e_value": x} for (a, b, s), x in zip(seg, e) if x <= E_VALUE])
            p = [cal.probability(cal.evidence([s for _, _, s in seg], n)) for n, seg in found]
            yield pa.RecordBatch.from_arrays(
                [part.column(0), part.column(1), pa.array(p, pa.float64()), pa.array([n for n, _ in found], pa.int64()),
                 pa.array(rows, pa.list_(passage))], names=["doc_id", "_h", "score", "n_words", "passages"])

    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    texts = docs.select(F.col(id_col).alias("doc_id"), F.xxhash64(t).alias("_h"), t.cast("binary").alias("t"))
    return (joined_hits(texts, lex) if joined else texts).mapInArrow(
        run, f"doc_id {kind}, _h long, score double, n_words long, "
             "passages array<struct<first:long,end:long,score:double,e_value:double>>")


@register("op9_toxicity")
def q_toxicity(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    labels = spark.read.parquet(f"{sf}/labels.parquet").select("doc_id", "toxic")
    s = score_documents(docs, *fit(docs, labels))
    return s.select("doc_id", held_out("doc_id").alias("held_out"), "score",
                    (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
                    F.size("passages").alias("n_passages"))
