"""Benchmark decontamination on a positional inverted index of the corpus.

Items become windows (13 consecutive words, or the whole item if shorter).
One pass over the corpus counts how often each test term occurs; windows with
a term that never occurs are out. Each remaining window is represented by its
``ANCHORS`` rarest terms. A second pass stores the postings (term, document,
position) of those terms, and of an end mark that gives every document's
length. The lists of a window are shifted by their term's offset and
intersected, starting with the rarest: what is left are the possible starts.
The starts are confirmed on the words of those documents alone, so a match is
always exact; ``proximity_matches`` asks the same index for terms that occur
close together.

Documents are identified by (id, 64-bit text hash), so rows that repeat an id
are judged apart. Only tables whose row count was checked are broadcast; the
window table is bounded by the benchmark. A hot document or window is a join
key with map-side aggregation or an adaptive skew split behind it; no group
is collected but the items of one document.

Defined results: null or empty text has no words, no hits and is clean. An
item without words has no window. Windows of an item whose id is null count
as hits but not as items. Repeated items and repeated documents give the same
result in each row. Other columns are not read. DataFrame functions only.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowatlas.llm.common import NON_ALNUM_CLASS, ascii_lower, register, save, small, words_of, work_dir

WINDOW = 13
ANCHORS = 3
RATE = 20  # contaminated if RATE * n_hit >= n_words
END = ""   # the end mark's term: no word is empty


def words(text: Column) -> Column:
    return words_of(ascii_lower(text), NON_ALNUM_CLASS)


def keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(_id, _h, _t): a document's identity, both parts never null, and its text."""
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    return docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("-")).alias("_id"),
                       F.xxhash64(t).alias("_h"), t.alias("_t"))


def item_windows(items: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(wid, terms, items): the distinct windows and the ids they come from."""
    w = items.select(F.col(id_col).cast("string").alias("_item"), words(F.col(text_col)).alias("_w"))
    starts = F.sequence(F.lit(1), F.greatest(F.size("_w") - (window - 1), F.lit(1)))
    x = w.filter(F.size("_w") > 0).select("_item", "_w", F.explode(starts).alias("_s"))
    x = x.select("_item", F.slice("_w", F.col("_s"), F.lit(window)).alias("terms"))
    return (x.groupBy("terms").agg(F.collect_set("_item").alias("items"))
            .select(F.sha2(F.array_join("terms", " "), 256).alias("wid"), "terms", "items"))


def term_counts(docs: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """(term, cf): occurrences of each of ``terms`` in the corpus (counted map-side)."""
    all_words = docs.select(F.explode(words(F.col("_t"))).alias("term"))
    return all_words.join(small(terms, n_terms), "term").groupBy("term").agg(F.count(F.lit(1)).alias("cf"))


def postings(docs: DataFrame, terms: DataFrame, n_terms: int) -> DataFrame:
    """The index: (term, _id, _h, pos) for the given terms, plus (END, _id, _h,
    number of words) for every document."""
    w = F.concat(words(F.col("_t")), F.array(F.lit(END)))
    end = terms.select("term").union(terms.sparkSession.createDataFrame([(END,)], "term string")).distinct()
    return (docs.select("_id", "_h", F.posexplode(w).alias("pos", "term"))
            .join(small(end, n_terms + 1), "term").select("term", "_id", "_h", "pos"))


def window_anchors(windows: DataFrame, counts: DataFrame, anchors: int) -> DataFrame:
    """(wid, len, t1, o1, t2, o2, ..): each window's rarest terms with their
    offsets, rarest first; a window of fewer terms repeats its rarest. Windows
    with a term that the corpus lacks are dropped."""
    x = (windows.select("wid", F.size("terms").alias("len"), F.posexplode("terms").alias("off", "term"))
         .groupBy("wid", "len", "term").agg(F.min("off").alias("off"))
         .join(counts, "term", "left"))
    # at most ``window`` terms per window
    a = x.groupBy("wid", "len").agg(
        F.sort_array(F.collect_list(F.struct(F.coalesce("cf", F.lit(0)).alias("cf"), "term", "off"))).alias("_a"))
    a = a.filter(F.col("_a")[0]["cf"] > 0)
    one = lambda i, f: F.coalesce(F.get("_a", F.lit(i))[f], F.col("_a")[0][f])
    return a.select("wid", "len", *[one(i, f).alias(f"{n}{i + 1}") for i in range(anchors) for f, n in (("term", "t"), ("off", "o"))])


def intersect(index: DataFrame, anchor: DataFrame, anchors: int) -> DataFrame:
    """(wid, _id, _h, start): starts at which every anchor of the window is in
    its place. The rarest list makes the candidates; each later one only removes."""
    found = (index.join(anchor, index["term"] == anchor["t1"])
             .withColumn("start", F.col("pos") - F.col("o1")).filter("start >= 0").drop("term", "pos"))
    for k in range(2, anchors + 1):
        lists = index.select(F.col("term").alias(f"t{k}"), "_id", "_h", F.col("pos").alias("_p"))
        found = found.withColumn("_p", F.col("start") + F.col(f"o{k}")).join(lists, [f"t{k}", "_id", "_h", "_p"], "left_semi")
    return found.select("wid", "_id", "_h", "start").distinct()


def confirm(docs: DataFrame, found: DataFrame, windows: DataFrame) -> DataFrame:
    """Candidates whose every word agrees. Only the candidates' documents are
    split into words again: their ids are broadcast if few."""
    ids = found.select("_id", "_h").distinct()
    there = docs.join(small(ids, ids.count()), ["_id", "_h"], "left_semi").dropDuplicates(["_id", "_h"])
    x = found.join(windows.select("wid", "terms"), "wid").join(
        there.select("_id", "_h", words(F.col("_t")).alias("_w")), ["_id", "_h"])
    return (x.filter(F.slice("_w", F.col("start") + 1, F.size("terms")) == F.col("terms"))
            .select("wid", "_id", "_h", "start", F.size("terms").alias("len")))


class PositionalIndex:
    """The stored postings of a corpus for the terms of some benchmark items."""

    def __init__(self, docs: DataFrame, items: DataFrame, id_col="doc_id", text_col="text", item_id="item_id",
                 item_text="text", window: int = WINDOW, anchors: int = ANCHORS):
        path = work_dir(docs.sparkSession, "decontaminate")
        self.docs = keyed(docs, id_col, text_col)
        self.windows = save(item_windows(items, item_id, item_text, window), f"{path}/windows")
        terms = save(self.windows.select(F.explode("terms").alias("term")).distinct(), f"{path}/terms")
        counts = save(term_counts(self.docs, terms, terms.count()), f"{path}/counts")
        self.anchors = anchors
        self.anchor = save(window_anchors(self.windows, counts, anchors), f"{path}/anchors")
        rare = reduce(DataFrame.union, [self.anchor.select(F.col(f"t{k + 1}").alias("term")) for k in range(anchors)])
        rare = save(rare.distinct(), f"{path}/rare")
        stored = save(postings(self.docs, rare, rare.count()), f"{path}/postings")
        self.lengths = stored.filter(F.col("term") == END).select("_id", "_h", F.col("pos").alias("n_words"))
        self.postings = stored.filter(F.col("term") != END)
        self.path = path

    def phrases(self) -> DataFrame:
        """(wid, _id, _h, start, len): every exact occurrence of every window."""
        found = save(intersect(self.postings, self.anchor, self.anchors), f"{self.path}/found")
        return save(confirm(self.docs, found, self.windows), f"{self.path}/phrases")

    def proximity_matches(self, slop: int) -> DataFrame:
        """(wid, _id, _h): documents where the window's rarest terms all occur,
        in any order, within ``slop`` words from the rarest one."""
        near = self.postings.join(self.anchor, self.postings["term"] == self.anchor["t1"]).drop("term")
        for k in range(2, self.anchors + 1):
            lists = self.postings.select(F.col("term").alias(f"t{k}"), "_id", "_h", F.col("pos").alias("_q"),
                                         F.floor(F.col("pos") / (slop + 1)).alias("_cell"))
            # terms at most slop apart lie in the same or in neighbouring cells
            cells = near.withColumn("_at", F.floor(F.col("pos") / (slop + 1))).withColumn(
                "_cell", F.explode(F.array(F.col("_at") - 1, F.col("_at"), F.col("_at") + 1)))
            near = (cells.join(lists, [f"t{k}", "_id", "_h", "_cell"])
                    .filter(F.abs(F.col("_q") - F.col("pos")) <= slop)
                    .select(*near.columns).distinct())
        return near.select("wid", "_id", "_h").distinct()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_id: str = "item_id", item_text: str = "text", window: int = WINDOW,
                  anchors: int = ANCHORS, rate: int = RATE) -> DataFrame:
    """One row per document identity (_id, _h): n_words, n_hit (words inside an
    occurrence), item_list (ids of items with occurrences, sorted as strings),
    contaminated."""
    index = PositionalIndex(docs, items, id_col, text_col, item_id, item_text, window, anchors)
    hit = index.phrases()
    # covered words: what each occurrence adds beyond the furthest end so far
    w = Window.partitionBy("_id", "_h").orderBy("start", "len").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("len")
    covered = (hit.select("_id", "_h", "start", "len").distinct().withColumn("_e", F.coalesce(F.max(end).over(w), F.lit(0)))
               .groupBy("_id", "_h").agg(F.sum(F.greatest(end - F.greatest("start", "_e"), F.lit(0))).alias("n_hit")))
    ids = (hit.select("_id", "_h", "wid").distinct().join(index.windows.select("wid", F.explode("items").alias("_item")), "wid")
           .groupBy("_id", "_h").agg(F.array_sort(F.collect_set("_item")).alias("item_list")))
    return (index.lengths.join(covered, ["_id", "_h"], "left").join(ids, ["_id", "_h"], "left")
            .withColumns({"n_words": F.col("n_words").cast("long"), "n_hit": F.coalesce("n_hit", F.lit(0)).cast("long"),
                          "item_list": F.coalesce("item_list", F.array().cast("array<string>"))})
            .withColumn("contaminated", (F.col("n_hit") > 0) & (rate * F.col("n_hit") >= F.col("n_words"))))


def drop_contaminated(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the contaminated ones; same columns. Only the rejected
    documents' keys are joined back (broadcast if few)."""
    bad = save(contamination(docs, items, id_col, text_col).filter("contaminated").select("_id", "_h"),
               f"{work_dir(docs.sparkSession, 'contaminated')}/bad")
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    d = docs.toDF(*names.values())
    d = d.withColumns({"_id": F.coalesce(F.col(names[id_col]).cast("string"), F.lit("-")),
                       "_h": F.xxhash64(F.coalesce(F.col(names[text_col]).cast("string"), F.lit("")))})
    return d.join(small(bad, bad.count()), ["_id", "_h"], "left_anti").drop("_id", "_h").toDF(*docs.columns)


ORACLE = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM documents),
i AS (SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
             'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w FROM benchmark),
iw AS (SELECT item_id, least(len(w), 13) AS n, array_to_string(w[s:s + 12], ' ') AS g
       FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS s FROM i WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT n FROM iw),
dg AS (SELECT doc_id, n, s, array_to_string(w[s:s + n - 1], ' ') AS g
       FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS s FROM d, sizes WHERE len(w) >= n)),
m AS (SELECT DISTINCT doc_id, item_id, s, dg.n FROM dg JOIN iw USING (n, g)),
h AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(s, s + n)) AS p FROM m) GROUP BY doc_id),
t AS (SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS ids
      FROM (SELECT DISTINCT doc_id, CAST(item_id AS varchar) AS x FROM m) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS bigint) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN h USING (doc_id) LEFT JOIN t USING (doc_id)
"""


@register("op3_decontaminate", ORACLE)
def q_decontaminate(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    c = contamination(docs, spark.read.parquet(f"{sf}/benchmark.parquet").select("item_id", "text"))
    return c.select(F.when(F.col("_id") != "-", F.col("_id")).cast("long").alias("doc_id"), "n_words", "n_hit",
                    F.size("item_list").cast("long").alias("n_items"),
                    F.sha2(F.array_join("item_list", ","), 256).alias("items_sha256"), "contaminated")
