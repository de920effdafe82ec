"""A training-data pipeline over ``documents``: five stages, each the operator
of ``flowatlas.llm`` on all rows that the stage before kept.

Toxicity rejects documents, near-duplicates keep the document of the least id
(of several, or without ids, of the least text hash) of each group, decontamination rejects documents that hold benchmark text,
secret scans put a mark in place of every secret, packing cuts the texts into
token pieces and places them in sequences. All but the last stage return the
columns of their input. ``run`` writes every stage's result as Parquet under
the shared checkpoint folder and gives the next stage what it reads back.

Defined results: rows that are equal in id and text are copies of one document
and one of them stays; documents without text are kept as they are. Columns
other than ``doc_id``, ``text`` and ``n_chars`` pass through, whatever their
names.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.llm import decontaminate, neardup, packing, secrets, toxicity
from flowatlas.llm.common import save, small, work_dir
from flowatlas.llm.tokens import tokenizer_path

TOXIC_SCORE = toxicity.THRESHOLD


def _inner(docs: DataFrame) -> tuple[DataFrame, dict[str, str]]:
    """``docs`` under names that clash with nothing, and the way back."""
    names = {c: f"_c{i}" for i, c in enumerate(docs.columns)}
    return docs.toDF(*names.values()), names



def _with_key(docs: DataFrame) -> tuple[DataFrame, list[str]]:
    """``docs`` under inner names with (_id, _h), a document's id and text hash, never null."""
    d, names = _inner(docs)
    return d.withColumns({"_id": F.coalesce(F.col(names["doc_id"]).cast("string"), F.lit("-")),
                          "_h": F.xxhash64(F.coalesce(F.col(names["text"]).cast("string"), F.lit("")))}), docs.columns


def _without(docs: DataFrame, bad: DataFrame, key: str) -> DataFrame:
    """``docs`` without the rows whose (_id, _h) is in ``bad``."""
    bad = save(bad.select("_id", "_h").distinct(), f"{work_dir(docs.sparkSession, key)}/rejected")
    d, names = _with_key(docs)
    return d.join(small(bad, bad.count()), ["_id", "_h"], "left_anti").drop("_id", "_h").toDF(*names)


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose toxicity score is below the threshold."""
    plain = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "toxic")
    scores = toxicity.score_documents(plain, *toxicity.fit(plain, labels))
    bad = scores.filter(F.col("score") >= TOXIC_SCORE).select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("_id"), "_h")
    return _without(docs, bad, "toxic")


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document of the least (id, text hash) of each group of near-duplicates
    (five words, 0.8); documents without an id come last."""
    path = work_dir(spark, "groups")
    found = neardup.near_duplicates(docs.select(docs["doc_id"], docs["text"].cast("string").alias("text")))
    rows = save(found.select(F.coalesce(F.col("doc_id").cast("string"), F.lit("-")).alias("_id"), "_h", "component",
                             F.struct(F.col("doc_id").isNull(), "doc_id", "_h").alias("_at")), f"{path}/rows")
    least = rows.filter("component is not null").groupBy("component").agg(F.min("_at").alias("_at"))
    least = least.select(F.coalesce(F.col("_at.doc_id").cast("string"), F.lit("-")).alias("_id"), F.col("_at._h").alias("_h"))
    bad = save(rows.filter("component is not null").select("_id", "_h").distinct().join(least, ["_id", "_h"], "left_anti"),
               f"{path}/rejected")
    out = _without(docs, bad, "duplicates")
    # rows that repeat both id and text are one document: only they are regrouped
    again = save(rows.groupBy("_id", "_h").agg(F.count(F.lit(1)).alias("n")).filter("n > 1").select("_id", "_h")
                 .join(bad, ["_id", "_h"], "left_anti"), f"{path}/again")
    n = again.count()
    if not n:
        return out
    d, names = _with_key(out)
    single = d.join(small(again, n), ["_id", "_h"], "left_anti")
    one = d.join(small(again, n), ["_id", "_h"], "left_semi").dropDuplicates(["_id", "_h"])
    return single.unionByName(one).drop("_id", "_h").toDF(*names)


def reject_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by benchmark items."""
    items = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("item_id", "text")
    found = decontaminate.contamination(docs.select(docs["doc_id"], docs["text"].cast("string").alias("text")), items)
    return _without(docs, found.filter("contaminated"), "contaminated")


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by its kind in brackets."""
    path = work_dir(spark, "redact")
    plain = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    found = secrets.scan(plain.withColumn("version", F.lit(0)), f"{path}/ledger", path_col="doc_id")
    hits = save(found.filter(F.size("spans") > 0).groupBy("blob").agg(F.any_value("spans").alias("_spans")), f"{path}/hits")
    d, names = _inner(docs)
    text = F.col(names["text"])
    possible = secrets.possible(F.coalesce(text.cast("string"), F.lit("")))
    # only texts that can hold a secret meet the findings; all others stay where they are
    some = d.filter(possible).withColumn("_blob", F.sha2(text.cast("string").cast("binary"), 256))
    some = some.join(small(hits, hits.count(), 100_000), F.col("_blob") == F.col("blob"), "left")
    some = some.withColumn("_clean", F.when(F.col("_spans").isNotNull(), secrets.redact(text, F.col("_spans"))).otherwise(text))
    out = []
    for c, inner in names.items():
        if c == "text":
            out.append(F.col("_clean").alias(inner))
        elif c == "n_chars":
            kind = docs.schema[c].dataType
            out.append(F.when(F.col("_spans").isNotNull(), F.length("_clean").cast(kind)).otherwise(F.col(inner)).alias(inner))
        else:
            out.append(F.col(inner))
    return d.filter(~possible).unionByName(some.select(*out)).toDF(*names)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces of all documents, placed in sequences of 4096 ids."""
    plain = docs.select(docs["doc_id"], docs["text"].cast("string").alias("text"))
    return packing.pack_documents(plain, tokenizer_path())


STAGES = [
    ("toxicity", reject_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", reject_contaminated),
    ("secrets", redact_secrets),
    ("packing", pack),
]

#: tokenization and learned scores have no SQL; tests hold run() against brute force
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn over ``documents``."""
    folder = work_dir(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for k, (name, stage) in enumerate(STAGES):
        docs = save(stage(spark, docs, sf_dir), f"{folder}/{k}-{name}")
    return docs
