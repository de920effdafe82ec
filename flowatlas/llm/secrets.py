"""Secret scans with an incremental blob ledger.

Every version of a file is a row (path, version, text). A text is a blob,
named by its SHA-256. The ledger is a table of what has been scanned: one row
per (blob, rules), with the spans found there. A scan

1. names all blobs, asks of each text whether it can hold a match at all (marks
   and runs that every match of a rule has, as JVM expressions), and takes one
   row for each blob that the ledger lacks under the current rules (an
   anti-join on names; no text moves),
2. enters the blobs that can hold none into the ledger as they are, reads the
   texts of the others again, scans them and appends what it finds,
3. joins the ledger's spans back to every path and version of each blob.

A ledger folder is append-only Parquet: a lost task or a repeated scan adds
nothing twice, since findings are read per (blob, rules) once. A new rule
version scans every blob again; the findings of older ones stay.

Spans are half-open code-point ranges, per rule leftmost and not overlapping;
matches that fail a rule's length are dropped after matching.
A private key reaches from its BEGIN line to the next END line, headers and
all, unless another key begins before it; without an END line only the BEGIN
line is a match.

Defined results: null text is the empty blob, without findings. Repeated rows
each get the blob's findings. Null paths or versions are ordinary values. An
empty table scans nothing. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator
from functools import reduce
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.llm.common import let_go, register, save, ship_package, small, work_dir

class Rule(NamedTuple):
    kind: str
    pattern: str
    #: group whose length counts, and its least length
    group: int
    least: int
    #: every match holds one of these strings (in either case, if ``fold``); none: unknown
    marks: tuple[str, ...] = ()
    fold: bool = False
    #: every match that is long enough holds a match of this (Python and Java alike)
    core: str = ""
    #: an equal pattern that runs faster: the same matches of at least that length
    fast: str = ""


#: fixed values of the contract, in the order in which kinds are listed
BASE_RULES = [
    Rule("assign", r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 8,
         ("password", "passwd", "secret", "token", "apikey", "api_key"), fold=True),
    Rule("access", r"AKIA[A-Z0-9]+", 0, 16, ("AKIA",), core="AKIA[A-Z0-9]{12}"),
    Rule("hex", r"[0-9a-f]+", 0, 32, core="[0-9a-f]{32}", fast="[0-9a-f]{32,}"),
]
#: rules of our own
MORE_RULES = [
    # a run whose first eyJ begins no match has none: it is skipped as a whole, so no text is read more than a few times
    Rule("jwt", r"(eyJ[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+\.[A-Za-z0-9_-]+)|eyJ[A-Za-z0-9_-]*+", 1, 40, ("eyJ",)),
    Rule("pem", r"-----BEGIN [A-Z ]*PRIVATE KEY-----(?:(?:(?!-----BEGIN [A-Z ]*PRIVATE KEY-----)[\s\S])*?-----END [A-Z ]*PRIVATE KEY-----)?",
         0, 27, ("-----BEGIN ",)),
    Rule("url_password", r"[a-z][a-z0-9+.-]{1,30}://[^\s:/@]+:([^\s:/@]+)@", 1, 4, ("://",), core=r"://[^\s:/@]+:[^\s:/@]+@"),
    Rule("vendor", r"\b(?:gh[pousr]_[A-Za-z0-9]{36,}|xox[abpr]-[A-Za-z0-9-]{10,}|sk_live_[A-Za-z0-9]{16,}|AIza[A-Za-z0-9_-]{35})", 0, 10,
         ("ghp_", "gho_", "ghu_", "ghs_", "ghr_", "xoxa-", "xoxb-", "xoxp-", "xoxr-", "sk_live_", "AIza")),
]
RULES = BASE_RULES + MORE_RULES
#: texts that are Python strings at once
TEXTS = 500
SPAN = "struct<kind:string,first:int,end:int>"


def rules_version(rules=RULES) -> str:
    """Changes with any rule."""
    return hashlib.sha256(repr([tuple(r) for r in rules]).encode()).hexdigest()[:16]


def possible(text: Column, rules=RULES) -> Column:
    """Whether ``text`` can hold a match of any rule: what each rule says of its
    matches, as JVM expressions. A rule that says nothing is always possible."""
    lower = F.lower(text)
    each = []
    for r in (Rule(*r) for r in rules):
        marks = [(lower if r.fold else text).contains(m) for m in r.marks]
        c = reduce(Column.__or__, marks) if marks else F.lit(True)
        each.append(c & text.rlike(r.core) if r.core else c)
    return reduce(Column.__or__, each) if each else F.lit(False)


def compile_rules(rules=RULES) -> list[tuple[Rule, re.Pattern]]:
    return [(r, re.compile(r.fast or r.pattern)) for r in (Rule(*r) for r in rules)]


def find_spans(text: str, compiled) -> list[tuple[str, int, int]]:
    """(kind, first, end) by first, then kind as listed."""
    out = []
    lower = text.lower()
    for order, (r, pattern) in enumerate(compiled):
        if r.marks and not any(m in (lower if r.fold else text) for m in r.marks):
            continue
        for m in pattern.finditer(text):
            if len(m.group(r.group) or "") >= r.least:
                out.append((m.start(), order, r.kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


def scan_batches(batches: Iterator[pa.RecordBatch], rules=RULES) -> Iterator[pa.RecordBatch]:
    """(blob, spans) of batches of (blob, text), ``TEXTS`` texts at a time."""
    let_go()
    compiled = compile_rules(rules)
    kind = pa.list_(pa.struct([("kind", pa.string()), ("first", pa.int32()), ("end", pa.int32())]))
    for batch in batches:
        for at in range(0, batch.num_rows, TEXTS):
            part = batch.slice(at, TEXTS)
            found = [find_spans(t, compiled) for t in part.column(1).to_pylist()]
            spans = [[{"kind": k, "first": a, "end": b} for k, a, b in f] for f in found]
            yield pa.RecordBatch.from_arrays([part.column(0), pa.array(spans, kind)], names=["blob", "spans"])


def _blobs(versions: DataFrame, text: str):
    return F.sha2(F.coalesce(F.col(text).cast("string"), F.lit("")).cast("binary"), 256)


def scan(versions: DataFrame, ledger: str, path_col: str = "path", text_col: str = "text", version_col: str | None = "version",
         rules=RULES) -> DataFrame:
    """Scans what the ledger lacks, appends it, and returns one row per row of
    ``versions``: path, version, blob, spans (array of kind, first, end)."""
    spark = versions.sparkSession
    ship_package(spark)
    work, version = work_dir(spark, "secrets"), rules_version(rules)
    v = F.col(version_col) if version_col else F.lit(0)
    t = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    named = save(versions.select(F.col(path_col).alias("path"), v.alias("version"), _blobs(versions, text_col).alias("blob"),
                                 possible(t, rules).alias("possible")), f"{work}/named")
    have = read_ledger(spark, ledger).filter(F.col("rules") == version).select("blob").distinct()
    # one place of each unseen blob: a path and version that hold it
    key = F.struct(F.coalesce(F.col("path").cast("string"), F.lit("-")).alias("p"),
                   F.coalesce(F.col("version").cast("string"), F.lit("-")).alias("v"))
    todo = save(named.groupBy("blob", "possible").agg(F.min(key).alias("_at")).join(have, "blob", "left_anti")
                .select(F.col("_at.p").alias("_p"), F.col("_at.v").alias("_v"), "blob", "possible"), f"{work}/todo")
    # the texts that move: those that can hold a match, whatever their number
    texts = versions.select(F.coalesce(F.col(path_col).cast("string"), F.lit("-")).alias("_p"),
                            F.coalesce(v.cast("string"), F.lit("-")).alias("_v"), t.alias("_t")).filter(possible(F.col("_t"), rules))
    # equal keys may hold different texts: the name decides
    one = (texts.join(todo.filter("possible").drop("possible"), ["_p", "_v"])
           .filter(F.sha2(F.col("_t").cast("binary"), 256) == F.col("blob")).select("blob", "_t"))

    scanned = one.mapInArrow(lambda batches: scan_batches(batches, rules), f"blob string, spans array<{SPAN}>")
    nothing = todo.filter("not possible").select("blob", F.array().cast(f"array<{SPAN}>").alias("spans"))
    scanned.unionByName(nothing).withColumn("rules", F.lit(version)).write.mode("append").parquet(ledger)
    # blobs without findings need no join; the others once each, whatever repeats in the ledger
    hits = (read_ledger(spark, ledger).filter((F.col("rules") == version) & (F.size("spans") > 0))
            .select("blob", "spans").dropDuplicates(["blob"]))
    hits = save(hits, f"{work}/hits")
    return named.join(small(hits, hits.count(), 100_000), "blob", "left").select(
        "path", "version", "blob", F.coalesce("spans", F.array().cast(f"array<{SPAN}>")).alias("spans"))


def read_ledger(spark: SparkSession, ledger: str) -> DataFrame:
    from flowatlas.sources.catalog import path_exists
    schema = f"blob string, rules string, spans array<{SPAN}>"
    if not path_exists(spark, ledger):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(ledger)


def span_text(spans) -> F.Column:
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["first"], s["end"])), ",")


def redact(text, spans):
    """``text`` with every span (they may overlap) replaced by its kind in brackets."""
    start = F.struct(F.lit(1).alias("at"), F.lit("").alias("out"))
    done = F.aggregate(
        spans, start,
        lambda a, s: F.struct(
            F.greatest(a["at"], s["end"] + 1).alias("at"),
            F.when(s["first"] + 1 >= a["at"], F.concat(
                a["out"], F.substring(text, a["at"], s["first"] + 1 - a["at"]), F.lit("["), s["kind"], F.lit("]")))
            .otherwise(a["out"]).alias("out")))
    return F.when(F.size(spans) > 0, F.concat(done["out"], F.substring(text, done["at"], F.length(text)))).otherwise(text)


@register("op8_secret_scan")
def q_secret_scan(spark: SparkSession, sf: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text")
    found = scan(docs, work_dir(spark, "ledger"), path_col="doc_id", version_col=None)
    n = lambda k: F.size(F.filter("spans", lambda s: s["kind"] == k)).cast("long").alias(f"n_{k}")
    base = F.filter("spans", lambda s: s["kind"].isin([r.kind for r in BASE_RULES]))
    return found.select(F.col("path").alias("doc_id"), n("assign"), n("access"), n("hex"),
                        F.sha2(span_text(base), 256).alias("base_sha256"), span_text(F.col("spans")).alias("spans"))
