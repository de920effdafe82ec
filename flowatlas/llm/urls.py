"""URL filter: host-suffix / path-prefix expressions joined on short hash prefixes.

Every distinct URL is expanded into the expressions that a rule could be
written as: each suffix of its host at a label boundary (no longer than the
longest rule host) times each prefix of its path of a length that some rule
path has. The SHA-256 digest of an expression is matched with the rules in two
steps: an equi-join on its first 32 bits, then equality of the full digests.
Of the confirmed rules the longest (host plus path) decides; on equal length
the longer host, then ``block`` before ``allow``, then the smaller text.

Defined results: a null URL or one without ``://`` has an empty host and path
and fits no rule with a path; no rule at all gives every page the default
verdict; repeated rows are each judged; other columns of ``pages`` are not
read. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from flowatlas.llm.common import ascii_lower, register

#: fixed values of the contract: (host, path, verdict)
CONTRACT_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
                  ("net", "/es/", "block"), ("net", "/fr/", "block")]
RULE_SCHEMA = "host string, path string, verdict string"


def split_url(df: DataFrame, url: str) -> DataFrame:
    """Adds ``_host`` (A-Z lower-cased) and ``_path``; both empty without ``://``."""
    u = F.coalesce(F.col(url), F.lit(""))
    return df.withColumns({"_host": ascii_lower(F.regexp_extract(u, "://([^/?#]*)", 1)),
                           "_path": F.regexp_extract(u, "://[^/?#]*([^?#]*)", 1)})


def _digest(host, path):
    return F.sha2(F.concat(host, F.lit("\n"), path), 256)


def judge_urls(pages: DataFrame, rules: DataFrame, default: str = "allow", id_col: str = "page_id",
               url_col: str = "url", prefix_hex: int = 8) -> DataFrame:
    """One row per page: id, host, path, rule (host + path of the deciding rule
    or null), verdict and ``n_rules`` (distinct rules that fit).

    The rules' label count and path lengths (two numbers per distinct length,
    bounded by the longest rule, not by the number of rules or pages) shape
    the expansion; the rule table itself is joined, never collected."""
    r = (rules.select(F.coalesce("host", F.lit("")).alias("_rh"), F.coalesce("path", F.lit("")).alias("_rp"),
                      F.col("verdict").alias("_rv"))
         .groupBy("_rh", "_rp").agg(F.max(F.col("_rv") == "block").alias("_blocks"), F.min("_rv").alias("_rv"))
         .withColumn("_rv", F.when(F.col("_blocks"), F.lit("block")).otherwise(F.col("_rv"))))
    shape = r.agg(F.max(F.size(F.split("_rh", r"\."))).alias("labels"),
                  F.sort_array(F.collect_set(F.length("_rp"))).alias("lengths")).first()
    labels, lengths = shape["labels"] or 0, list(shape["lengths"] or [])
    r = r.withColumn("_full", _digest(F.col("_rh"), F.col("_rp"))).withColumn("_short", F.substring("_full", 1, prefix_hex))

    p = split_url(pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("_url")), "_url")
    keys = p.select("_host", "_path").distinct()
    parts = F.split("_host", r"\.")
    hosts = F.transform(F.sequence(F.lit(1), F.least(F.size("_parts"), F.lit(max(labels, 1)))),
                        lambda k: F.array_join(F.slice("_parts", F.size("_parts") - k + 1, k), "."))
    lens = F.filter(F.array(*[F.lit(n) for n in lengths]).cast("array<int>"), lambda n: n <= F.length("_path"))
    # one array of (host suffix, path prefix) per URL, so that one explode makes all expressions
    pairs = F.flatten(F.transform(hosts, lambda h: F.transform(
        lens, lambda n: F.struct(h.alias("h"), F.substring(F.col("_path"), F.lit(1), n).alias("p")))))
    x = (keys.withColumn("_parts", parts).select("_host", "_path", F.explode(pairs).alias("_e"))
         .withColumn("_xfull", _digest(F.col("_e.h"), F.col("_e.p")))
         .select("_host", "_path", "_xfull", F.substring("_xfull", 1, prefix_hex).alias("_short")))
    hit = x.join(r, "_short").filter(F.col("_xfull") == F.col("_full"))
    rank = F.struct((F.length("_rh") + F.length("_rp")).alias("len"), F.length("_rh").alias("host_len"),
                    (F.col("_rv") == "block").alias("blocks"))
    best = hit.groupBy("_host", "_path").agg(
        F.max_by(F.struct(F.concat("_rh", "_rp").alias("rule"), F.col("_rv").alias("verdict")), rank).alias("_best"),
        F.count(F.lit(1)).alias("_n"))
    return (p.join(best, ["_host", "_path"], "left")
            .select("page_id", F.col("_host").alias("host"), F.col("_path").alias("path"),
                    F.col("_best.rule").alias("rule"),
                    F.coalesce("_best.verdict", F.lit(default)).alias("verdict"),
                    F.coalesce("_n", F.lit(0)).cast("long").alias("n_rules")))


_RULES_SQL = ", ".join(f"('{h}', '{p}', '{v}')" for h, p, v in CONTRACT_RULES)
ORACLE = f"""
WITH rules(rh, rp, rv) AS (VALUES {_RULES_SQL}),
u AS (SELECT row_number() OVER () AS rid, page_id, coalesce(url, '') AS url FROM pages),
s AS (SELECT rid, page_id,
             translate(regexp_extract(url, '://([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
             regexp_extract(url, '://[^/?#]*([^?#]*)', 1) AS path FROM u),
m AS (SELECT rid, rh || rp AS rule, rv, length(rh) + length(rp) AS len FROM s, rules
      WHERE (host = rh OR ends_with(host, '.' || rh)) AND starts_with(path, rp)),
b AS (SELECT rid, arg_max(rule, len) AS rule, arg_max(rv, len) AS verdict, count(*) AS n FROM m GROUP BY rid)
SELECT page_id, host, path, rule, coalesce(verdict, 'allow') AS verdict, coalesce(n, 0) AS n_rules
FROM s LEFT JOIN b USING (rid)
"""


@register("op10_url_filter", ORACLE)
def q_url_filter(spark: SparkSession, sf: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf}/pages.parquet").select("page_id", "url")
    return judge_urls(pages, spark.createDataFrame(CONTRACT_RULES, RULE_SCHEMA))
