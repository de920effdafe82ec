"""Connected components of an edge table by alternating stars."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowatlas.llm.common import save


def _star(e: DataFrame, large: bool) -> DataFrame:
    """Every edge of a node moves to the least node next to it."""
    both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
    side = both if large else both.filter("v < u")
    low = side.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("u", "m"))
    moved = side.join(low, "u")
    out = moved.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    if not large:
        out = moved.filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(
            low.select("u", F.col("m").alias("v")))
    return out.filter("u <> v").distinct()


def components(edges: DataFrame, path: str, rounds: int = 60) -> DataFrame:
    """(node, component) for every node of ``edges`` (a, b) but the least of
    each component, which is its name. Alternates large and small stars until
    the edges no longer change: about log2 of the longest chain rounds. Each
    round is written under ``path``; a node's edges are met by a join, never
    collected."""
    e = save(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(),
             f"{path}/edges")
    before = None
    for k in range(rounds):
        large = save(_star(e, True), f"{path}/large{k}")
        e = save(_star(large, False), f"{path}/small{k}")
        now = e.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("u", "v"))).first()
        if now == before:
            return e.select(F.col("u").alias("node"), F.col("v").alias("component"))
        before = now
    raise RuntimeError(f"components still change after {rounds} rounds")
