"""Checks that run inside the job that writes a table, and decide whether the
table is published.

A ``Check`` names the rows that break it. ``observe`` attaches one counter per
check to the DataFrame about to be written (``DataFrame.observe``), so the
counts come out of the writing job itself: no second pass over the data. The
counters stand last before the write, where a task that is run again replaces
its earlier attempt. ``verdicts`` turns the counts into gate rows; a blocking
check with broken rows is a FAIL, any other a DOCUMENTED row.
"""

from __future__ import annotations

import json
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

GATE_SCHEMA = "check string, status string, detail string, blocks_pipeline boolean, rows long"


@dataclass(frozen=True)
class Check:
    name: str
    #: SQL condition of a broken row; null counts as not broken
    broken: str
    blocks: bool = True
    #: what the detail calls the broken rows
    unit: str = "rows"


class QualityGateError(RuntimeError):
    """A table failed a blocking check and was not published."""

    def __init__(self, table: str, rows: list[dict], kept: str):
        self.table, self.rows, self.kept = table, rows, kept
        failed = "; ".join(f"{r['check']}: {r['detail']}" for r in rows if r["blocks_pipeline"])
        super().__init__(f"{table} is not published ({failed}); what was written is kept as {kept}")


def no_negative(*columns: str) -> Check:
    """No negative observed cell in any of ``columns``; counts cells."""
    return Check("no_negative_observed_values", " + ".join(f"if(coalesce({c} < 0, false), 1, 0)" for c in columns), unit="negative_cells")


def counters(checks: tuple[Check, ...]) -> list[Column]:
    """The number of rows and, per check, of what breaks it."""
    counts = [F.count(F.lit(1)).alias("rows")]
    for i, c in enumerate(checks):
        cells = c.broken if c.unit == "negative_cells" else f"if(coalesce({c.broken}, false), 1, 0)"
        counts.append(F.expr(f"coalesce(sum({cells}), 0)").alias(f"c{i}"))
    return counts


def observe(df: DataFrame, table: str, checks: tuple[Check, ...]) -> tuple[DataFrame, Observation]:
    """``df`` with the counters, and where their values will be after its write."""
    seen = Observation(f"gate_{table}")
    return df.observe(seen, *counters(checks)), seen


def verdicts(table: str, checks: tuple[Check, ...], counts: dict) -> list[dict]:
    rows = int(counts["rows"])
    out = []
    for i, c in enumerate(checks):
        n = int(counts[f"c{i}"])
        status = "PASS" if not n else "FAIL" if c.blocks else "DOCUMENTED"
        out.append({"check": f"{c.name}__{table}", "status": status, "detail": f"{c.unit}={n}", "blocks_pipeline": status == "FAIL", "rows": rows})
    return out or [{"check": f"written__{table}", "status": "PASS", "detail": f"rows={rows}", "blocks_pipeline": False, "rows": rows}]


def record(spark: SparkSession, path: str, rows: list[dict]) -> None:
    """The gate rows of one table as a JSON-lines file, written whole or not at all."""
    jvm = spark.sparkContext._jvm
    target, aside = jvm.org.apache.hadoop.fs.Path(path), jvm.org.apache.hadoop.fs.Path(path + ".part")
    fs = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(aside, True)
    out.write(bytearray("".join(json.dumps(r) + "\n" for r in rows), "utf-8"))
    out.close()
    if not fs.exists(target):
        fs.rename(aside, target)


def overall(gate: DataFrame) -> DataFrame:
    """One row for all of a gate's rows: FAIL if any of them blocks."""
    blocked = F.coalesce(F.bool_or("blocks_pipeline"), F.lit(False))
    return gate.agg(blocked.alias("b"), F.count_if("blocks_pipeline").alias("n")).select(
        F.lit("overall").alias("check"), F.when(F.col("b"), "FAIL").otherwise("PASS").alias("status"),
        F.concat(F.lit("blocking_checks="), F.col("n").cast("string")).alias("detail"), F.col("b").alias("blocks_pipeline"))
