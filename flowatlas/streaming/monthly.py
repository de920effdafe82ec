"""Monthly applications as a Structured Streaming aggregation.

The batch operator ``flows.monthly_applications`` applied unchanged to a
streaming source: new monthly files land in a folder, each micro-batch
updates the (year, month) state. State and progress live in the given
checkpoint folder: a query started again with the same folder resumes there.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from flowatlas.operators.flows import monthly_applications


def monthly_applications_stream(spark: SparkSession, source_dir: str, schema) -> DataFrame:
    """Streaming DataFrame of monthly totals over the parquet files of
    ``source_dir`` (explicit schema: streaming sources never infer)."""
    src = spark.readStream.schema(schema).option("maxFilesPerTrigger", 64).parquet(source_dir)
    return monthly_applications(src)


def run_available(agg: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Process everything available now (``availableNow`` trigger); each batch
    writes the result so far to a folder of its own beside ``checkpoint``, and
    the last one is returned. Nothing is held on the driver."""
    spark, out, last = agg.sparkSession, f"{checkpoint}-result", []

    def write(df: DataFrame, batch: int) -> None:
        df.write.mode("overwrite").parquet(f"{out}/batch={batch}")
        last.append(batch)

    q = (agg.writeStream.outputMode("complete").foreachBatch(write).queryName(name)
         .option("checkpointLocation", checkpoint).trigger(availableNow=True).start())
    q.awaitTermination()
    if not last:
        return spark.createDataFrame([], agg.schema)
    return spark.read.schema(agg.schema).parquet(f"{out}/batch={max(last)}")
