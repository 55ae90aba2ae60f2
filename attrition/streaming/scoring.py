"""Scoring on a stream of new customers.

The batch scoring chain is row-wise with fitted state (cutoff, levels,
scaler, model), so the same function applies to a streaming DataFrame.
Results go to a file sink with a checkpoint location in the shared folder
(exactly-once file output, restart after failure). A running per-segment
count is kept by a stateful streaming aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..params import SegmentParams
from ..plans.score import score_customers
from ..schema import RAW_SCHEMA
from ..session import shared_dir


def read_customer_stream(spark: SparkSession, path: str, fmt: str = "parquet",
                         max_files_per_trigger: int = 1) -> DataFrame:
    """New customer files as a stream (declared schema, label optional)."""
    reader = spark.readStream.schema(RAW_SCHEMA).option("maxFilesPerTrigger", max_files_per_trigger)
    if fmt == "csv":
        reader = reader.option("header", True)
    return reader.format(fmt).load(path)


def score_stream(stream: DataFrame, model, prep, params: SegmentParams = SegmentParams()) -> DataFrame:
    return score_customers(stream, model, prep, params)


def start_scoring(stream: DataFrame, model, prep, output_path: str, name: str = "scoring",
                  params: SegmentParams = SegmentParams(), trigger_once: bool = False):
    """Append scored rows to ``output_path`` (parquet)."""
    spark = stream.sparkSession
    writer = (score_stream(stream, model, prep, params).writeStream.format("parquet")
              .option("path", output_path)
              .option("checkpointLocation", shared_dir(spark, f"stream_{name}"))
              .outputMode("append"))
    if trigger_once:
        writer = writer.trigger(availableNow=True)
    return writer.start()


def segment_counts_stream(scored: DataFrame) -> DataFrame:
    """Running rows per risk segment (complete mode)."""
    return scored.where(F.col("risk_segment").isNotNull()).groupBy("risk_segment").agg(
        F.count(F.lit(1)).alias("count"))
