"""The batch stream as Structured Streaming: files arrive, are counted by period, and batches are handed on once each."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from ..functions.columns import period_name


def stream(spark: SparkSession, folder: str, schema: StructType, files_per_trigger: int = 1) -> DataFrame:
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(folder)


def process_available(df: DataFrame, handle: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand all files that are new since the checkpoint to ``handle``, a micro-batch at a time; a failed one comes again.

    ``handle`` gets the batch's number, by which it can make its writes idempotent.
    """
    query = df.writeStream.foreachBatch(handle).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()


def monthly_totals(df: DataFrame, time_col: str, value: str, size: str = "month") -> DataFrame:
    """(period, n, total): a calendar period is no fixed interval, so the key is its name, not a time window."""
    return df.groupBy(period_name(F.col(time_col), size).alias("period")).agg(F.count("*").alias("n"), F.round(F.sum(value), 2).alias("total"))


def run_to_table(totals: DataFrame, name: str, checkpoint: str) -> DataFrame:
    """Run a streaming aggregate over what is there and return its last state."""
    query = totals.writeStream.outputMode("complete").format("memory").queryName(name).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return totals.sparkSession.table(name)


def late_windows(df: DataFrame, time_col: str, key: str, delay: str = "1 day", length: str = "1 day") -> DataFrame:
    """An extension: counts by event-time window, late rows within ``delay`` included."""
    at = df.withColumn("_t", F.col(time_col).cast("timestamp")).withWatermark("_t", delay)
    return at.groupBy(F.window("_t", length), key).agg(F.count("*").alias("n"))
