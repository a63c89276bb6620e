"""Structured Streaming: counts per ten minutes, and idempotent writing of keyed batches."""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from glossarium.session import ensure_checkpoint_dir
from glossarium.sources.files import overwrite_keys


def event_stream(spark: SparkSession, path: str, per_trigger: int = 64) -> DataFrame:
    """The rows of a Parquet table as a stream, with `ts` as a timestamp that can carry a watermark."""
    known = spark.read.parquet(path).schema
    folder, _, name = path.rstrip("/").rpartition("/")
    rows = spark.readStream.schema(known).option("maxFilesPerTrigger", per_trigger).option("pathGlobFilter", "*.parquet")
    df = rows.parquet(path) if os.path.isdir(path) or "://" in path else rows.option("pathGlobFilter", name).parquet(folder)
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def velocity(events: DataFrame, late: str = "10 minutes") -> DataFrame:
    """(bucket, events): events per ten-minute window; rows later than `late` may be left out of a closed window."""
    counted = events.withWatermark("ts", late).groupBy(F.window("ts", "10 minutes")).agg(F.count(F.lit(1)).alias("events"))
    return counted.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("bucket"), "events")


def run_to_table(spark: SparkSession, df: DataFrame, mode: str = "complete") -> DataFrame:
    """Run a stream over what is there now and give its result as a table.

    Every batch is written as files to the shared checkpoint folder; for the complete mode the last batch stands.
    """
    base = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite" if mode == "complete" else "append").parquet(f"{base}/out")

    query = df.writeStream.outputMode(mode).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).foreachBatch(write).start()
    query.awaitTermination()
    return spark.read.schema(df.schema).parquet(f"{base}/out")


def keyed_writer(spark: SparkSession, path: str, keys: Sequence[str]):
    """A function for foreachBatch that replaces the rows of the batch's keys; a batch that is repeated changes nothing."""

    def write(batch: DataFrame, number: int) -> None:
        overwrite_keys(spark, path, batch, keys)

    return write


def write_stream(df: DataFrame, path: str, keys: Sequence[str], every: str = "30 seconds", once: bool = False):
    """Start a stream that keeps a keyed table up to date, in batches of `every`, or once over what is there."""
    spark = df.sparkSession
    state = f"{path.rstrip("/")}-state"
    writer = df.writeStream.foreachBatch(keyed_writer(spark, path, keys)).option("checkpointLocation", state)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()
