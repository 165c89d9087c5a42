"""Windowed aggregates over a stream of event files."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch


def event_stream(spark: SparkSession, path: str) -> DataFrame:
    """A stream of the Parquet files under a folder, or of the one file there."""
    schema = spark.read.parquet(path).schema
    reader = spark.readStream.schema(schema)
    is_file = "://" not in path and os.path.isfile(path)
    return reader.option("pathGlobFilter", os.path.basename(path)).parquet(os.path.dirname(path)) if is_file else reader.parquet(path)


def hourly(events: DataFrame, late: str = "1 hour") -> DataFrame:
    """start, event_type, n, total in windows of an hour, closed once the watermark has passed them."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    got = timed.groupBy(F.window("at", "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total"))
    return got.select(F.col("w.start").cast("timestamp_ntz").alias("start"), "event_type", "n", F.round("total", 4).alias("total"))


def sessions(events: DataFrame, gap: str = "30 minutes", late: str = "1 hour") -> DataFrame:
    """user_id, start, end, n of each user's runs of events with less than the gap between them."""
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", late)
    got = timed.groupBy(F.session_window("at", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"))
    return got.select("user_id", F.col("w.start").cast("timestamp_ntz").alias("start"), F.col("w.end").cast("timestamp_ntz").alias("end"), "n")


def first_seen(events: DataFrame, within: str | None = None) -> DataFrame:
    """user_id, event_type: one row for each pair that the stream has had.

    The state is a row a pair, for good; with within (a time) a pair that returns later than that counts anew, and the
    state holds the pairs of that time alone.
    """
    if within is None:
        return events.select("user_id", "event_type").dropDuplicates(["user_id", "event_type"])
    timed = events.withColumn("at", F.col("ts").cast("timestamp")).withWatermark("at", within)
    return timed.dropDuplicatesWithinWatermark(["user_id", "event_type"]).select("user_id", "event_type")


def drained(stream: DataFrame, mode: str) -> DataFrame:
    """The result over all files there now: the stream runs until it has read them, and writes a folder a batch.

    The folders and the stream's checkpoint lie in the folder that driver and executors share, so no rows pass the driver
    and a batch that runs again replaces its own folder. In mode complete the last batch is the result.
    """
    spark = stream.sparkSession
    top, last = scratch(spark), []

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(f"{top}/batch-{number:06d}")
        last.append(number)

    running = stream.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", f"{top}/checkpoint").trigger(availableNow=True).start()
    running.awaitTermination()
    if not last:
        return spark.createDataFrame([], stream.schema)
    folders = [f"{top}/batch-{n:06d}" for n in sorted(set(last))]
    return spark.read.schema(stream.schema).parquet(*(folders[-1:] if mode == "complete" else folders))


def windowed_counts(spark: SparkSession, path: str) -> DataFrame:
    return drained(hourly(event_stream(spark, path)), "complete")
