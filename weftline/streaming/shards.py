"""Streams of shards: running totals and sessions; additions to the batch operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def shard_stream(spark: SparkSession, folder: str, schema: str, per_trigger: int = 16) -> DataFrame:
    """New Parquet files of a folder as a stream."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(folder)


def running_totals(stream: DataFrame, by: str, tokens: str) -> DataFrame:
    """Documents and tokens of each value so far."""
    return stream.groupBy(by).agg(F.count("*").alias("documents"), F.sum(F.coalesce(F.col(tokens).cast("bigint"), F.lit(0).cast("bigint"))).alias("tokens"))


def windowed_counts(events: DataFrame, time: str, by: str, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Events of each window and value; events later than ``late`` are dropped where the table is a stream."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    timed = timed.withWatermark(time, late) if events.isStreaming else timed
    return timed.groupBy(F.window(time, window).alias("w"), by).agg(F.count("*").alias("events")).select(F.col("w.start").alias("start"), by, "events")


def sessions(events: DataFrame, time: str, by: str, gap: str = "30 minutes") -> DataFrame:
    """Sessions of each value, that end after a gap."""
    timed = events.withColumn(time, F.col(time).cast("timestamp"))
    timed = timed.withWatermark(time, gap) if events.isStreaming else timed
    made = timed.groupBy(F.session_window(time, gap).alias("s"), by).agg(F.count("*").alias("events"))
    return made.select(by, F.col("s.start").alias("start"), F.col("s.end").alias("end"), "events")
