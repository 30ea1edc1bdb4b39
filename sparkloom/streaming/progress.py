"""Progress counters: as batch aggregates and as a stream."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sparkloom.sources.shared import checkpoint_dir


def counters(failed: Column) -> list[Column]:
    return [F.count("*").alias("processed"), F.count_if(failed).alias("failed"), F.count_if(~failed).alias("ok")]


def batch_summary(events: DataFrame, failed: Column, ts: str = "ts") -> DataFrame:
    """Processed, ok, failed, success rate and items per second of elapsed time."""
    own = events.agg(*counters(failed), F.min(F.unix_timestamp(ts)).alias("first"), F.max(F.unix_timestamp(ts)).alias("last"))
    seconds = F.col("last") - F.col("first")
    return own.select("processed", "failed", "ok", F.round(F.col("ok") / F.col("processed"), 6).alias("success"), F.round(F.when(seconds > 0, F.col("processed") / seconds), 6).alias("rate"))


def eta_seconds(total: Column, done: Column, rate: Column) -> Column:
    return F.when(rate > 0, (total - done) / rate)


def stream_counts(events: DataFrame, failed: Column, ts: str = "ts", late: str = "1 hour", width: str = "1 day") -> DataFrame:
    """Counters by event-time window of a stream of events; late rows within the watermark count."""
    return events.withWatermark(ts, late).groupBy(F.window(ts, width)).agg(*counters(failed)).select("window.start", "window.end", "processed", "failed", "ok")


def new_files(spark: SparkSession, folder: str, schema, ts: str, key: str, late: str = "1 day") -> DataFrame:
    """Files that arrive in a folder, each key once within the watermark."""
    return spark.readStream.schema(schema).parquet(folder).withWatermark(ts, late).dropDuplicatesWithinWatermark([key])


def drained(stream: DataFrame, name: str) -> DataFrame:
    """Run a stream of window counts over what is there now and return its windows (as many as there are days)."""
    spark = stream.sparkSession
    place = f"{checkpoint_dir(spark)}/streams/{name}-{uuid.uuid4().hex}"
    writer = stream.writeStream.outputMode("complete").format("memory").queryName(name).trigger(availableNow=True).option("checkpointLocation", place)
    writer.start().awaitTermination()
    return spark.table(name)
