"""Structured Streaming: tumbling windows over an event stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from touchline.sources.shared import shared_path


def hourly_counts(events: DataFrame) -> DataFrame:
    """Works on a batch and on a stream: events an hour and type."""
    ts = F.col("ts") if dict(events.dtypes)["ts"] == "timestamp" else F.col("ts").cast("timestamp")  # a cast would hide a watermark
    return events.groupBy(F.window(ts, "1 hour").alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("hour"), "event_type", "n")


def streamed_hourly_counts(spark: SparkSession, path: str, late: str = "1 hour") -> DataFrame:
    """Reads the folder ``path`` as a stream until all that is there is counted: an hour is written once, when the stream is ``late`` past its end.

    The watermark bounds the state to the hours that are still open; rows that come later than that are dropped by the stream. What is open
    at the end, from the last written hour on, is counted from the folder as a batch."""
    out, state = shared_path(spark, "hourly"), shared_path(spark, "state")
    kind = spark.read.parquet(path).schema
    stream = spark.readStream.schema(kind).parquet(path).withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    query = hourly_counts(stream).writeStream.outputMode("append").option("checkpointLocation", state).trigger(availableNow=True).format("parquet").option("path", out).start()
    query.awaitTermination()
    closed = spark.read.schema("hour timestamp_ntz, event_type string, n long").parquet(out)
    last = closed.agg(F.max("hour")).first()[0]
    rows = spark.read.parquet(path)
    still_open = rows if last is None else rows.where(F.date_trunc("hour", "ts") > F.lit(last))
    return closed.unionByName(hourly_counts(still_open))
