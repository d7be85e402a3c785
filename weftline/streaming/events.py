"""Streaming over events: tumbling, sliding and session windows with watermarks. An extension; the batch forms are the same expressions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def window_totals(events: DataFrame, size: str, slide: str | None = None, late: str | None = None) -> DataFrame:
    """Count and sum of ``value`` per window and event type."""
    e = events.withWatermark("ts", late) if late else events
    w: Column = F.window("ts", size, slide) if slide else F.window("ts", size)
    return e.groupBy(w.alias("w"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select(F.col("w.start").alias("start"), F.col("w.end").alias("end"), "event_type", "n", "total")


def session_totals(events: DataFrame, gap: str, late: str | None = None) -> DataFrame:
    """Sessions per user: stretches without a pause of ``gap``."""
    e = events.withWatermark("ts", late) if late else events
    return e.groupBy(F.session_window("ts", gap).alias("w"), "user_id").agg(F.count(F.lit(1)).alias("n"), F.sum("value").alias("total")).select("user_id", F.col("w.start").alias("start"), F.col("w.end").alias("end"), "n", "total")


def run_available(spark: SparkSession, folder: str, schema, transform, out: str, checkpoint: str) -> DataFrame:
    """Run ``transform`` over the files of ``folder`` as a stream until they are used up, appending to ``out``."""
    s = spark.readStream.schema(schema).parquet(folder)
    q = transform(s).writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.read.parquet(out)
