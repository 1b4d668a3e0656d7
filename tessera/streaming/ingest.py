"""Incremental ingest: new cell tables of a folder are normalised as a stream and appended once each."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import canonical


def cell_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int = 100) -> DataFrame:
    stream = spark.readStream.schema(schema).option("header", True).option("maxFilesPerTrigger", files_per_batch).csv(folder)
    return canonical(stream)


def ingest(stream: DataFrame, out: str, checkpoint: str):
    """Write what is new as Parquet and stop; running again takes only newer files."""
    query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def windowed_counts(events: DataFrame, time: str, key: str, width: str = "5 minutes", late: str = "10 minutes") -> DataFrame:
    """Counts by key and window of event time; rows later than `late` are dropped by the watermark."""
    timed = events.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return timed.groupBy(F.window(time, width), key).agg(F.count(F.lit(1)).alias("n")).select(F.col("window.start").alias("start"), key, "n")
