"""Incremental ingestion as a stream: new files or rows go through the batch operators, each micro-batch once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def stream_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A folder of Parquet files as a stream."""
    return spark.readStream.schema(schema).parquet(path)


def drop_repeats(stream: DataFrame, keys: list[str], time: str, delay: str) -> DataFrame:
    """Rows whose keys came before within the watermark go; state stays bounded."""
    return stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, time: str, keys: list[str], width: str, delay: str) -> DataFrame:
    """Counts by event-time window; late rows past the watermark are left out."""
    s = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, delay)
    return s.groupBy(F.window(time, width).alias("w"), *keys).agg(F.count("*").alias("n")).select(F.col("w.start").alias("start"), *keys, "n")


def ingest(stream: DataFrame, transform: Callable[[DataFrame], DataFrame], out: str, checkpoint: str) -> StreamingQuery:
    """All that is there now, in micro-batches: each batch is transformed and replaces its own folder, so that a repeat after a failure changes nothing."""
    def write(batch: DataFrame, number: int) -> None:
        transform(batch).write.mode("overwrite").parquet(f"{out}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
