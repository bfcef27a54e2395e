"""Streams: documents as they arrive, each once, and windowed counts with late data."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery


def read(spark: SparkSession, folder: str, schema: str, fmt: str = "parquet", files_at_once: int = 100) -> DataFrame:
    """New files of a folder; a bound on files a batch keeps memory even."""
    return spark.readStream.schema(schema).format(fmt).option("maxFilesPerTrigger", files_at_once).load(folder)


def first_arrivals(stream: DataFrame, keys: list[str], event_time: str, lateness: str = "1 day") -> DataFrame:
    """Rows whose keys weren't seen within the watermark; state older than that is dropped."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    return timed.withWatermark(event_time, lateness).dropDuplicatesWithinWatermark(keys)


def windowed_counts(stream: DataFrame, event_time: str, key: str, value: str, window: str = "1 hour", lateness: str = "10 minutes") -> DataFrame:
    """Rows and sum of ``value`` by window and key. Runs on streams and on batches alike."""
    timed = stream.withColumn(event_time, F.col(event_time).cast("timestamp"))
    if timed.isStreaming:
        timed = timed.withWatermark(event_time, lateness)
    return timed.groupBy(F.window(event_time, window).alias("w"), key).agg(F.count(F.lit(1)).alias("n"), F.sum(value).alias("total")).select(F.col("w.start").alias("window_start"), key, "n", "total")


def run_once(df: DataFrame, name: str, checkpoint: str, mode: str = "complete") -> StreamingQuery:
    """Everything that is there now, into a memory table."""
    query = df.writeStream.format("memory").queryName(name).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def run_to_table(df: DataFrame, path: str, checkpoint: str, mode: str = "complete") -> DataFrame:
    """Everything that is there now, into a Parquet table that the executors write; ``complete`` replaces it each batch.

    A batch that is written again after a failure replaces its own folder, so that no row counts twice.
    """

    def write(batch: DataFrame, number: int) -> None:
        batch.write.mode("overwrite").parquet(path if mode == "complete" else f"{path}/batch={number}")

    query = df.writeStream.foreachBatch(write).outputMode(mode).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    found = df.sparkSession.read.schema(df.schema).parquet(path)
    return found.select(*df.columns)
