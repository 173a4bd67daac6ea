"""Landed files as a stream.

Polling for new records becomes a file source with an ``availableNow`` trigger; resuming becomes
the stream's checkpoint. Watermarked deduplication and event-time windows go beyond the batch jobs.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citeloom.operators import runs


def landed_stream(spark: SparkSession, folder: str, schema: str, files_per_batch: int | None = None) -> DataFrame:
    """JSON lines that land in a folder."""
    reader = spark.readStream.schema(schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.json(folder)


def upsert_stream(stream: DataFrame, table: str, checkpoint: str, keys: Sequence[str], version: Sequence[str]) -> None:
    """Merge what has landed into a parquet table, the greatest version of a key winning; runs until all is read.

    Each micro-batch is written under its number, so one that is repeated after a failure replaces
    itself; readers take the latest version over the parts with ``read_upserted``.
    """

    def merge(batch: DataFrame, batch_id: int) -> None:
        runs.latest(batch, keys, version).write.mode("overwrite").parquet(f"{table}/batch={batch_id}")

    stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()


def read_upserted(spark: SparkSession, table: str, keys: Sequence[str], version: Sequence[str]) -> DataFrame:
    rows = spark.read.parquet(table)
    return runs.latest(rows.drop("batch"), keys, version)


def first_deliveries(stream: DataFrame, keys: Sequence[str], event_time: str, delay: str = "7 days") -> DataFrame:
    """The first delivery of each key; state is dropped once the watermark has passed ``delay``."""
    return stream.withWatermark(event_time, delay).dropDuplicatesWithinWatermark(list(keys))


def windowed_counts(stream: DataFrame, event_time: str, by: Sequence[str], width: str = "1 hour", delay: str = "7 days") -> DataFrame:
    """Counts per event-time window and key; rows later than ``delay`` are left out."""
    return stream.withWatermark(event_time, delay).groupBy(F.window(event_time, width), *by).agg(F.count(F.lit(1)).alias("row_count"))


def pass_or_block(results: DataFrame, keys: Sequence[str], order: str) -> DataFrame:
    """A micro-batch of task results up to its first blocked one, for use inside ``foreachBatch``."""
    return runs.until_first_blocked(results.withColumn("_all", F.lit(1)), ["_all"], [order, *keys]).drop("_all")
