"""Event tables kept current by Structured Streaming over landed files.

Each micro-batch is deduplicated and merged into the days that it touches. A batch that runs again after a failure
merges to the same rows, so the checkpoint and the merge together apply every event once.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..operators.latest import latest_by
from ..operators.upsert import upsert
from ..sources.groups import Table


def event_stream(spark: SparkSession, folder: str, schema: T.StructType, files_per_batch: int = 1000) -> DataFrame:
    """Rows of files as they land in the partitions of a table."""
    return spark.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", files_per_batch).option("pathGlobFilter", "part-*").parquet(folder)


def apply_stream(stream: DataFrame, table: Table, path: str, checkpoint: str, order: str = "_ingest_ts", continuous: bool = False) -> StreamingQuery:
    """Merge a stream of events into a table by its keys and day; without continuous, all that is there, then an end."""

    def merge(batch: DataFrame, number: int) -> None:
        rows = batch.withColumn("event_date", F.to_date(table.event_date)).where("event_date is not null")
        rows = latest_by(rows, [*table.keys, "event_date"], [order], [c for c in rows.columns if c not in {*table.keys, order, "event_date"}])
        upsert(batch.sparkSession, rows, path, [*table.keys], "event_date", strict=False)

    writer = stream.writeStream.foreachBatch(merge).option("checkpointLocation", checkpoint)
    return (writer.trigger(processingTime="1 minute") if continuous else writer.trigger(availableNow=True)).start()


def windowed_counts(stream: DataFrame, at: str, kind: str, width: str = "1 hour", late: str = "2 days") -> DataFrame:
    """Events of each kind in each window of time; events later than the watermark are left out."""
    counted = stream.withWatermark(at, late).groupBy(F.window(at, width), kind).agg(F.count("*").alias("events"))
    return counted.select(F.col("window.start").alias("window_start"), kind, "events")
