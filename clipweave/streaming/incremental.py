"""Incremental steps over a growing folder, by Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from clipweave.session import ship


def watch_folder(spark: SparkSession, source: str, schema: StructType, step: Callable[[DataFrame, int], None], checkpoint: str, *, kind: str = "parquet", files_at_once: int = 1000, once: bool = True, every: str = "60 seconds") -> StreamingQuery:
    """Run `step(batch, number)` over the files that are new since the last run; the checkpoint is the ledger.

    With `once` the query ends when nothing is left, else it looks again `every` so often. A step that fails is run
    again with the same files, so it should write by its batch number.
    """
    ship(spark)
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_at_once).format(kind).load(source)
    writer = stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    return (writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start()


def first_deliveries(stream: DataFrame, *, key: str = "id", time: str = "ingested_at", late: str = "1 day") -> DataFrame:
    """Each key once within the time it may come late; state older than that is dropped."""
    return stream.withWatermark(time, late).dropDuplicatesWithinWatermark([key])


def windowed_counts(stream: DataFrame, *, time: str, group: str, width: str = "1 hour", late: str = "10 minutes") -> DataFrame:
    """(group, start, n) of tumbling windows, closed when the watermark passes them."""
    # Watermarks want time stamps with a zone.
    zoned = stream.withColumn(time, F.col(time).cast("timestamp")).withWatermark(time, late)
    return zoned.groupBy(F.window(time, width).alias("w"), group).agg(F.count("*").alias("n")).select(group, F.col("w.start").alias("start"), "n")
