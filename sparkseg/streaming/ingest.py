"""Segments that keep arriving: read once, counted as they come."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from sparkseg.functions.columns import millis


def arriving(spark: SparkSession, folder: str, schema: T.StructType, files: int | None = None) -> DataFrame:
    """Segments from the Parquet files of a folder, as a stream."""
    reader = spark.readStream.schema(schema)
    return (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(folder)


def once(stream: DataFrame, late: str = "30 days") -> DataFrame:
    """The stream without redelivered segments; one that comes again later than ``late`` counts anew.

    Bounded state: ids are kept for as long as the watermark says.
    """
    return stream.withColumn("at", F.col("ingested_at").cast("timestamp")).withWatermark("at", late).dropDuplicatesWithinWatermark(["seg_id"])


def speech_by_window(stream: DataFrame, window: str = "1 hour", late: str = "1 day") -> DataFrame:
    """Segments and seconds that arrived in each window of time and recording."""
    timed = stream.withColumn("ms", millis("`end`") - millis("`start`")).where("ms > 0").withColumn("at", F.col("ingested_at").cast("timestamp"))
    return timed.withWatermark("at", late).groupBy(F.window("at", window).alias("w"), "rec_id").agg(F.count("*").alias("segments"), (F.sum("ms") / 1000).alias("seconds")).select(F.col("w.start").alias("from"), "rec_id", "segments", "seconds")


def append_to(stream: DataFrame, table: str, checkpoint: str, each: Callable[[DataFrame, int], DataFrame] | None = None) -> StreamingQuery:
    """All that has arrived appended to a Parquet table, each batch once.

    A batch is a folder of the table, named by its number and overwritten when it is tried again.
    """

    def write(batch: DataFrame, number: int) -> None:
        (each(batch, number) if each else batch).write.mode("overwrite").parquet(f"{table}/batch={number}")

    return stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
