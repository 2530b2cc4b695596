"""Incremental ingest: a file stream that resumes where it stopped, with state for what was already seen."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusforge.functions import text as T


def files_arriving(spark: SparkSession, path: str, schema: StructType, per_trigger: int = 20) -> DataFrame:
    """Parquet files as they arrive, so many a micro-batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", per_trigger).parquet(path)


def first_seen(stream: DataFrame, key: str, event_time: str, lateness: str | None = None) -> DataFrame:
    """Each key once, however late it comes: the state keeps every key (on a cluster, in a state store on disk).

    With ``lateness`` the state of a key is dropped that long after its event time, and rows later than that are lost.
    """
    if lateness is None:
        return stream.dropDuplicates([key])
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, lateness).dropDuplicatesWithinWatermark([key])


def clean(stream: DataFrame, text: str = "text") -> DataFrame:
    return stream.where(~T.is_blank(F.col(text))).withColumn(text, T.strip(F.col(text)))


def windowed_counts(stream: DataFrame, event_time: str, by: str, width: str = "1 day", lateness: str = "2 days") -> DataFrame:
    """Rows per event-time window and group; a window is final when the watermark passes it."""
    return stream.withColumn(event_time, F.col(event_time).cast("timestamp")).withWatermark(event_time, lateness).groupBy(F.window(event_time, width).alias("w"), by).agg(F.count("*").alias("n")).select(F.col("w.start").cast("timestamp_ntz").alias("start"), by, "n")


def run_available(stream: DataFrame, out: str, checkpoint: str) -> None:
    """Process what has arrived, then stop; a second call takes only what is new."""
    stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
