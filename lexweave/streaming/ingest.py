"""Structured Streaming ingest: windowed event counts and deduplicated documents."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as S

from lexweave.functions import text as T

EVENTS = S.StructType([S.StructField("event_id", S.LongType()), S.StructField("ts", S.TimestampNTZType()), S.StructField("user_id", S.LongType()), S.StructField("event_type", S.StringType()), S.StructField("value", S.DoubleType()), S.StructField("props", S.StringType())])


def stream(spark: SparkSession, path: str, schema: S.StructType, files: int = 10) -> DataFrame:
    """Parquet files as they arrive, some a batch."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files).parquet(path)


def windowed(events: DataFrame, late: str = "10 minutes", width: str = "5 minutes") -> DataFrame:
    """Counts and sums by event type and window; windows close once the watermark passes them."""
    e = events.withColumn("ts", F.col("ts").cast("timestamp")).withWatermark("ts", late)
    return e.groupBy(F.window("ts", width), "event_type").agg(F.count("*").alias("events"), F.sum("value").alias("value"))


def first_seen(documents: DataFrame, text: str, time: str, late: str = "1 hour") -> DataFrame:
    """Documents whose folded text none within the watermark had before; state holds digests alone."""
    keyed = documents.withColumn("text_key", F.sha2(T.folded(text).cast("binary"), 256))
    return keyed.withWatermark(time, late).dropDuplicatesWithinWatermark(["text_key"])
