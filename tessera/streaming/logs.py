"""Query logs as streams: parsed lines and failure counts per time bucket."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.querylog import failure_rollup, parse_log


def read_log_stream(spark: SparkSession, path: str, files_per_batch: int = 1000) -> DataFrame:
    """Parsed rows of log files as they arrive; lines of another form are left out."""
    raw = spark.readStream.option("maxFilesPerTrigger", files_per_batch).text(path)
    return parse_log(raw, "value")


def failure_counts(events: DataFrame, bucket: str = "1 hour", lateness: str = "2 hours") -> DataFrame:
    """Reads per bucket, source and reason; a bucket is final once the watermark has passed it."""
    timed = events.withColumn("event_time", F.col("event_time").cast("timestamp"))
    return failure_rollup(timed.withWatermark("event_time", lateness), bucket)
