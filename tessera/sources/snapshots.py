"""States and logs as files.

Each write goes to a path of its own, so a repeated task or batch overwrites its
own attempt and readers never see a half-written state.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def snapshot_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/version={version}"


def write_snapshot(df: DataFrame, root: str, version: int, fmt: str = "parquet") -> None:
    df.write.mode("overwrite").format(fmt).save(snapshot_path(root, version))


def read_snapshot(spark: SparkSession, root: str, version: int, fmt: str = "parquet") -> DataFrame:
    return spark.read.format(fmt).load(snapshot_path(root, version))


def write_log(lines: DataFrame, path: str, day: str = "day") -> None:
    """Log lines as text below one directory per day."""
    lines.select(day, F.col("line").alias("value")).write.mode("append").partitionBy(day).text(path)
