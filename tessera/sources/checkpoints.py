"""Reliable storage every executor can read again: cut lineage, working folders."""

from __future__ import annotations

import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def shared_root(spark: SparkSession) -> str:
    """The folder named in ``spark.checkpoint.dir``.

    Where none is named, a session whose executors are this process, as in tests, takes a
    temporary one; on a cluster, whose executors could not all reach that, it is an error.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named
    if not re.fullmatch(r"local(\[.*\])?", spark.sparkContext.master):
        raise RuntimeError("spark.checkpoint.dir must name a folder that all executors share")
    return tempfile.mkdtemp(prefix="tessera-")


def working_folder(spark: SparkSession, purpose: str) -> str:
    """A new path below the shared folder."""
    return f"{shared_root(spark).rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def checkpointed(df: DataFrame) -> DataFrame:
    """The rows computed once; nothing is lost with an executor."""
    spark = df.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_root(spark))
    return df.checkpoint()


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The rows computed once, as a table in the shared folder; its size is known to later joins."""
    path = working_folder(df.sparkSession, purpose)
    df.write.parquet(path)
    return df.sparkSession.read.parquet(path)
