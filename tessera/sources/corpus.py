"""SQL text files as a ``(file, sql)`` DataFrame, and the edge store."""

from __future__ import annotations

import re
from collections.abc import Sequence
from datetime import datetime

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Directories that never hold project SQL.
IGNORED_DIRECTORIES = (
    ".git", ".svn", ".hg", ".idea", ".vscode", "node_modules", "venv", ".venv",
    "__pycache__", "target", "build", "dist",
)


def in_ignored_directory(file: Column, also_ignored: Sequence[str] = ()) -> Column:
    names = F.array(*[F.lit(n) for n in (*IGNORED_DIRECTORIES, *also_ignored)])
    parts = F.split(file, "/")
    return F.arrays_overlap(F.slice(parts, F.lit(1), F.size(parts) - 1), names)


def visible(corpus: DataFrame, also_ignored: Sequence[str] = ()) -> DataFrame:
    """Corpus rows whose path leads through no ignored directory."""
    return corpus.where(~in_ignored_directory(F.col("file"), also_ignored))


def decoded_path(path: Column) -> Column:
    """File paths come as URIs; a plus sign in them is a plus sign."""
    return F.url_decode(F.replace(path, F.lit("+"), F.lit("%2B")))


def _qualified(spark: SparkSession, root: str) -> str:
    """The path of a folder as the scan will show it; patterns have no relative paths."""
    if re.search(r"[*?\[{]", root):
        raise ValueError(f"{root!r} is a pattern: paths below it would have no common root")
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(root)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.makeQualified(path).toUri().getPath().rstrip("/") + "/"


def _relative(base: str) -> Column:
    path = decoded_path(F.col("_metadata.file_path"))
    return F.substring(path, F.locate(base, path) + F.lit(len(base)), F.length(path)).alias("file")


def read_sql_corpus(
    spark: SparkSession, root: str, also_ignored: Sequence[str] = (), modified_after: datetime | None = None
) -> DataFrame:
    """``(file, sql)`` of every ``.sql`` file below the folder ``root``, suffix in any case.

    Paths are relative to ``root``; bytes that are no UTF-8 become U+FFFD.  ``modified_after``, a time
    in UTC, leaves out files that are no newer, before they are read.
    """
    base = _qualified(spark, root)
    reader = (
        spark.read.option("wholetext", True)
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.[sS][qQ][lL]")
    )
    if modified_after is not None:
        reader = reader.options(modifiedAfter=modified_after.strftime("%Y-%m-%dT%H:%M:%S"), timeZone="UTC")
    raw = reader.text(root).select(_relative(base), F.make_valid_utf8("value").alias("sql"))
    return visible(raw, also_ignored)


def list_sql_corpus(spark: SparkSession, root: str, also_ignored: Sequence[str] = ()) -> DataFrame:
    """``(file, length, modified)`` of the same files, from the listing: no text is read.

    ``modified`` is in microseconds; files without a byte are not listed.
    """
    base = _qualified(spark, root)
    listed = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", "*.[sS][qQ][lL]")
        .load(root)
        .select(_relative(base), "length", F.unix_micros("modificationTime").alias("modified"))
    )
    return visible(listed, also_ignored)


def write_edge_store(edges_by_table: DataFrame, path: str, buckets: int = 64, fmt: str = "parquet") -> None:
    """One directory per hash bucket of the table key; readers prune by bucket."""
    (
        edges_by_table.withColumn("bucket", table_bucket(F.col("table_key"), buckets))
        .write.mode("overwrite")
        .partitionBy("bucket")
        .format(fmt)
        .save(path)
    )


def table_bucket(table_key: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(table_key), F.lit(buckets)).cast("int")


def read_edges_of(spark: SparkSession, path: str, schema: str | None, table: str, buckets: int = 64) -> DataFrame:
    """Edges with ``schema.table`` at either end: reads one bucket of a parquet store."""
    key = F.lit(f"{(schema or '').lower()}.{table.lower()}")
    return spark.read.parquet(path).where(
        (F.col("bucket") == table_bucket(key, buckets)) & (F.col("table_key") == key)
    )
