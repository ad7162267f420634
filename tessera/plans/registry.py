"""Named queries with the SQL that states the same result."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None) -> Callable[[Query], Query]:
    """Register a query under its function name; ``sql`` is None where SQL cannot say it."""

    def register(fn: Query) -> Query:
        QUERIES[fn.__name__] = fn
        if sql is not None:
            SQL[fn.__name__] = sql
        return fn

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def dealt(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Narrow fixture rows dealt out by key before long texts are made from them, at any size."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return df.repartition(n, *keys)


def text(column: str | Column, name: str | None = None) -> Column:
    """Value as text with null as '', so that results compare across engines."""
    c = F.col(column) if isinstance(column, str) else column
    return F.coalesce(c.cast("string"), F.lit("")).alias(name or column)
