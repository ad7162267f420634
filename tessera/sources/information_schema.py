"""Catalog frames read over JDBC or from Spark's own catalog."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators.catalog import describe_tables, lower_columns


def read_jdbc(
    spark: SparkSession,
    url: str,
    view: str,
    catalog: str | None = None,
    options: Mapping[str, str] | None = None,
) -> DataFrame:
    """``information_schema.<view>`` (schemata, tables or columns) as a lazy DataFrame.

    Filters put on the result are pushed into the database.
    """
    name = ".".join(p for p in (catalog, "information_schema", view) if p)
    reader = spark.read.format("jdbc").options(url=url, dbtable=name, **(options or {}))
    return lower_columns(reader.load())


def spark_catalog_columns(spark: SparkSession, database: str) -> DataFrame:
    """The same shape for the tables of a Spark database; reads schemas only."""
    frames = {
        t.name: spark.table(f"`{database}`.`{t.name}`") for t in spark.catalog.listTables(database)
        if not t.isTemporary
    }
    return describe_tables(spark, frames, database)


def with_connection(df: DataFrame, connection: str) -> DataFrame:
    """Harvests of several connections can be put together once each row says whose it is."""
    return df.withColumn("connection", F.lit(connection))
