"""Catalog harvest: ``information_schema``-shaped rows to uniform column rows.

Inputs are DataFrames of any origin (JDBC, dumps, ``spark.catalog``).  Filters and
projections stay declarative, so they reach the source.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.times import utc_micros
from tessera.functions.text import matches_search
from tessera.schemas import CATALOG_TTL_SECONDS


def lower_columns(df: DataFrame) -> DataFrame:
    """Every result column name in lower case, so that engines agree."""
    return df.toDF(*[c.lower() for c in df.columns])


def _named(column: str) -> Column:
    return F.col(column).isNotNull() & (F.col(column) != "")


def list_schemas(schemata: DataFrame, search: str | None = None) -> DataFrame:
    return (
        schemata.where(_named("schema_name"))
        .where(matches_search(F.col("schema_name"), search))
        .select(F.col("schema_name").alias("name"))
        .orderBy("name")
    )


def list_tables(tables: DataFrame, schema: str, search: str | None = None) -> DataFrame:
    return (
        tables.where(F.col("table_schema") == schema)
        .where(_named("table_name"))
        .where(matches_search(F.col("table_name"), search))
        .select(
            F.col("table_name").alias("name"),
            F.upper(F.coalesce("table_type", F.lit(""))).alias("table_type"),
        )
        .orderBy("name")
    )


def is_nullable(flag: Column) -> Column:
    """Anything but NO counts as nullable, unknown included."""
    return F.coalesce(F.upper(flag) != "NO", F.lit(True))


def _column_fields() -> list[Column]:
    return [
        F.coalesce("column_name", F.lit("")).alias("name"),
        F.coalesce("data_type", F.lit("")).alias("data_type"),
        is_nullable(F.col("is_nullable")).alias("nullable"),
        F.coalesce(F.col("ordinal_position").cast("long"), F.lit(0).cast("long")).alias(
            "ordinal_position"
        ),
    ]


def list_columns(columns: DataFrame, schema: str, table: str, search: str | None = None) -> DataFrame:
    return (
        columns.where((F.col("table_schema") == schema) & (F.col("table_name") == table))
        .where(_named("column_name"))
        .where(matches_search(F.col("column_name"), search))
        .select(*_column_fields())
        .orderBy("ordinal_position")
    )


def live_columns(columns: DataFrame, *keep: str) -> DataFrame:
    """All harvested columns in uniform shape; ``keep`` names extra key columns."""
    return columns.where(_named("table_name") & _named("column_name")).select(
        *keep, "table_schema", "table_name", *_column_fields()
    )


def columns_for_requested(columns: DataFrame, requested: DataFrame) -> DataFrame:
    """Columns of the requested ``(table_schema, table_name)``; absent tables give one row.

    ``found`` tells the two apart; rows sort by ``ordinal_position``.  The large
    side is only filtered by a semi join, so a very wide table can be split.
    """
    key = ["table_schema", "table_name"]
    wanted = requested.select(*key).distinct()
    named = columns.where(_named("table_name"))
    hits = named.join(wanted, key, "left_semi").select(
        *key, *_column_fields(), F.lit(True).alias("found")
    )
    absent = wanted.join(named.select(*key).distinct(), key, "left_anti")
    return hits.unionByName(absent.withColumn("found", F.lit(False)), allowMissingColumns=True)


def split_stale(
    requested: DataFrame, fetched: DataFrame, keys: Sequence[str], now: Column,
    ttl_seconds: int = CATALOG_TTL_SECONDS,
) -> DataFrame:
    """Requested rows with ``stale``: never fetched, or fetched longer ago than the TTL.

    ``fetched`` has the keys and ``fetched_at``; the latest fetch counts.  Times without a
    zone are UTC.
    """
    latest = fetched.groupBy(*keys).agg(F.max("fetched_at").alias("fetched_at"))
    joined = requested.join(latest, list(keys), "left")
    age = utc_micros(joined, now) - utc_micros(joined, "fetched_at")
    return joined.withColumn("stale", F.coalesce(age > ttl_seconds * 1_000_000, F.lit(True)))


def browse(
    connections: DataFrame,
    schemata: DataFrame,
    tables: DataFrame,
    columns: DataFrame,
    connection: str | None = None,
    schema: str | None = None,
    table: str | None = None,
    search: str | None = None,
) -> DataFrame:
    """Drill down: connections, then schemas, tables and columns of one connection.

    The three catalog frames carry a ``connection`` column.
    """
    if connection is None:
        return connections.select(
            "name", "engine", "dsn", F.coalesce("catalog", F.lit("none")).alias("catalog")
        )
    here = F.col("connection") == connection
    if schema is None:
        return list_schemas(schemata.where(here), search)
    if table is None:
        return list_tables(tables.where(here), schema, search)
    return list_columns(columns.where(here), schema, table, search)


# Type families whose length or precision belongs to the type text.
_SIZED = ("char", "varchar", "nchar", "nvarchar", "binary", "varbinary")
_SCALED = ("decimal", "numeric")


def render_type(data_type: Column, length: Column, precision: Column, scale: Column) -> Column:
    """``varchar`` + 40 -> ``varchar(40)``; -1 is ``max``; ``decimal(p,s)`` with s = 0 if unknown."""
    size = F.when(length == -1, F.lit("max")).otherwise(length.cast("string"))
    digits = F.concat_ws(
        ",", precision.cast("string"), F.coalesce(scale, F.lit(0)).cast("string")
    )
    return (
        F.when(data_type.isin(*_SIZED) & length.isNotNull(), F.format_string("%s(%s)", data_type, size))
        .when(
            data_type.isin(*_SCALED) & precision.isNotNull(),
            F.format_string("%s(%s)", data_type, digits),
        )
        .otherwise(data_type)
    )


def preferred_type(full_type: Column, data_type: Column) -> Column:
    return F.coalesce(full_type, data_type)


def scalar_status(df: DataFrame) -> DataFrame:
    """First cell as text: one row ``(ok, value, reason, detail)``, never empty."""
    cell = df.select(F.col(df.columns[0]).cast("string").alias("v")).limit(1)
    read = cell.agg(F.count("*").alias("n"), F.max("v").alias("v"))
    reason = F.when(F.col("n") == 0, "no_rows").when(F.col("v").isNull(), "null_value")
    detail = F.when(F.col("n") == 0, "The query returned zero rows.").when(
        F.col("v").isNull(), "The scalar value came back NULL."
    )
    return read.select(
        reason.isNull().alias("ok"),
        F.coalesce("v", F.lit("")).alias("value"),
        F.coalesce(reason, F.lit("")).alias("reason"),
        F.coalesce(detail, F.lit("")).alias("detail"),
    )


def describe_tables(
    spark: SparkSession, frames: Mapping[str, DataFrame], schema: str = "default"
) -> DataFrame:
    """``information_schema.columns``-shaped rows of any readable sources; reads no data."""
    rows = [
        (schema, table, f.name, f.dataType.simpleString(), "YES" if f.nullable else "NO", i)
        for table, df in frames.items()
        for i, f in enumerate(df.schema.fields, start=1)
    ]
    return spark.createDataFrame(
        rows,
        "table_schema string, table_name string, column_name string, data_type string,"
        " is_nullable string, ordinal_position long",
    )
