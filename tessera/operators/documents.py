"""Project documents flattened to tables, lookups and lineage."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.schemas import DEFAULTS


def _defaulted(row: Column, fields: list[str], entity: str) -> list[Column]:
    defaults = DEFAULTS.get(entity, {})
    return [
        (F.coalesce(row[f], F.lit(defaults[f])) if f in defaults else row[f]).alias(f)
        for f in fields
    ]


def _field_names(df: DataFrame, path: str) -> list[str]:
    dtype = df.schema
    for part in path.split("."):
        dtype = dtype[part].dataType
        dtype = getattr(dtype, "elementType", dtype)
    return dtype.fieldNames()


def flatten(parsed: DataFrame) -> dict[str, DataFrame]:
    """The relational tables behind the readable documents.

    Keys: projects, connections, tables, columns, relationships, upstream,
    glossary, measures.  ``pos`` keeps the order inside the document.  Every table
    is a projection of the scan; unused branches of the JSON are never parsed out.
    """
    docs = parsed.where("ok")
    doc = F.col("doc")

    def names(path: str) -> list[str]:
        return _field_names(docs, path)

    def listed(path: str, entity: str) -> DataFrame:
        return docs.select("project_id", F.posexplode(f"doc.{path}").alias("pos", "_r")).select(
            "project_id", "pos", *_defaulted(F.col("_r"), names(f"doc.{path}"), entity)
        )

    def of_table(field: str) -> DataFrame:
        rows = docs.select("project_id", F.explode("doc.tables").alias("_t")).select(
            "project_id",
            F.col("_t.table_name").alias("table_name"),
            F.posexplode(f"_t.{field}").alias("pos", "_r"),
        )
        return rows.select(
            "project_id",
            "table_name",
            "pos",
            *_defaulted(F.col("_r"), names(f"doc.tables.{field}"), field),
        )

    project_fields = [f for f in names("doc.project") if f not in ("glossary", "measures")]
    tables = listed("tables", "tables")
    return {
        "projects": docs.select(
            "project_id",
            F.coalesce(doc["schema_version"], F.lit(1)).alias("schema_version"),
            doc["updated_at"].alias("updated_at"),
            *_defaulted(doc["project"], project_fields, "project"),
        ),
        "connections": listed("connections", "connections"),
        "tables": tables.drop("columns", "relationships", "upstream"),
        "columns": of_table("columns"),
        "relationships": of_table("relationships"),
        "upstream": of_table("upstream"),
        "glossary": listed("project.glossary", "glossary"),
        "measures": listed("project.measures", "measures"),
    }


def find(rows: DataFrame, key: str, value: str) -> DataFrame:
    """First row per project whose ``key`` is exactly ``value``."""
    rest = [c for c in rows.columns if c != "project_id"]
    return (
        rows.where(F.col(key) == value)
        .groupBy("project_id")
        .agg(F.min_by(F.struct(*rest), "pos").alias("_r"))
        .select("project_id", "_r.*")
    )


def downstream(upstream: DataFrame, tables: DataFrame) -> DataFrame:
    """Lineage read backwards, one hop: ``(project_id, ref, pos, table_name)``.

    One row per edge, in table order by ``pos``.  A source that feeds everything
    stays spread out: nothing is gathered per ``ref``.
    """
    order = tables.select("project_id", "table_name", F.col("pos").alias("table_pos"))
    return upstream.join(order, ["project_id", "table_name"]).select(
        "project_id", "ref", "table_pos", "pos", "table_name"
    )


def downstream_counts(upstream: DataFrame) -> DataFrame:
    """How many tables read each source directly."""
    return upstream.groupBy("project_id", "ref").agg(
        F.count("*").alias("n_declared"), F.min("table_name").alias("first_table")
    )
