"""Project documents: one JSON file per project, one row per file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import schemas
from tessera.sources.checkpoints import working_folder
from tessera.sources.corpus import decoded_path

_CORRUPT = "_corrupt_record"
_READ_AS = T.StructType([*schemas.DOCUMENT.fields, T.StructField(_CORRUPT, T.StringType())])


def parse_projects(files: DataFrame) -> DataFrame:
    """``(file, content)`` -> ``(project_id, content, doc, ok)``.

    Unknown fields are dropped, absent ones are null.  Text that is no document
    gives ``ok = false``; it never fails the job.
    """
    doc = F.from_json(
        "content", _READ_AS, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": _CORRUPT}
    )
    return (
        files.withColumn("_doc", doc)
        .select(
            F.element_at(F.split("file", "/"), -1).alias("project_id"),
            "content",
            F.struct(*[F.col(f"_doc.{f.name}") for f in schemas.DOCUMENT.fields]).alias("doc"),
            (
                F.col("_doc").isNotNull()
                & F.col(f"_doc.{_CORRUPT}").isNull()
                & F.col("_doc.project").isNotNull()
            ).alias("ok"),
        )
    )


def parsed_once(parsed: DataFrame) -> DataFrame:
    """The parsed documents as a table in the shared folder: what is read from it reads columns, not JSON."""
    path = working_folder(parsed.sparkSession, "parsed-projects")
    parsed.write.parquet(path)
    return parsed.sparkSession.read.parquet(path)


def read_projects(spark: SparkSession, folder: str, suffix: str = ".json") -> DataFrame:
    """Documents directly in ``folder`` whose name ends in ``suffix``."""
    files = (
        spark.read.option("wholetext", True)
        .option("pathGlobFilter", f"*{suffix}")
        .text(folder)
        .select(
            decoded_path(F.col("_metadata.file_path")).alias("file"),
            F.make_valid_utf8("value").alias("content"),
        )
    )
    return parse_projects(files)


def list_projects(parsed: DataFrame) -> DataFrame:
    """``(file, name, updated_at)``, sorted by file; a broken file is listed as such."""
    name = F.when(F.col("ok"), F.nullif("doc.project.name", F.lit("")))
    return parsed.select(
        F.col("project_id").alias("file"),
        F.coalesce(name, F.lit("<unparseable>")).alias("name"),
        F.coalesce(F.when(F.col("ok"), F.col("doc.updated_at")), F.lit("")).alias("updated_at"),
    ).orderBy("file")


def raw_documents(parsed: DataFrame) -> DataFrame:
    """The text as stored, readable or not."""
    return parsed.select("project_id", "ok", "content")
