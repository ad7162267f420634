"""The project document as Spark types, and its rules as data."""

from __future__ import annotations

from pyspark.sql import types as T


def _struct(*fields: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields])


S, B, L = T.StringType(), T.BooleanType(), T.LongType()
TEXTS = T.ArrayType(S)

COLUMN = _struct(
    ("name", S), ("type", S), ("nullable", B), ("is_primary_key", B), ("is_foreign_key", B),
    ("description", S), ("classification", S), ("quality_notes", S), ("computed", B),
    ("expression", S), ("example_values", TEXTS),
)
RELATIONSHIP = _struct(
    ("to_table", S), ("from_columns", TEXTS), ("to_columns", TEXTS), ("cardinality", S),
    ("description", S),
)
DEPENDENCY = _struct(("ref", S), ("description", S))
SCD = _struct(("type", S), ("valid_from", S), ("valid_to", S), ("is_current_flag", S))
TERM = _struct(("term", S), ("definition", S))
MEASURE = _struct(("name", S), ("definition", S), ("formula", S), ("owner", S))
CONNECTION = _struct(
    ("name", S), ("engine", S), ("dsn", S), ("catalog", S), ("default_schema", S),
    ("description", S), ("tags", TEXTS),
)
TABLE = _struct(
    ("table_name", S), ("source_file", S), ("connection", S), ("paradigm_role", S),
    ("description", S), ("grain", S), ("tags", TEXTS), ("aliases", TEXTS), ("pitfalls", TEXTS),
    ("owner", S), ("refresh_cadence", S), ("refresh_notes", S), ("scd", SCD),
    ("columns", T.ArrayType(COLUMN)), ("primary_keys", TEXTS),
    ("relationships", T.ArrayType(RELATIONSHIP)), ("upstream", T.ArrayType(DEPENDENCY)),
    ("ddl_only", B), ("staging_target", S), ("columns_from", S), ("db_kind", S),
    ("row_count_last_run", L), ("last_run_at", S),
)
PROJECT = _struct(
    ("name", S), ("modeling_paradigm", S), ("dialect", S), ("default_connection", S),
    ("description", S), ("tags", TEXTS), ("included_files", TEXTS), ("excluded_files", TEXTS),
    ("conventions", S), ("glossary", T.ArrayType(TERM)), ("measures", T.ArrayType(MEASURE)),
)
DOCUMENT = _struct(
    ("schema_version", T.IntegerType()), ("updated_at", S), ("project", PROJECT),
    ("connections", T.ArrayType(CONNECTION)), ("tables", T.ArrayType(TABLE)),
)

# What an absent field stands for ("" / false / true / a word).
DEFAULTS = {
    "project": {"modeling_paradigm": "unspecified", "dialect": "tsql", "description": "", "conventions": ""},
    "connections": {"description": ""},
    "tables": {"paradigm_role": "", "description": "", "refresh_cadence": "unknown", "ddl_only": False},
    "columns": {
        "type": "", "nullable": True, "is_primary_key": False, "is_foreign_key": False,
        "classification": "unspecified", "computed": False,
    },
}

# The allowed words.
ENGINES = ("trino", "sql_server", "databricks")
CARDINALITIES = ("one_to_one", "one_to_many", "many_to_many")
PARADIGMS = ("star", "snowflake", "parent_child", "unspecified")
CADENCES = ("unknown", "realtime", "minutes", "hourly", "daily", "weekly", "monthly", "adhoc")
CLASSIFICATIONS = ("unspecified", "public", "internal", "pii", "phi", "restricted")
SCD_TYPES = ("none", "scd1", "scd2", "snapshot")
COLUMN_ORIGINS = ("information_schema", "sqlglot")
DB_KINDS = ("table", "view")

# Longest text per field, in characters.
MAX_LENGTH = {
    "projects": {"name": 120, "description": 20_000, "conventions": 8_000},
    "connections": {"description": 4_000},
    "tables": {
        "paradigm_role": 60, "description": 8_000, "grain": 240, "owner": 240, "refresh_notes": 500,
    },
    "columns": {"description": 500, "quality_notes": 240, "expression": 1_000},
    "relationships": {"description": 500},
    "glossary": {"term": 120, "definition": 1_000},
    "measures": {"name": 120, "definition": 1_000, "formula": 2_000, "owner": 240},
}
# Limits that are documented but that the document model lets through.
DOCUMENTED_MAX_LENGTH = {"connections": {"name": 60}, "upstream": {"description": 500}}
PITFALL_MAX = 240
GRAIN_MAX = 240

# Fields that must be there; those of REQUIRED_TEXT may not be ''.
REQUIRED = {
    "connections": ("name", "engine", "dsn"),
    "relationships": ("to_table", "cardinality"),
    "upstream": ("ref",),
}
REQUIRED_TEXT = {
    "projects": ("name",),
    "tables": ("table_name",),
    "columns": ("name",),
    "glossary": ("term", "definition"),
    "measures": ("name", "definition"),
}
ENUMS = {
    "projects": {"modeling_paradigm": PARADIGMS},
    "connections": {"engine": ENGINES},
    "tables": {
        "refresh_cadence": CADENCES, "columns_from": COLUMN_ORIGINS, "db_kind": DB_KINDS,
        "scd_type": SCD_TYPES,
    },
    "columns": {"classification": CLASSIFICATIONS},
    "relationships": {"cardinality": CARDINALITIES},
}
#: enum fields that may not be null
ENUM_NOT_NULL = {"modeling_paradigm", "engine", "refresh_cadence", "scd_type", "classification", "cardinality"}

# What a patch may touch, and which of these accept null.
TABLE_PATCH_FIELDS = (
    "connection", "description", "grain", "tags", "aliases", "pitfalls", "owner",
    "refresh_cadence", "refresh_notes", "scd", "columns", "primary_keys", "relationships",
    "upstream", "ddl_only", "staging_target", "columns_from", "db_kind", "row_count_last_run",
    "last_run_at", "paradigm_role",
)
TABLE_IDENTITY_FIELDS = ("table_name", "source_file")
TABLE_NULLABLE_FIELDS = (
    "connection", "grain", "owner", "refresh_notes", "staging_target", "columns_from", "db_kind",
    "row_count_last_run", "last_run_at",
)
CONFIG_PATCH_FIELDS = (
    "name", "description", "conventions", "dialect", "default_connection", "modeling_paradigm", "tags",
)
CONFIG_NULLABLE_FIELDS = ("default_connection",)

# Fixed value: seconds a catalog answer stays fresh.
CATALOG_TTL_SECONDS = 300
