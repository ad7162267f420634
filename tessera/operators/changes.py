"""Batches of metadata changes applied to metadata tables.

State tables carry ``project_id`` and ``pos``; change rows carry ``project_id`` and
``seq``, and several changes of one key apply in ``seq`` order.  Every operator
returns the next state and one outcome row per change, so nothing is lost silently.

Order without numbering: state rows keep ``pos``, appended rows take their ``seq``
with ``appended = true``; ordering by ``(appended, pos)`` is document order.  Dense
numbers would need a sort of each whole project in one task.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera import schemas
from tessera.functions.text import is_blank, strip

ORDER = ("appended", "pos")


def as_state(df: DataFrame) -> DataFrame:
    """A flattened document table as the first state."""
    return df if "appended" in df.columns else df.withColumn("appended", F.lit(False))


def judge(changes: DataFrame, *rules: tuple[Column, str]) -> DataFrame:
    """``problem``: text of the first rule whose condition holds, null for a good change."""
    problem = F.lit(None).cast("string")
    for condition, text in reversed(rules):
        problem = F.when(F.coalesce(condition, F.lit(True)), text).otherwise(problem)
    return changes.withColumn("problem", problem)


def require_known(
    changes: DataFrame, known: DataFrame, keys: Sequence[str], text: str
) -> DataFrame:
    """Mark changes whose key is not in ``known`` (unless they have a problem already)."""
    there = known.select(*keys).distinct().withColumn("_known", F.lit(True))
    return (
        changes.join(there, list(keys), "left")
        .withColumn(
            "problem", F.coalesce("problem", F.when(F.col("_known").isNull(), F.lit(text)))
        )
        .drop("_known")
    )


def _applicable(changes: DataFrame) -> DataFrame:
    if "problem" not in changes.columns:
        return changes
    return changes.where(F.col("problem").isNull())


def _matching(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str) -> DataFrame:
    """Join on keys, null equal to null; the right keys go."""
    renamed = right.withColumnsRenamed({k: f"_right_{k}" for k in keys})
    on = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_right_{k}")) for k in keys])
    return left.join(renamed, on, how).drop(*[f"_right_{k}" for k in keys])


def _seen(state: DataFrame, folded: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys of the changes that the state has.

    The state streams past the changes: a batch that is small by its statistics is broadcast,
    and then no state row is moved.
    """
    return _matching(state.select(*keys), folded.select(*keys), keys, "left_semi").distinct()


def _outcomes(
    changes: DataFrame, state: DataFrame, keys: Sequence[str], first: str, later: str
) -> DataFrame:
    """One row per change.  The first good change of an absent key is ``first``.

    Changes are combined by key on the map side and joined back; they stay on the side of the
    join that can be split.
    """
    firsts = _applicable(changes).groupBy(*keys).agg(F.min("seq").alias("_first"))
    old = _seen(state, firsts, keys).withColumn("_old", F.lit(True))
    keyed = _matching(firsts, old, keys, "left")
    problem = F.col("problem") if "problem" in changes.columns else F.lit(None).cast("string")
    return (
        _matching(changes, keyed, keys, "left")
        .withColumn(
            "outcome",
            F.when(problem.isNotNull(), "rejected")
            .when(F.coalesce("_old", F.lit(False)) | (F.col("seq") > F.col("_first")), later)
            .otherwise(first),
        )
        .select("project_id", "seq", *[k for k in keys if k != "project_id"], "outcome",
                problem.alias("reason"))
    )


def upsert(
    state: DataFrame, changes: DataFrame, keys: Sequence[str]
) -> tuple[DataFrame, DataFrame]:
    """Replace whole records in place by key, append new keys; the last change wins.

    The state's keys are unique.  Changes are reduced to one per key before they meet it.
    """
    state = as_state(state)
    payload = [c for c in state.columns if c not in (*keys, *ORDER)]
    good = _applicable(changes)
    missing = [c for c in payload if c not in good.columns]
    good = good.withColumns({c: F.lit(None).cast(state.schema[c].dataType) for c in missing})
    typed = [F.col(c).cast(state.schema[c].dataType).alias(c) for c in payload]
    folded = good.groupBy(*keys).agg(
        F.max_by(F.struct(*typed), "seq").alias("_row"), F.min("seq").cast("long").alias("_first")
    )
    here = F.col("_row").isNotNull()
    replaced = _matching(state, folded, keys, "left").select(
        *keys,
        "appended",
        F.col("pos").cast("long").alias("pos"),
        *[F.when(here, F.col(f"_row.{c}")).otherwise(F.col(c)).alias(c) for c in payload],
    )
    added = _matching(folded, _seen(state, folded, keys), keys, "left_anti").select(
        *keys, F.lit(True).alias("appended"), F.col("_first").alias("pos"), *[f"_row.{c}" for c in payload]
    )
    return replaced.unionByName(added), _outcomes(changes, state, keys, "added", "updated")


def append_distinct(
    state: DataFrame, changes: DataFrame, keys: Sequence[str], payload: Sequence[str] = ()
) -> tuple[DataFrame, DataFrame]:
    """Append rows whose key is new; the first of equal keys wins, old rows come first.

    The state is not joined, only extended by what is not in it.
    """
    state = as_state(state)
    place = state.schema["pos"].dataType
    typed = [F.col(c).cast(state.schema[c].dataType).alias(c) for c in payload]
    folded = _applicable(changes).groupBy(*keys).agg(
        F.min_by(F.struct(*typed, F.lit(0)), "seq").alias("_row"), F.min("seq").cast(place).alias("_first")
    )
    added = _matching(folded, _seen(state, folded, keys), keys, "left_anti").select(
        *keys, F.lit(True).alias("appended"), F.col("_first").alias("pos"), *[f"_row.{c}" for c in payload]
    )
    extended = state.select(*keys, *ORDER, *payload).unionByName(added)
    return extended, _outcomes(changes, state, keys, "added", "already recorded")


# -- rules of records ---------------------------------------------------------

#: Lists of records within a table.
_PARTS = ("columns", "relationships", "upstream")


def record_rules(
    kind: T.StructType, entity: str, value: Callable[[str], Column] = F.col
) -> list[tuple[Column, str]]:
    """What makes a record invalid, from the same tables of rules that ``violations`` reads.

    Absent optional fields are null and fine: they stand for their defaults.  ``value`` gives a
    field's column; fields that the record's type lacks are not tested.  Records within a table
    are tested as deep as they go.
    """
    names = kind.fieldNames()
    rules: list[tuple[Column, str]] = []
    for field in schemas.REQUIRED.get(entity, ()):
        if field in names:
            rules.append((value(field).isNull(), f"{field} is required"))
    for field in schemas.REQUIRED_TEXT.get(entity, ()):
        if field in names:
            rules.append((F.coalesce(value(field), F.lit("")) == "", f"{field} is required"))
    for field, limit in schemas.MAX_LENGTH.get(entity, {}).items():
        if field in names:
            rules.append((F.length(value(field)) > limit, f"{field} too long"))
    for field, words in schemas.ENUMS.get(entity, {}).items():
        if field in names:
            rules.append((~value(field).isin(*words), f"{field} is not an allowed word"))
    if entity == "tables":
        for field in names:
            rules += _nested_rules(kind[field].dataType, field, value)
    return [(F.coalesce(broken, F.lit(False)), text) for broken, text in rules]


def _nested_rules(
    kind: T.DataType, field: str, value: Callable[[str], Column] = F.col
) -> list[tuple[Column, str]]:
    """Rules of the records inside ``scd``, ``columns``, ``relationships`` and ``upstream``."""
    if field == "scd" and isinstance(kind, T.StructType) and "type" in kind.fieldNames():
        return [(~value(field)["type"].isin(*schemas.SCD_TYPES), "scd type is not an allowed word")]
    if field not in _PARTS or not isinstance(getattr(kind, "elementType", None), T.StructType):
        return []

    def broken(e: Column) -> Column:
        each = [test for test, _ in record_rules(kind.elementType, field, lambda name: e[name])]
        return reduce(lambda a, b: a | b, each, e.isNull())

    return [(F.exists(value(field), broken), f"{field} has an invalid entry")]


# -- documents ---------------------------------------------------------------


def upsert_tables(tables: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole records, tested with all that they contain."""
    judged = judge(changes, *record_rules(changes.schema, "tables"))
    return upsert(tables, judged, ("project_id", "table_name"))


def upsert_connections(connections: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Whole records: an optional field that is left out becomes null again."""
    judged = judge(
        changes,
        (F.col("name").isNull() | F.col("dsn").isNull(), "name and dsn are required"),
        (~F.col("engine").isin(*schemas.ENGINES), "unknown engine"),
        (
            (F.col("engine") == "trino") & is_blank(F.col("catalog")),
            "a trino connection requires a catalog",
        ),
        *record_rules(changes.schema, "connections"),
    )
    return upsert(connections, judged, ("project_id", "name"))


def upsert_glossary(glossary: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    trimmed = changes.withColumns(
        {"term": strip(F.col("term")), "definition": strip(F.col("definition"))}
    )
    limit = schemas.MAX_LENGTH["glossary"]
    judged = judge(
        trimmed,
        (is_blank(F.col("term")) | is_blank(F.col("definition")), "term and definition are required"),
        (F.length("term") > limit["term"], "term too long"),
        (F.length("definition") > limit["definition"], "definition too long"),
    )
    return upsert(glossary, judged, ("project_id", "term"))


def upsert_measures(measures: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    trimmed = changes.withColumns(
        {
            "name": strip(F.col("name")),
            "definition": strip(F.col("definition")),
            "formula": F.nullif("formula", F.lit("")),
            "owner": F.nullif("owner", F.lit("")),
        }
    )
    limit = schemas.MAX_LENGTH["measures"]

    def too_long(field: str) -> Column:
        return F.coalesce(F.length(field) > limit[field], F.lit(False))

    judged = judge(
        trimmed,
        (is_blank(F.col("name")) | is_blank(F.col("definition")), "name and definition are required"),
        *[(too_long(f), f"{f} too long") for f in limit],
    )
    return upsert(measures, judged, ("project_id", "name"))


def _last_present(field: str) -> Column:
    """Value of the last patch that names ``field``, wrapped so that null can be a value."""
    names_it = F.array_contains("present", field)
    return F.max_by(F.struct(F.col(field).alias("v")), F.when(names_it, F.col("seq")))


def _field_problem(
    field: str, nullable: Sequence[str], entity: str, kind: T.DataType
) -> list[tuple[Column, str]]:
    present = F.array_contains("present", field)
    value = F.col(field)
    rules: list[tuple[Column, str]] = []
    if field not in nullable:
        rules.append((present & value.isNull(), f"{field} may not be null"))
    limit = schemas.MAX_LENGTH[entity].get(field)
    if limit is not None:
        too_long = F.coalesce(F.length(value) > limit, F.lit(False))
        rules.append((present & too_long, f"{field} too long"))
    if field in schemas.REQUIRED_TEXT[entity]:
        rules.append((present & F.coalesce(value == "", F.lit(False)), f"{field} may not be empty"))
    words = schemas.ENUMS[entity].get(field)
    if words:
        bad = F.coalesce(~value.isin(*words), F.lit(False))
        rules.append((present & bad, f"{field} is not an allowed word"))
    for broken, text in _nested_rules(kind, field):
        rules.append((present & F.coalesce(broken, F.lit(False)), text))
    return rules


def judge_patches(
    patches: DataFrame, allowed: Sequence[str], identity: Sequence[str], nullable: Sequence[str],
    entity: str,
) -> DataFrame:
    """Mark patches with a forbidden, unknown or invalid field; one bad field rejects all.

    ``patches`` has ``present ARRAY<STRING>``, the fields a patch names, beside one
    column per patchable field.
    """
    words = F.array(*[F.lit(a) for a in allowed])
    rules: list[tuple[Column, str]] = []
    if identity:
        fixed = F.array(*[F.lit(i) for i in identity])
        rules.append((F.arrays_overlap("present", fixed), "identity fields cannot be patched"))
    rules.append((F.size(F.array_except("present", words)) > 0, "unknown patch fields"))
    for field in allowed:
        if field in patches.columns:
            rules += _field_problem(field, nullable, entity, patches.schema[field].dataType)
    return judge(patches, *rules)


def patch(
    state: DataFrame, judged: DataFrame, keys: Sequence[str], fields: Sequence[str],
    create: bool,
) -> tuple[DataFrame, DataFrame]:
    """Overwrite the named fields, null included; per field the last good patch wins.

    With ``create`` a patch of an absent key makes a new row.
    """
    state = as_state(state)
    fields = [f for f in fields if f in judged.columns and f in state.columns]
    keys = list(keys)
    good = _applicable(judged)
    folded = good.groupBy(*keys).agg(
        F.min("seq").alias("_first"), *[_last_present(f).alias(f"_new_{f}") for f in fields]
    )
    joined = _matching(state, folded, keys, "left")
    if create:
        absent = _matching(folded, _seen(state, folded, keys), keys, "left_anti")
        joined = joined.unionByName(absent, allowMissingColumns=True)
    defaults = schemas.DEFAULTS.get("tables" if "table_name" in keys else "project", {})

    def value(name: str) -> Column:
        old = F.col(name)
        if name in defaults:
            # a freshly created row takes the default of a field no patch names
            old = F.when(F.col("appended").isNull(), F.lit(defaults[name])).otherwise(old)
        if name not in fields:
            return old.alias(name)
        new = F.col(f"_new_{name}")
        return F.when(new.isNotNull(), new["v"]).otherwise(old).alias(name)

    rest = [c for c in state.columns if c not in (*keys, *ORDER)]
    patched = joined.select(
        *keys,
        F.coalesce("appended", F.lit(True)).alias("appended"),
        F.coalesce(F.col("pos").cast("long"), F.col("_first").cast("long")).alias("pos"),
        *[value(c) for c in rest],
    )
    return patched, _outcomes(judged, state, keys, "added", "updated")


def patch_tables(tables: DataFrame, patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    judged = judge_patches(
        patches,
        schemas.TABLE_PATCH_FIELDS,
        schemas.TABLE_IDENTITY_FIELDS,
        schemas.TABLE_NULLABLE_FIELDS,
        "tables",
    )
    return patch(
        tables, judged, ("project_id", "table_name"), schemas.TABLE_PATCH_FIELDS, create=True
    )


def patch_project_config(projects: DataFrame, patches: DataFrame) -> tuple[DataFrame, DataFrame]:
    """One config per project; an empty patch is rejected."""
    judged = judge_patches(
        patches, schemas.CONFIG_PATCH_FIELDS, (), schemas.CONFIG_NULLABLE_FIELDS, "projects"
    ).withColumn(
        "problem",
        F.coalesce(F.when(F.size("present") == 0, "patch must not be empty"), F.col("problem")),
    )
    known = require_known(judged, projects, ["project_id"], "unknown project")
    state = projects if "pos" in projects.columns else projects.withColumn("pos", F.lit(0))
    return patch(state, known, ("project_id",), schemas.CONFIG_PATCH_FIELDS, create=False)


# -- parts of a table --------------------------------------------------------


def set_primary_key(
    tables: DataFrame, columns: DataFrame, changes: DataFrame
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """``(tables, columns, outcomes, unlisted)``.

    The last list per table is stored as given, unknown columns included, and the
    flag is true on exactly the listed columns.  ``unlisted`` has the columns of a
    change that the table does not have.
    """
    key = ["project_id", "table_name"]
    judged = judge(changes, (F.col("columns").isNull(), "columns are required"))
    judged = require_known(judged, tables, key, "unknown table")
    final = (
        _applicable(judged)
        .groupBy(*key)
        .agg(F.max_by("columns", "seq").alias("_pk"))
    )
    next_tables = (
        tables.join(final, key, "left")
        .withColumn("primary_keys", F.coalesce("_pk", "primary_keys"))
        .drop("_pk")
    )
    next_columns = (
        columns.join(final, key, "left")
        .withColumn(
            "is_primary_key",
            F.when(F.col("_pk").isNull(), F.col("is_primary_key")).otherwise(
                F.coalesce(F.array_contains("_pk", F.col("name")), F.lit(False))
            ),
        )
        .drop("_pk")
    )
    unlisted = (
        _applicable(judged)
        .select(*key, "seq", F.explode("columns").alias("name"))
        .join(columns.select(*key, "name").distinct(), [*key, "name"], "left_anti")
    )
    outcomes = judged.select(
        *key,
        "seq",
        F.when(F.col("problem").isNull(), "set").otherwise("rejected").alias("outcome"),
        F.col("problem").alias("reason"),
    )
    return next_tables, next_columns, outcomes, unlisted


def add_relationship(
    relationships: DataFrame, tables: DataFrame, changes: DataFrame
) -> tuple[DataFrame, DataFrame]:
    """Same target and same key columns is a repeat, whatever the cardinality says."""
    sizes = (F.size("from_columns") == F.size("to_columns")) & (F.size("from_columns") > 0)
    judged = judge(
        changes,
        (~sizes, "key column lists must be of equal length and not empty"),
        (~F.col("cardinality").isin(*schemas.CARDINALITIES), "unknown cardinality"),
    )
    judged = require_known(judged, tables, ["project_id", "table_name"], "unknown table")
    return append_distinct(
        relationships,
        judged,
        ("project_id", "table_name", "to_table", "from_columns", "to_columns"),
        ("cardinality", "description"),
    )


def add_upstream(
    upstream: DataFrame, tables: DataFrame, changes: DataFrame
) -> tuple[DataFrame, DataFrame]:
    judged = judge(changes, (F.coalesce(F.col("ref") == "", F.lit(True)), "ref is required"))
    judged = require_known(judged, tables, ["project_id", "table_name"], "unknown table")
    return append_distinct(
        upstream, judged, ("project_id", "table_name", "ref"), ("description",)
    )


def pitfall_rows(tables: DataFrame) -> DataFrame:
    """The pitfalls of every table, one per row."""
    return tables.select(
        "project_id", "table_name", F.posexplode("pitfalls").alias("pos", "message")
    )


def add_pitfall(
    pitfalls: DataFrame, tables: DataFrame, changes: DataFrame
) -> tuple[DataFrame, DataFrame]:
    trimmed = changes.withColumn("message", strip(F.col("message")))
    judged = judge(
        trimmed,
        (is_blank(F.col("message")), "message is required"),
        (F.length("message") > schemas.PITFALL_MAX, "message too long"),
    )
    judged = require_known(judged, tables, ["project_id", "table_name"], "unknown table")
    return append_distinct(pitfalls, judged, ("project_id", "table_name", "message"))


def _set_field(
    rows: DataFrame, judged: DataFrame, keys: Sequence[str], field: str, value: Column
) -> tuple[DataFrame, DataFrame]:
    """Last good value per key written into ``field``."""
    final = (
        _applicable(judged)
        .groupBy(*keys)
        .agg(F.max_by(F.struct(value.alias("v")), "seq").alias("_new"))
    )
    updated = (
        rows.join(final, list(keys), "left")
        .withColumn(
            field, F.when(F.col("_new").isNull(), F.col(field)).otherwise(F.col("_new.v"))
        )
        .drop("_new")
    )
    outcomes = judged.select(
        *keys,
        "seq",
        F.when(F.col("problem").isNull(), "set").otherwise("rejected").alias("outcome"),
        F.col("problem").alias("reason"),
    )
    return updated, outcomes


def set_table_grain(tables: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """An empty grain clears the field."""
    key = ["project_id", "table_name"]
    judged = judge(
        changes,
        (F.col("grain").isNull(), "grain is required"),
        (F.length("grain") > schemas.GRAIN_MAX, "grain too long"),
    )
    judged = require_known(judged, tables, key, "unknown table")
    return _set_field(tables, judged, key, "grain", F.nullif("grain", F.lit("")))


def set_classification(columns: DataFrame, changes: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Exact table and column names; anything unknown is rejected."""
    key = ["project_id", "table_name", "name"]
    judged = judge(
        changes, (~F.col("classification").isin(*schemas.CLASSIFICATIONS), "unknown classification")
    )
    judged = require_known(judged, columns, key[:2], "unknown table")
    judged = require_known(judged, columns, key, "unknown column")
    return _set_field(columns, judged, key, "classification", F.col("classification"))


def stamp(projects: DataFrame, outcomes: DataFrame, now: Column) -> DataFrame:
    """``updated_at`` on every project with a change that took effect."""
    touched = (
        outcomes.where(~F.col("outcome").isin("rejected", "already recorded"))
        .select("project_id")
        .distinct()
        .withColumn("_touched", F.lit(True))
    )
    return (
        projects.join(touched, "project_id", "left")
        .withColumn("updated_at", F.when(F.col("_touched"), now).otherwise(F.col("updated_at")))
        .drop("_touched")
    )


# -- validation --------------------------------------------------------------

_KEYS: Mapping[str, tuple[str, ...]] = {
    "projects": ("project_id",),
    "connections": ("project_id", "pos"),
    "tables": ("project_id", "pos"),
    "glossary": ("project_id", "pos"),
    "measures": ("project_id", "pos"),
    "columns": ("project_id", "table_name", "pos"),
    "relationships": ("project_id", "table_name", "pos"),
    "upstream": ("project_id", "table_name", "pos"),
}


def violations(rows: DataFrame, entity: str) -> DataFrame:
    """Rule breaks of one flattened document table, one row each; no shuffle.

    Columns ``project_id, path, rule, severity, value_length``.
    """
    path = F.concat_ws("/", F.lit(entity), *[F.col(k).cast("string") for k in _KEYS[entity][1:]])

    def finding(
        field: str, rule: str, broken: Column, severity: str = "enforced", size: Column | None = None
    ) -> Column:
        return F.when(
            F.coalesce(broken, F.lit(False)),
            F.struct(
                F.concat(path, F.lit(f"/{field}")).alias("path"),
                F.lit(rule).alias("rule"),
                F.lit(severity).alias("severity"),
                F.coalesce(F.length(F.col(field).cast("string")) if size is None else size, F.lit(0))
                .cast("long")
                .alias("value_length"),
            ),
        )

    found: list[Column] = []
    for severity, table in (
        ("enforced", schemas.MAX_LENGTH),
        ("documented", schemas.DOCUMENTED_MAX_LENGTH),
    ):
        for field, limit in table.get(entity, {}).items():
            if field in rows.columns:
                found.append(
                    finding(field, f"at most {limit} characters", F.length(field) > limit, severity)
                )
    for field in schemas.REQUIRED.get(entity, ()):
        found.append(finding(field, "required", F.col(field).isNull()))
    for field in schemas.REQUIRED_TEXT.get(entity, ()):
        found.append(
            finding(field, "required, not empty", F.coalesce(F.col(field), F.lit("")) == "")
        )
    for field, words in schemas.ENUMS.get(entity, {}).items():
        if field not in rows.columns:
            continue
        bad = ~F.col(field).isin(*words)
        if field in schemas.ENUM_NOT_NULL and field not in schemas.REQUIRED.get(entity, ()):
            bad = F.coalesce(bad, F.lit(True))
        found.append(finding(field, "allowed word", bad))
    if entity == "relationships":
        found.append(
            finding(
                "from_columns", "required",
                F.col("from_columns").isNull() | F.col("to_columns").isNull(), size=F.lit(0),
            )
        )
    each = rows.select(
        "project_id", F.explode(F.array_compact(F.array(*found))).alias("_v")
    ).select("project_id", "_v.*")
    if entity == "tables" and "pitfalls" in rows.columns:
        long_pitfalls = rows.select(
            "project_id", path.alias("_path"), F.posexplode("pitfalls").alias("_at", "_p")
        ).where(F.length("_p") > schemas.PITFALL_MAX)
        each = each.unionByName(
            long_pitfalls.select(
                "project_id",
                F.concat_ws("/", "_path", F.lit("pitfalls"), F.col("_at").cast("string")).alias("path"),
                F.lit(f"at most {schemas.PITFALL_MAX} characters").alias("rule"),
                F.lit("documented").alias("severity"),
                F.length("_p").cast("long").alias("value_length"),
            )
        )
    return each


def validate(flattened: Mapping[str, DataFrame], versions: Sequence[int] = (1,)) -> DataFrame:
    """Rule breaks of whole documents (the result of ``documents.flatten``)."""
    out: DataFrame | None = None
    for entity in _KEYS:
        rows = flattened[entity]
        if entity == "tables" and "scd" in rows.columns:
            rows = rows.withColumn("scd_type", F.coalesce("scd.type", F.lit("none")))
        found = violations(rows, entity)
        out = found if out is None else out.unionByName(found)
    newer = flattened["projects"].where(~F.col("schema_version").isin(*versions))
    return out.unionByName(
        newer.select(
            "project_id",
            F.lit("projects/schema_version").alias("path"),
            F.lit("supported version").alias("rule"),
            F.lit("documented").alias("severity"),
            F.lit(0).cast("long").alias("value_length"),
        )
    )
