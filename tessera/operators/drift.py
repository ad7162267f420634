"""Authored column lists against live ones, for all tables of all projects in one plan."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions.text import is_blank, strip
from tessera.operators.keyed import latest_per_key

TABLE_KEY = ("project_id", "table_name")


def same_type(a: Column, b: Column) -> Column:
    """Types compare without outer white space and case; null is ''."""
    return F.lower(strip(F.coalesce(a, F.lit("")))) == F.lower(strip(F.coalesce(b, F.lit(""))))


def diff_columns(
    authored: DataFrame, live: DataFrame, keys: Sequence[str] = TABLE_KEY
) -> DataFrame:
    """Changes ``added`` / ``removed`` / ``changed`` per table, one row each.

    Both sides have the keys and ``pos, name, type, nullable``.  Names match without
    regard to case and the last of several equal names is the one compared with.
    An authored column without a type can be added but never changed.  Before is
    live, after is authored; ``pos`` is the authored position, for removed columns
    the live one.
    """
    by_name = [*keys, "_name"]
    left = authored.withColumn("_name", F.lower("name"))
    right = live.withColumn("_name", F.lower("name"))
    target = latest_per_key(
        right.select(*by_name, "pos", F.struct("type", "nullable").alias("_live")), by_name, "pos"
    ).drop("pos")
    after_known = ~is_blank(F.col("type"))
    differs = ~same_type(F.col("type"), F.col("_live.type")) | (
        F.col("nullable") != F.col("_live.nullable")
    )
    authored_changes = (
        left.join(target, by_name, "left")
        .withColumn(
            "change_type",
            F.when(F.col("_live").isNull(), "added").when(after_known & differs, "changed"),
        )
        .where(F.col("change_type").isNotNull())
        .select(
            *keys,
            "change_type",
            "pos",
            "name",
            F.col("_live.type").alias("before_type"),
            F.col("_live.nullable").alias("before_nullable"),
            F.col("type").alias("after_type"),
            F.col("nullable").alias("after_nullable"),
        )
    )
    removed = right.join(left.select(*by_name).distinct(), by_name, "left_anti").select(
        *keys,
        F.lit("removed").alias("change_type"),
        "pos",
        "name",
        F.col("type").alias("before_type"),
        F.col("nullable").alias("before_nullable"),
        F.lit(None).cast("string").alias("after_type"),
        F.lit(None).cast("boolean").alias("after_nullable"),
    )
    return authored_changes.unionByName(removed)


def unchanged(tables: DataFrame, changes: DataFrame, keys: Sequence[str] = TABLE_KEY) -> DataFrame:
    """Tables without any change."""
    return tables.join(changes.select(*keys).distinct(), list(keys), "left_anti")


def target_schema(target: Column) -> Column:
    """Part before the first dot."""
    return F.substring_index(target, ".", 1)


def target_table(target: Column) -> Column:
    """All behind the first dot, further dots included."""
    return F.substring(target, F.instr(target, ".") + 1, F.length(target))


def target_status(
    tables: DataFrame, connections: DataFrame, failures: DataFrame | None = None
) -> DataFrame:
    """Tracked tables with ``live_schema, live_table`` and ``skip_reason`` (null: compare).

    ``failures`` has ``(project_id, connection, table_schema, live_table, reason,
    detail)`` for catalog reads that did not succeed.
    """
    target = F.col("staging_target")
    known = connections.select(
        "project_id", F.col("name").alias("connection"), F.lit(True).alias("_known")
    ).distinct()
    usable = (
        F.coalesce(F.col("connection") != "", F.lit(False))
        & F.coalesce(F.contains(target, F.lit(".")), F.lit(False))
    )
    placed = tables.join(known, ["project_id", "connection"], "left").withColumns(
        {
            "live_schema": F.when(usable, target_schema(target)),
            "live_table": F.when(usable, target_table(target)),
        }
    )
    reason = (
        F.when(~usable, "no connection or staging_target")
        .when(
            F.col("_known").isNull(),
            F.concat(F.lit("connection '"), F.col("connection"), F.lit("' not found")),
        )
    )
    if failures is not None:
        failed = failures.select(
            "project_id",
            "connection",
            F.col("table_schema").alias("live_schema"),
            "live_table",
            F.col("reason").alias("failure_reason"),
            F.concat_ws(": ", "reason", "detail").alias("_failure"),
        )
        placed = placed.join(failed, ["project_id", "connection", "live_schema", "live_table"], "left")
        reason = reason.when(F.col("_failure").isNotNull(), F.col("_failure"))
    else:
        placed = placed.withColumns(
            {
                "failure_reason": F.lit(None).cast("string"),
                "_failure": F.lit(None).cast("string"),
            }
        )
    return placed.withColumns(
        {
            "skip_reason": reason,
            "failure_reason": F.when(usable & F.col("_known"), F.col("failure_reason")),
        }
    ).drop("_known", "_failure")


def _live_of_targets(status: DataFrame, live: DataFrame) -> DataFrame:
    """Live columns keyed by the tracked table that points at them."""
    # a column of the harvest is wanted by few tables: the targets are the small side
    targets = status.where(F.col("skip_reason").isNull()).select(
        "project_id",
        F.col("table_name").alias("_tracked"),
        "connection",
        F.col("live_schema").alias("table_schema"),
        F.col("live_table").alias("table_name"),
    )
    return live.join(targets, ["project_id", "connection", "table_schema", "table_name"]).select(
        "project_id",
        F.col("_tracked").alias("table_name"),
        F.col("ordinal_position").alias("pos"),
        "name",
        F.col("data_type").alias("type"),
        "nullable",
    )


def pending_changes(
    tables: DataFrame,
    connections: DataFrame,
    authored: DataFrame,
    live: DataFrame,
    failures: DataFrame | None = None,
) -> tuple[DataFrame, DataFrame]:
    """``(changes, status)`` over every tracked table.

    ``live`` has ``project_id, connection, table_schema, table_name, name,
    data_type, nullable, ordinal_position``.
    """
    status = target_status(tables, connections, failures)
    compared = status.where(F.col("skip_reason").isNull()).select("project_id", "table_name")
    mine = authored.join(compared, list(TABLE_KEY), "left_semi")
    return diff_columns(mine, _live_of_targets(status, live)), status


def _not_null(nullable: Column, yes: str = " NOT NULL", no: str = "") -> Column:
    return F.when(nullable, F.lit(no)).otherwise(F.lit(yes))


def report_lines(changes: DataFrame, status: DataFrame) -> DataFrame:
    """The report as rows ``(project_id, table_name, section, pos, line)``.

    Ordered by project, table, section and pos it reads: heading, added, removed,
    changed; skipped tables give their reason.  Kept as lines, because a report on a
    whole fleet must not become one string.
    """
    before = F.concat_ws(
        "/", "before_type", _not_null(F.col("before_nullable"), "not null", "null")
    )
    after = F.concat_ws("/", "after_type", _not_null(F.col("after_nullable"), "not null", "null"))
    kind = F.col("change_type")
    body = changes.select(
        *TABLE_KEY,
        F.when(kind == "added", 1).when(kind == "removed", 2).otherwise(3).alias("section"),
        F.col("pos").cast("long").alias("pos"),
        F.when(
            kind == "added",
            F.concat(
                F.lit("  + "), "name", F.lit("  "), F.coalesce("after_type", F.lit("")),
                _not_null(F.col("after_nullable")),
            ),
        )
        .when(
            kind == "removed",
            F.concat(
                F.lit("  - "), "name", F.lit("  "), F.coalesce("before_type", F.lit("")),
                _not_null(F.col("before_nullable")),
            ),
        )
        .otherwise(
            F.concat(F.lit("  ~ "), "name", F.lit("  before="), before, F.lit("  after="), after)
        )
        .alias("line"),
    )
    changed = status.join(changes.select(*TABLE_KEY).distinct(), list(TABLE_KEY), "left_semi")
    heading = changed.select(
        *TABLE_KEY,
        F.lit(0).alias("section"),
        F.lit(0).cast("long").alias("pos"),
        F.concat(
            F.lit("["), "table_name", F.lit("]  ("), "staging_target", F.lit(")")
        ).alias("line"),
    )
    skipped = status.where(F.col("skip_reason").isNotNull()).select(
        *TABLE_KEY,
        F.lit(0).alias("section"),
        F.lit(0).cast("long").alias("pos"),
        F.concat(F.lit("["), "table_name", F.lit("] skipped — "), "skip_reason").alias("line"),
    )
    return heading.unionByName(body).unionByName(skipped)


def report_summary(changes: DataFrame, status: DataFrame) -> DataFrame:
    """Per project: tracked tables, tables with changes, skipped ones, and the title line."""
    touched = changes.select(*TABLE_KEY).distinct().withColumn("_touched", F.lit(1))
    counted = (
        status.select(*TABLE_KEY, F.col("skip_reason").isNotNull().cast("int").alias("_skipped"))
        .join(touched, list(TABLE_KEY), "left")
        .groupBy("project_id")
        .agg(
            F.count("*").alias("n_tables"),
            F.sum(F.coalesce("_touched", F.lit(0))).alias("n_shown"),
            F.sum("_skipped").alias("n_skipped"),
        )
    )
    title = F.when(
        F.col("n_shown") == 0,
        F.concat(
            F.lit("No pending changes across "), F.col("n_tables").cast("string"),
            F.lit(" tracked table(s)."),
        ),
    ).otherwise(
        F.concat(
            F.lit("Pending changes ("), F.col("n_shown").cast("string"),
            F.lit(" table(s) with diffs"),
            F.when(
                F.col("n_skipped") > 0,
                F.concat(F.lit(", "), F.col("n_skipped").cast("string"), F.lit(" skipped")),
            ).otherwise(""),
            F.lit("):"),
        )
    )
    return counted.withColumn("title", title)


#: what stays as authored when a column list is refreshed, and its default
HINTS = {
    "is_primary_key": False,
    "is_foreign_key": False,
    "description": None,
    "classification": "unspecified",
    "quality_notes": None,
    "computed": False,
    "expression": None,
    "example_values": [],
}


def refresh_columns(
    authored: DataFrame, live: DataFrame, keys: Sequence[str] = TABLE_KEY,
    case_insensitive: bool = False,
) -> DataFrame:
    """Live columns in live order, with the hints of authored columns of the same name.

    Type and nullability come from the live side; authored columns that are gone
    are dropped with their hints.  Names match exactly unless ``case_insensitive``.
    """
    match = F.lower("name") if case_insensitive else F.col("name")
    by_name = [*keys, "_name"]
    hints = [h for h in HINTS if h in authored.columns]
    known = latest_per_key(
        authored.withColumn("_name", match).select(*by_name, "pos", *hints), by_name, "pos"
    ).drop("pos")
    joined = live.withColumn("_name", match).join(known, by_name, "left")

    def hint(name: str) -> Column:
        default = HINTS[name]
        if default is None:
            return F.col(name)
        absent = F.array().cast("array<string>") if default == [] else F.lit(default)
        return F.coalesce(F.col(name), absent).alias(name)

    return joined.select(*keys, "pos", "name", "type", "nullable", *[hint(h) for h in hints])


def refresh_outcomes(status: DataFrame, now: Column) -> DataFrame:
    """Per tracked table: refreshed, skipped or failed, and the stamps a refresh sets."""
    outcome = (
        F.when(F.col("failure_reason").isNotNull(), "failed")
        .when(F.col("skip_reason").isNotNull(), "skipped")
        .otherwise("refreshed")
    )
    done = F.col("outcome") == "refreshed"
    return status.withColumn("outcome", outcome).select(
        *TABLE_KEY,
        "outcome",
        F.when(~done, F.coalesce("failure_reason", "skip_reason")).alias("reason"),
        F.when(done, F.lit("information_schema")).alias("columns_from"),
        F.when(done, now).alias("last_run_at"),
    )
