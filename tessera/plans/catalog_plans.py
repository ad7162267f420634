"""Catalog and drift queries.

Every ``part`` row is one catalog column: 50 tables in 3 projects, with lengths,
nullability and names that drift between the authored and the live side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import catalog, drift
from tessera.plans.registry import query, table, text


def harvested(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``information_schema.columns``-shaped rows of the live side."""
    k, t = F.col("p_partkey"), F.col("t")
    kind = F.col("p_size") % 4
    return (
        table(spark, sf_dir, "part")
        .withColumn("t", k % 50)
        .select(
            F.concat(F.lit("p"), (t % 3).cast("string")).alias("project_id"),
            F.concat(F.lit("c"), (t % 9).cast("string")).alias("connection"),
            F.when(t == 7, "a").otherwise("wh").alias("TABLE_SCHEMA"),
            F.when(t == 7, "b.c")
            .otherwise(F.concat(F.lit("t"), t.cast("string")))
            .alias("TABLE_NAME"),
            F.concat(F.lit("c"), k.cast("string")).alias("COLUMN_NAME"),
            F.when(kind == 0, "int")
            .when(kind == 1, "bigint")
            .when(kind == 2, "varchar(40)")
            .otherwise("decimal(18,2)")
            .alias("DATA_TYPE"),
            F.when(k % 3 == 0, "YES").when(k % 3 == 1, "no").alias("IS_NULLABLE"),
            k.alias("ORDINAL_POSITION"),
        )
    )


def authored(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    kind = F.col("p_size") % 4
    upper = F.concat(F.lit("C"), k.cast("string"))
    live_type = (
        F.when(kind == 0, "INT ")
        .when(kind == 1, "bigint")
        .when(kind == 2, "varchar(40)")
        .otherwise("decimal(18,2)")
    )
    return (
        table(spark, sf_dir, "part")
        .where(k % 7 != 0)
        .withColumn("t", k % 50)
        .select(
            F.concat(F.lit("p"), (F.col("t") % 3).cast("string")).alias("project_id"),
            F.concat(F.lit("t"), F.col("t").cast("string")).alias("table_name"),
            k.alias("pos"),
            F.when(k % 11 == 0, F.concat(F.lit("new_"), upper)).otherwise(upper).alias("name"),
            F.when(k % 13 == 0, " ").when(k % 5 == 0, "text").otherwise(live_type).alias("type"),
            F.when(k % 17 == 0, k % 3 == 1).otherwise(k % 3 != 1).alias("nullable"),
            (k % 19 == 0).alias("is_primary_key"),
            F.lit(False).alias("is_foreign_key"),
            F.col("p_name").alias("description"),
            F.when(k % 4 == 0, "pii").otherwise("unspecified").alias("classification"),
        )
    )


def tracked(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("t")
    return (
        table(spark, sf_dir, "part")
        .select((F.col("p_partkey") % 50).alias("t"))
        .distinct()
        .select(
            F.concat(F.lit("p"), (t % 3).cast("string")).alias("project_id"),
            F.concat(F.lit("t"), t.cast("string")).alias("table_name"),
            t.alias("pos"),
            F.concat(F.lit("c"), (t % 9).cast("string")).alias("connection"),
            F.when(t == 7, "a.b.c")
            .when(t % 10 != 9, F.concat(F.lit("wh.t"), t.cast("string")))
            .alias("staging_target"),
        )
    )


def connections(tables: DataFrame) -> DataFrame:
    """Every connection but c8."""
    return (
        tables.select("project_id", F.col("connection").alias("name"))
        .distinct()
        .where(F.col("name") != "c8")
    )


def failures(tables: DataFrame) -> DataFrame:
    return tables.where(F.col("pos") == 5).select(
        "project_id",
        "connection",
        F.lit("wh").alias("table_schema"),
        F.lit("t5").alias("live_table"),
        F.lit("query_failed").alias("reason"),
        F.lit("no grant").alias("detail"),
    )


def live(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = catalog.lower_columns(harvested(spark, sf_dir))
    return catalog.live_columns(rows, "project_id", "connection")


def _pending(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    tables = tracked(spark, sf_dir)
    return drift.pending_changes(
        tables, connections(tables), authored(spark, sf_dir), live(spark, sf_dir), failures(tables)
    )


LIVE_SQL = """
harvested AS (
  SELECT 'p' || (p_partkey % 50) % 3 AS project_id, 'c' || (p_partkey % 50) % 9 AS connection,
         CASE WHEN p_partkey % 50 = 7 THEN 'a' ELSE 'wh' END AS table_schema,
         CASE WHEN p_partkey % 50 = 7 THEN 'b.c' ELSE 't' || p_partkey % 50 END AS table_name,
         'c' || p_partkey AS name,
         CASE p_size % 4 WHEN 0 THEN 'int' WHEN 1 THEN 'bigint' WHEN 2 THEN 'varchar(40)'
              ELSE 'decimal(18,2)' END AS data_type,
         p_partkey % 3 <> 1 AS nullable, p_partkey AS pos
  FROM part)"""
TABLES_SQL = """
tracked AS (
  SELECT DISTINCT 'p' || (p_partkey % 50) % 3 AS project_id, 't' || p_partkey % 50 AS table_name,
         'c' || (p_partkey % 50) % 9 AS connection, p_partkey % 50 AS t,
         CASE WHEN p_partkey % 50 = 7 THEN 'a.b.c' WHEN p_partkey % 10 <> 9
              THEN 'wh.t' || p_partkey % 50 END AS staging_target
  FROM part),
status AS (
  SELECT *, CASE WHEN staging_target IS NULL THEN 'no connection or staging_target'
                 WHEN connection = 'c8' THEN 'connection ''c8'' not found'
                 WHEN t = 5 THEN 'query_failed: no grant' END AS skip_reason
  FROM tracked)"""
AUTHORED_SQL = """
authored AS (
  SELECT 'p' || (p_partkey % 50) % 3 AS project_id, 't' || p_partkey % 50 AS table_name,
         p_partkey AS pos,
         CASE WHEN p_partkey % 11 = 0 THEN 'new_' ELSE '' END || 'C' || p_partkey AS name,
         CASE WHEN p_partkey % 13 = 0 THEN ' ' WHEN p_partkey % 5 = 0 THEN 'text'
              ELSE CASE p_size % 4 WHEN 0 THEN 'INT ' WHEN 1 THEN 'bigint' WHEN 2 THEN 'varchar(40)'
                   ELSE 'decimal(18,2)' END END AS type,
         CASE WHEN p_partkey % 17 = 0 THEN p_partkey % 3 = 1 ELSE p_partkey % 3 <> 1 END AS nullable,
         p_partkey % 19 = 0 AS is_primary_key, p_name AS description,
         CASE WHEN p_partkey % 4 = 0 THEN 'pii' ELSE 'unspecified' END AS classification
  FROM part WHERE p_partkey % 7 <> 0)"""
CHANGES_SQL = f"""
WITH {LIVE_SQL}, {TABLES_SQL}, {AUTHORED_SQL},
lv AS (SELECT s.project_id, s.table_name, h.pos, h.name, h.data_type AS type, h.nullable
       FROM status s JOIN harvested h ON h.project_id = s.project_id AND h.connection = s.connection
        AND h.table_schema || '.' || h.table_name = s.staging_target
       WHERE s.skip_reason IS NULL),
au AS (SELECT a.* FROM authored a JOIN status s USING (project_id, table_name)
       WHERE s.skip_reason IS NULL),
changes AS (
  SELECT coalesce(a.project_id, l.project_id) AS project_id,
         coalesce(a.table_name, l.table_name) AS table_name,
         CASE WHEN l.name IS NULL THEN 'added' WHEN a.name IS NULL THEN 'removed'
              ELSE 'changed' END AS change_type,
         coalesce(a.pos, l.pos) AS pos, coalesce(a.name, l.name) AS name,
         l.type AS before_type, l.nullable AS before_nullable,
         a.type AS after_type, a.nullable AS after_nullable
  FROM au a FULL OUTER JOIN lv l ON a.project_id = l.project_id AND a.table_name = l.table_name
       AND lower(a.name) = lower(l.name)
  WHERE l.name IS NULL OR a.name IS NULL OR
        (trim(a.type) <> '' AND (lower(trim(a.type)) <> lower(trim(l.type))
                                 OR a.nullable <> l.nullable)))"""


@query(
    CHANGES_SQL
    + """
SELECT project_id, table_name, change_type, pos, name, coalesce(before_type, '') AS before_type,
       coalesce(before_nullable::VARCHAR, '') AS before_nullable,
       coalesce(after_type, '') AS after_type, coalesce(after_nullable::VARCHAR, '') AS after_nullable
FROM changes"""
)
def pending_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes, _ = _pending(spark, sf_dir)
    return changes.select(
        "project_id", "table_name", "change_type", "pos", "name", text("before_type"),
        text("before_nullable"), text("after_type"), text("after_nullable"),
    )


@query(
    f"WITH {TABLES_SQL} SELECT project_id, table_name, coalesce(skip_reason, '') AS skip_reason FROM status"
)
def pending_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, status = _pending(spark, sf_dir)
    return status.select("project_id", "table_name", text("skip_reason"))


@query(
    CHANGES_SQL
    + """
SELECT project_id, table_name, 0 AS section, 0::BIGINT AS pos,
       '[' || table_name || ']  (' || staging_target || ')' AS line
FROM status WHERE (project_id, table_name) IN (SELECT (project_id, table_name) FROM changes)
UNION ALL
SELECT project_id, table_name, 0, 0, '[' || table_name || '] skipped — ' || skip_reason
FROM status WHERE skip_reason IS NOT NULL
UNION ALL
SELECT project_id, table_name, CASE change_type WHEN 'added' THEN 1 WHEN 'removed' THEN 2 ELSE 3 END, pos,
       CASE change_type
         WHEN 'added' THEN '  + ' || name || '  ' || after_type
              || CASE WHEN after_nullable THEN '' ELSE ' NOT NULL' END
         WHEN 'removed' THEN '  - ' || name || '  ' || before_type
              || CASE WHEN before_nullable THEN '' ELSE ' NOT NULL' END
         ELSE '  ~ ' || name || '  before=' || before_type
              || CASE WHEN before_nullable THEN '/null' ELSE '/not null' END
              || '  after=' || after_type
              || CASE WHEN after_nullable THEN '/null' ELSE '/not null' END END
FROM changes"""
)
def pending_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.report_lines(*_pending(spark, sf_dir))


@query(
    CHANGES_SQL
    + """
, n AS (SELECT s.project_id, count(*) AS n_tables,
        count(CASE WHEN EXISTS (SELECT 1 FROM changes c WHERE c.project_id = s.project_id
                                AND c.table_name = s.table_name) THEN 1 END) AS n_shown,
        count(skip_reason) AS n_skipped FROM status s GROUP BY 1)
SELECT *, CASE WHEN n_shown = 0 THEN 'No pending changes across ' || n_tables || ' tracked table(s).'
          ELSE 'Pending changes (' || n_shown || ' table(s) with diffs'
               || CASE WHEN n_skipped > 0 THEN ', ' || n_skipped || ' skipped' ELSE '' END || '):' END AS title
FROM n"""
)
def pending_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.report_summary(*_pending(spark, sf_dir))


@query(
    CHANGES_SQL
    + """
SELECT project_id, table_name FROM status WHERE skip_reason IS NULL
EXCEPT SELECT project_id, table_name FROM changes"""
)
def unchanged_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    changes, status = _pending(spark, sf_dir)
    compared = status.where(F.col("skip_reason").isNull()).select("project_id", "table_name")
    return drift.unchanged(compared, changes)


@query(
    f"""
WITH {LIVE_SQL}, {AUTHORED_SQL}
SELECT h.project_id, h.table_name, h.pos, h.name, h.data_type AS type, h.nullable,
       coalesce(a.is_primary_key, false) AS is_primary_key, false AS is_foreign_key,
       coalesce(a.description, '') AS description,
       coalesce(a.classification, 'unspecified') AS classification
FROM harvested h LEFT JOIN authored a ON a.project_id = h.project_id
     AND a.table_name = h.table_name AND lower(a.name) = lower(h.name)"""
)
def refresh_merge(spark: SparkSession, sf_dir: str) -> DataFrame:
    shape = live(spark, sf_dir).select(
        "project_id",
        "table_name",
        F.col("ordinal_position").alias("pos"),
        "name",
        F.col("data_type").alias("type"),
        "nullable",
    )
    merged = drift.refresh_columns(authored(spark, sf_dir), shape, case_insensitive=True)
    return merged.select(
        *[text(c) if c == "description" else F.col(c) for c in merged.columns]
    )


@query(
    f"""
WITH {TABLES_SQL}
SELECT project_id, table_name,
       CASE WHEN t = 5 THEN 'failed' WHEN skip_reason IS NOT NULL THEN 'skipped'
            ELSE 'refreshed' END AS outcome,
       CASE WHEN t = 5 THEN 'query_failed' ELSE coalesce(skip_reason, '') END AS reason,
       CASE WHEN skip_reason IS NULL THEN 'information_schema' ELSE '' END AS columns_from,
       CASE WHEN skip_reason IS NULL THEN '2024-02-01T00:00:00Z' ELSE '' END AS last_run_at
FROM status"""
)
def refresh_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = tracked(spark, sf_dir)
    status = drift.target_status(tables, connections(tables), failures(tables))
    out = drift.refresh_outcomes(status, F.lit("2024-02-01T00:00:00Z"))
    return out.select(
        "project_id", "table_name", "outcome", text("reason"), text("columns_from"), text("last_run_at")
    )


@query(
    f"WITH {LIVE_SQL} SELECT DISTINCT table_schema AS name FROM harvested WHERE contains(lower(table_schema), 'w')"
)
def schemas_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    schemata = live(spark, sf_dir).select(F.col("table_schema").alias("schema_name")).distinct()
    return catalog.list_schemas(schemata, "W")


@query(
    f"""WITH {LIVE_SQL}
SELECT DISTINCT table_name AS name, 'VIEW' AS table_type FROM harvested
WHERE connection = 'c2' AND table_schema = 'wh' AND contains(lower(table_name), '2')"""
)
def tables_matching(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = (
        live(spark, sf_dir)
        .select("connection", "table_schema", "table_name", F.lit("view").alias("table_type"))
        .distinct()
    )
    return catalog.browse(
        tables, tables, tables, tables, connection="c2", schema="wh", search="2"
    )


@query(
    f"""WITH {LIVE_SQL}
SELECT name, data_type, nullable, pos AS ordinal_position FROM harvested
WHERE table_schema = 'a' AND table_name = 'b.c'"""
)
def columns_of_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return catalog.list_columns(catalog.lower_columns(harvested(spark, sf_dir)), "a", "b.c")


@query(
    f"""WITH {LIVE_SQL},
wanted AS (SELECT DISTINCT 'wh' AS table_schema, 't' || o_custkey % 60 AS table_name FROM orders)
SELECT w.table_schema, w.table_name, coalesce(name, '') AS name, coalesce(data_type, '') AS data_type,
       coalesce(nullable::VARCHAR, '') AS nullable, coalesce(pos::VARCHAR, '') AS ordinal_position,
       name IS NOT NULL AS found
FROM wanted w LEFT JOIN harvested h ON h.table_schema = w.table_schema AND h.table_name = w.table_name"""
)
def columns_for_requested(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = table(spark, sf_dir, "orders").select(
        F.lit("wh").alias("table_schema"),
        F.concat(F.lit("t"), (F.col("o_custkey") % 60).cast("string")).alias("table_name"),
    )
    out = catalog.columns_for_requested(
        catalog.lower_columns(harvested(spark, sf_dir)), requested
    )
    return out.select(
        "table_schema", "table_name", text("name"), text("data_type"), text("nullable"),
        text("ordinal_position"), "found",
    )


@query(
    """
WITH f AS (SELECT user_id, event_type, max(ts) AS fetched_at FROM events
           WHERE event_type <> 'error' GROUP BY 1, 2),
r AS (SELECT DISTINCT user_id, event_type FROM events)
SELECT r.user_id, r.event_type,
       coalesce(epoch_us(TIMESTAMP '2024-01-30 23:00:00') - epoch_us(f.fetched_at) > 86400000000, true) AS stale
FROM r LEFT JOIN f USING (user_id, event_type)"""
)
def stale_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    fetched = events.where("event_type <> 'error'").select(
        "user_id", "event_type", F.col("ts").alias("fetched_at")
    )
    requested = events.select("user_id", "event_type").distinct()
    out = catalog.split_stale(
        requested,
        fetched,
        ["user_id", "event_type"],
        F.lit("2024-01-30 23:00:00").cast("timestamp"),
        ttl_seconds=86_400,
    )
    return out.select("user_id", "event_type", "stale")


@query(
    """
SELECT p_partkey,
       CASE WHEN p_size % 3 = 0 THEN CASE WHEN p_size % 2 = 0 THEN 'varchar(max)'
                 ELSE 'varchar(' || p_size || ')' END
            WHEN p_size % 3 = 1 THEN 'decimal(' || p_size || ','
                 || CASE WHEN p_size % 2 = 0 THEN 0 ELSE 2 END || ')'
            ELSE lower(p_type) END AS data_type
FROM part"""
)
def type_render(spark: SparkSession, sf_dir: str) -> DataFrame:
    size = F.col("p_size")
    raw = F.when(size % 3 == 0, "varchar").when(size % 3 == 1, "decimal")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        catalog.render_type(
            catalog.preferred_type(raw, F.lower("p_type")),
            F.when(size % 2 == 0, -1).otherwise(size),
            size,
            F.when(size % 2 == 1, 2),
        ).alias("data_type"),
    )


@query(
    """
SELECT 'hit' AS probe, true AS ok, max(o_orderkey)::VARCHAR AS value, '' AS reason FROM orders
UNION ALL SELECT 'empty', false, '', 'no_rows'
UNION ALL SELECT 'null', max(o_orderkey) IS NOT NULL, coalesce(max(o_orderkey)::VARCHAR, ''),
       CASE WHEN max(o_orderkey) IS NULL THEN 'null_value' ELSE '' END FROM orders WHERE o_totalprice < 0"""
)
def scalar_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    probes = {
        "hit": orders.agg(F.max("o_orderkey")),
        "empty": orders.where("o_totalprice < 0").select("o_orderkey"),
        "null": orders.where("o_totalprice < 0").agg(F.max("o_orderkey")),
    }
    out = None
    for name, df in probes.items():
        row = catalog.scalar_status(df).select(F.lit(name).alias("probe"), "ok", "value", "reason")
        out = row if out is None else out.unionByName(row)
    return out
