"""Change-application queries: states and change rows derived from the star tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import changes
from tessera.plans.registry import query, table, text


def _num(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def _joined(column: str) -> Column:
    return F.array_join(column, ",").alias(column)


# -- upserts -------------------------------------------------------------------


def _measures(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("c_custkey")
    state = (
        table(spark, sf_dir, "customer")
        .where(k % 3 != 0)
        .select(
            _num("p", k % 7).alias("project_id"),
            k.alias("pos"),
            F.col("c_name").alias("name"),
            F.col("c_mktsegment").alias("definition"),
            F.lit("sum(x)").alias("formula"),
            _num("n", F.col("c_nationkey")).alias("owner"),
        )
    )
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        _num("p", F.col("o_custkey") % 7).alias("project_id"),
        o.alias("seq"),
        F.concat(
            F.lit(" Customer#"), F.lpad(F.col("o_custkey").cast("string"), 9, "0")
        ).alias("name"),
        F.when(o % 50 == 0, "  ").otherwise(F.col("o_orderpriority")).alias("definition"),
        F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("o_orderstatus")).alias("formula"),
        F.lit(None).cast("string").alias("owner"),
    )
    return changes.upsert_measures(state, rows)


_MEASURES_SQL = """
WITH state AS (
  SELECT 'p' || c_custkey % 7 AS project_id, c_custkey AS pos, c_name AS name,
         c_mktsegment AS definition, 'sum(x)' AS formula, 'n' || c_nationkey AS owner
  FROM customer WHERE c_custkey % 3 <> 0),
ch AS (
  SELECT 'p' || o_custkey % 7 AS project_id, o_orderkey AS seq,
         'Customer#' || lpad(o_custkey::VARCHAR, 9, '0') AS name, o_orderpriority AS definition,
         CASE WHEN o_orderstatus = 'P' THEN '' ELSE o_orderstatus END AS formula,
         o_orderkey % 50 = 0 AS bad
  FROM orders),
last AS (SELECT *, row_number() OVER (PARTITION BY project_id, name ORDER BY seq DESC) AS rn,
                min(seq) OVER (PARTITION BY project_id, name) AS first_seq FROM ch WHERE NOT bad)"""


@query(
    _MEASURES_SQL
    + """
SELECT coalesce(s.project_id, c.project_id) AS project_id, coalesce(s.name, c.name) AS name,
       s.name IS NULL AS appended, coalesce(s.pos, c.first_seq) AS pos,
       coalesce(c.definition, s.definition) AS definition,
       CASE WHEN c.name IS NULL THEN s.formula ELSE c.formula END AS formula,
       CASE WHEN c.name IS NULL THEN s.owner ELSE '' END AS owner
FROM state s FULL OUTER JOIN (SELECT * FROM last WHERE rn = 1) c
  ON s.project_id = c.project_id AND s.name = c.name"""
)
def upsert_in_place(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, _ = _measures(spark, sf_dir)
    return state.select(
        "project_id", "name", "appended", "pos", "definition", text("formula"), text("owner")
    )


@query(
    _MEASURES_SQL
    + """
SELECT ch.project_id, ch.seq, ch.name,
       CASE WHEN ch.bad THEN 'rejected' WHEN s.name IS NOT NULL OR ch.seq > l.first_seq THEN 'updated'
            ELSE 'added' END AS outcome,
       CASE WHEN ch.bad THEN 'name and definition are required' ELSE '' END AS reason
FROM ch LEFT JOIN state s USING (project_id, name)
LEFT JOIN (SELECT * FROM last WHERE rn = 1) l ON l.project_id = ch.project_id AND l.name = ch.name"""
)
def upsert_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, outcomes = _measures(spark, sf_dir)
    return outcomes.select("project_id", "seq", "name", "outcome", text("reason"))


def _connections(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("s_suppkey")
    state = table(spark, sf_dir, "supplier").select(
        F.lit("p0").alias("project_id"),
        k.alias("pos"),
        F.col("s_name").alias("name"),
        F.lit("trino").alias("engine"),
        _num("dsn", F.col("s_nationkey")).alias("dsn"),
        F.lit("hive").alias("catalog"),
    )
    o, status = F.col("o_orderkey"), F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select(
        F.lit("p0").alias("project_id"),
        o.alias("seq"),
        F.concat(
            F.lit("Supplier#"), F.lpad((o * 7 % 1500).cast("string"), 9, "0")
        ).alias("name"),
        F.when(status == "F", "trino").when(status == "O", "databricks").otherwise("oracle").alias("engine"),
        _num("new", o).alias("dsn"),
        F.when(o % 2 == 0, " ").otherwise("c").alias("catalog"),
    )
    return changes.upsert_connections(state, rows)


@query(
    """
WITH ch AS (
  SELECT o_orderkey AS seq, 'Supplier#' || lpad((o_orderkey * 7 % 1500)::VARCHAR, 9, '0') AS name,
         CASE o_orderstatus WHEN 'F' THEN 'trino' ELSE 'databricks' END AS engine,
         'new' || o_orderkey AS dsn, CASE WHEN o_orderkey % 2 = 0 THEN ' ' ELSE 'c' END AS catalog
  FROM orders WHERE o_orderstatus IN ('F', 'O') AND NOT (o_orderstatus = 'F' AND o_orderkey % 2 = 0)),
last AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY seq DESC) AS rn FROM ch)
SELECT coalesce(s_name, name) AS name, s_name IS NULL AS appended,
       coalesce(engine, 'trino') AS engine, coalesce(dsn, 'dsn' || s_nationkey) AS dsn,
       coalesce(catalog, 'hive') AS catalog
FROM supplier FULL OUTER JOIN (SELECT * FROM last WHERE rn = 1) l ON s_name = name"""
)
def upsert_connections(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, _ = _connections(spark, sf_dir)
    return state.select("name", "appended", "engine", "dsn", "catalog")


def glossary_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select(
        F.lit("p0").alias("project_id"),
        F.col("item_id").alias("pos"),
        _num("term ", F.col("item_id")).alias("term"),
        F.col("text").alias("definition"),
    )


def glossary_changes(conversations: DataFrame) -> DataFrame:
    """Changes of ``conversations`` rows, batch or stream."""
    return conversations.select(
        F.lit("p0").alias("project_id"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"),
        F.concat(F.lit(" term "), (F.col("conv_id") % 60).cast("string")).alias("term"),
        F.col("text").alias("definition"),
    )


GLOSSARY_SQL = """
WITH ch AS (
  SELECT conv_id * 1000 + turn AS seq, 'term ' || conv_id % 60 AS term,
         regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS definition FROM conversations),
good AS (SELECT *, row_number() OVER (PARTITION BY term ORDER BY seq DESC) AS rn
         FROM ch WHERE definition <> '' AND length(definition) <= 1000)
SELECT coalesce(g.term, 'term ' || b.item_id) AS term, b.item_id IS NULL AS appended,
       md5(coalesce(g.definition, b.text)) AS definition
FROM benchmark b FULL OUTER JOIN (SELECT * FROM good WHERE rn = 1) g ON g.term = 'term ' || b.item_id"""


@query(GLOSSARY_SQL)
def upsert_glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = glossary_changes(table(spark, sf_dir, "conversations"))
    state, _ = changes.upsert_glossary(glossary_state(spark, sf_dir), rows)
    return state.select("term", "appended", F.md5("definition").alias("definition"))


# -- patches -------------------------------------------------------------------


def _patched(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("s_suppkey")
    state = table(spark, sf_dir, "supplier").select(
        F.lit("p0").alias("project_id"),
        k.alias("pos"),
        _num("t", k).alias("table_name"),
        F.col("s_name").alias("description"),
        _num("n", F.col("s_nationkey")).alias("owner"),
        F.lit(None).cast("string").alias("grain"),
        F.lit("unknown").alias("refresh_cadence"),
    )
    o = F.col("o_orderkey")
    shape = o % 6
    named = (
        F.when(shape == 0, F.array(F.lit("description")))
        .when(shape == 1, F.array(F.lit("owner")))
        .when(shape == 2, F.array(F.lit("grain"), F.lit("owner")))
        .when(shape == 3, F.array(F.lit("refresh_cadence")))
        .when(shape == 4, F.array(F.lit("table_name"), F.lit("owner")))
        .otherwise(F.array(F.lit("bogus"), F.lit("owner")))
    )
    patches = table(spark, sf_dir, "orders").select(
        F.lit("p0").alias("project_id"),
        o.alias("seq"),
        _num("t", F.col("o_custkey") % 1300).alias("table_name"),
        named.alias("present"),
        F.when(o % 5 != 0, F.col("o_orderpriority")).alias("description"),
        F.when(shape == 2, F.col("o_orderstatus")).alias("owner"),
        F.col("o_orderpriority").alias("grain"),
        F.when(F.col("o_orderstatus") == "P", "hourly").otherwise("often").alias("refresh_cadence"),
    )
    return changes.patch_tables(state, patches)


_PATCH_SQL = """
WITH ch AS (
  SELECT o_orderkey AS seq, 't' || o_custkey % 1300 AS table_name, o_orderkey % 6 AS shape,
         o_orderpriority AS pr, o_orderstatus AS st, o_orderkey % 5 = 0 AS nul FROM orders),
judged AS (
  SELECT *, CASE WHEN shape = 4 THEN 'identity fields cannot be patched'
                 WHEN shape = 5 THEN 'unknown patch fields'
                 WHEN shape = 0 AND nul THEN 'description may not be null'
                 WHEN shape = 3 AND st <> 'P' THEN 'refresh_cadence is not an allowed word' END AS problem
  FROM ch),
good AS (SELECT * FROM judged WHERE problem IS NULL),
folded AS (
  SELECT table_name, min(seq) AS first_seq,
         max_by(pr, seq) FILTER (WHERE shape = 0) AS description,
         max(seq) FILTER (WHERE shape IN (1, 2)) AS owner_seq,
         max_by(pr, seq) FILTER (WHERE shape = 2) AS grain,
         count(*) FILTER (WHERE shape = 3) AS cadence
  FROM good GROUP BY 1)"""


@query(
    _PATCH_SQL
    + """
SELECT coalesce('t' || s_suppkey, f.table_name) AS table_name, s_suppkey IS NULL AS appended,
       coalesce(s_suppkey, first_seq) AS pos, coalesce(description, s_name, '') AS description,
       CASE WHEN owner_seq IS NULL THEN coalesce('n' || s_nationkey, '')
            ELSE coalesce((SELECT st FROM good g WHERE g.seq = owner_seq AND g.shape = 2), '') END AS owner,
       coalesce(grain, '') AS grain,
       CASE WHEN cadence > 0 THEN 'hourly' ELSE 'unknown' END AS refresh_cadence
FROM supplier FULL OUTER JOIN folded f ON f.table_name = 't' || s_suppkey"""
)
def patch_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, _ = _patched(spark, sf_dir)
    return state.select(
        "table_name", "appended", "pos", "description", text("owner"), text("grain"), "refresh_cadence"
    )


@query(
    _PATCH_SQL
    + """
SELECT j.seq, j.table_name,
       CASE WHEN problem IS NOT NULL THEN 'rejected' WHEN s_suppkey IS NOT NULL OR j.seq > first_seq
            THEN 'updated' ELSE 'added' END AS outcome, coalesce(problem, '') AS reason
FROM judged j LEFT JOIN folded f USING (table_name) LEFT JOIN supplier ON 't' || s_suppkey = j.table_name"""
)
def patch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, outcomes = _patched(spark, sf_dir)
    return outcomes.select("seq", "table_name", "outcome", text("reason"))


@query(
    """
WITH ch AS (SELECT o_orderkey AS seq, o_custkey AS k, o_orderpriority AS pr, o_orderstatus AS st FROM orders),
f AS (SELECT k, max_by(pr, seq) FILTER (WHERE st = 'F') AS description,
             count(*) FILTER (WHERE st = 'O') AS starred FROM ch GROUP BY 1)
SELECT 'p' || c_custkey AS project_id, coalesce(description, c_name) AS description,
       CASE WHEN starred > 0 THEN 'star' ELSE 'unspecified' END AS modeling_paradigm,
       CASE WHEN description IS NOT NULL OR starred > 0 THEN 'now' ELSE 'before' END AS updated_at
FROM customer LEFT JOIN f ON k = c_custkey"""
)
def patch_project_config(spark: SparkSession, sf_dir: str) -> DataFrame:
    projects = table(spark, sf_dir, "customer").select(
        _num("p", F.col("c_custkey")).alias("project_id"),
        F.col("c_name").alias("description"),
        F.lit("unspecified").alias("modeling_paradigm"),
        F.lit("before").alias("updated_at"),
    )
    status = F.col("o_orderstatus")
    patches = table(spark, sf_dir, "orders").select(
        _num("p", F.col("o_custkey")).alias("project_id"),
        F.col("o_orderkey").alias("seq"),
        F.when(status == "F", F.array(F.lit("description")))
        .when(status == "O", F.array(F.lit("modeling_paradigm")))
        .otherwise(F.array().cast("array<string>"))
        .alias("present"),
        F.col("o_orderpriority").alias("description"),
        F.lit("star").alias("modeling_paradigm"),
    )
    patched, outcomes = changes.patch_project_config(projects, patches)
    return changes.stamp(patched, outcomes, F.lit("now")).select(
        "project_id", "description", "modeling_paradigm", "updated_at"
    )


# -- appends -------------------------------------------------------------------


def _tables(spark: SparkSession, sf_dir: str, n: int) -> DataFrame:
    """Tables t0 .. t(n-1) as far as the parts cover them."""
    return (
        table(spark, sf_dir, "part")
        .select((F.col("p_partkey") % n).alias("pos"))
        .distinct()
        .select(F.lit("p0").alias("project_id"), "pos", _num("t", F.col("pos")).alias("table_name"))
    )


def _relationships(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    k = F.col("s_suppkey")
    state = table(spark, sf_dir, "supplier").select(
        F.lit("p0").alias("project_id"),
        _num("t", k % 40).alias("table_name"),
        k.alias("pos"),
        _num("d", k % 7).alias("to_table"),
        F.array(F.lit("1-URGENT")).alias("from_columns"),
        F.array(F.lit("id")).alias("to_columns"),
        F.lit("many_to_many").alias("cardinality"),
        F.lit("old").alias("description"),
    )
    o, status = F.col("o_orderkey"), F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select(
        F.lit("p0").alias("project_id"),
        o.alias("seq"),
        _num("t", F.col("o_custkey") % 40).alias("table_name"),
        _num("d", o % 7).alias("to_table"),
        F.array("o_orderpriority").alias("from_columns"),
        F.when(o % 23 == 0, F.array(F.lit("id"), F.lit("x"))).otherwise(F.array(F.lit("id"))).alias("to_columns"),
        F.when(status == "F", "one_to_many").when(status == "O", "one_to_one").otherwise("odd").alias("cardinality"),
        F.col("o_orderstatus").alias("description"),
    )
    return changes.add_relationship(state, _tables(spark, sf_dir, 35), rows)


_RELATIONSHIPS_SQL = """
WITH ch AS (
  SELECT o_orderkey AS seq, 't' || o_custkey % 40 AS table_name, 'd' || o_orderkey % 7 AS to_table,
         o_orderpriority AS from_columns,
         CASE WHEN o_orderkey % 23 = 0 THEN 'id,x' ELSE 'id' END AS to_columns,
         CASE o_orderstatus WHEN 'F' THEN 'one_to_many' ELSE 'one_to_one' END AS cardinality,
         o_orderstatus AS description,
         CASE WHEN o_orderkey % 23 = 0 THEN 'key column lists must be of equal length and not empty'
              WHEN o_orderstatus = 'P' THEN 'unknown cardinality'
              WHEN o_custkey % 40 >= 35 THEN 'unknown table' END AS problem
  FROM orders),
every AS (
  SELECT false AS appended, s_suppkey AS pos, 't' || s_suppkey % 40 AS table_name, 'd' || s_suppkey % 7 AS to_table,
         '1-URGENT' AS from_columns, 'id' AS to_columns, 'many_to_many' AS cardinality, 'old' AS description
  FROM supplier
  UNION ALL SELECT true, seq, table_name, to_table, from_columns, to_columns, cardinality, description
  FROM ch WHERE problem IS NULL),
ranked AS (SELECT *, row_number() OVER (PARTITION BY table_name, to_table, from_columns, to_columns
                                        ORDER BY appended, pos) AS rn FROM every)"""


@query(
    _RELATIONSHIPS_SQL
    + """
SELECT table_name, to_table, from_columns, to_columns, appended, pos, cardinality, description
FROM ranked WHERE rn = 1"""
)
def append_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    state, _ = _relationships(spark, sf_dir)
    return state.select(
        "table_name", "to_table", _joined("from_columns"), _joined("to_columns"), "appended", "pos",
        "cardinality", "description",
    )


@query(
    _RELATIONSHIPS_SQL
    + """
SELECT ch.seq, CASE WHEN problem IS NOT NULL THEN 'rejected' WHEN r.rn = 1 THEN 'added'
                    ELSE 'already recorded' END AS outcome, coalesce(problem, '') AS reason
FROM ch LEFT JOIN ranked r ON r.appended AND r.pos = ch.seq"""
)
def append_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, outcomes = _relationships(spark, sf_dir)
    return outcomes.select("seq", "outcome", text("reason"))


@query(
    """
WITH ch AS (SELECT o_orderkey AS seq, 't' || o_custkey % 40 AS table_name, o_orderpriority AS ref,
                   o_orderstatus AS description FROM orders WHERE o_custkey % 40 < 35)
SELECT table_name, ref, min(seq) AS pos, min_by(description, seq) AS description FROM ch GROUP BY 1, 2"""
)
def append_upstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").select(
        F.lit("p0").alias("project_id"),
        F.col("o_orderkey").alias("seq"),
        _num("t", F.col("o_custkey") % 40).alias("table_name"),
        F.col("o_orderpriority").alias("ref"),
        F.col("o_orderstatus").alias("description"),
    )
    empty = rows.select(
        "project_id", "table_name", F.col("seq").alias("pos"), "ref", "description"
    ).where(F.lit(False))
    state, _ = changes.add_upstream(empty, _tables(spark, sf_dir, 35), rows)
    return state.select("table_name", "ref", "pos", "description")


@query(
    """
WITH ch AS (SELECT conv_id * 1000 + turn AS seq, 't' || conv_id % 20 AS table_name,
                   regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS message FROM conversations)
SELECT table_name, md5(message) AS message, min(seq) AS pos FROM ch
WHERE message <> '' AND length(message) <= 240 AND table_name NOT IN ('t18', 't19') GROUP BY 1, 2"""
)
def append_pitfalls(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "conversations").select(
        F.lit("p0").alias("project_id"),
        (F.col("conv_id") * 1000 + F.col("turn")).alias("seq"),
        _num("t", F.col("conv_id") % 20).alias("table_name"),
        F.col("text").alias("message"),
    )
    empty = rows.select(
        "project_id", "table_name", F.col("seq").alias("pos"), "message"
    ).where(F.lit(False))
    state, _ = changes.add_pitfall(empty, _tables(spark, sf_dir, 18), rows)
    return state.select("table_name", F.md5("message").alias("message"), "pos")


# -- flags ---------------------------------------------------------------------


def _columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.lit("p0").alias("project_id"),
        _num("t", k % 50).alias("table_name"),
        k.alias("pos"),
        _num("c", k).alias("name"),
        (k % 10 == 0).alias("is_primary_key"),
        F.lit("unspecified").alias("classification"),
    )


def _keyed(spark: SparkSession, sf_dir: str):
    o = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.lit("p0").alias("project_id"),
        o.alias("seq"),
        _num("t", o % 60).alias("table_name"),
        F.when(o % 90 == 4, F.array().cast("array<string>"))
        .otherwise(F.array(_num("c", o % 60 + 50 * (F.col("o_custkey") % 4)), _num("c", o % 2100)))
        .alias("columns"),
    )
    tables = _tables(spark, sf_dir, 50).withColumn(
        "primary_keys", F.array().cast("array<string>")
    )
    return changes.set_primary_key(tables, _columns(spark, sf_dir), rows)


_KEYED_SQL = """
WITH ch AS (SELECT o_orderkey AS seq, 't' || o_orderkey % 60 AS table_name, o_orderkey % 60 < 50 AS known,
                   CASE WHEN o_orderkey % 90 = 4 THEN [] ELSE
                     ['c' || (o_orderkey % 60 + 50 * (o_custkey % 4)), 'c' || o_orderkey % 2100] END AS cols
            FROM orders),
pk AS (SELECT table_name, max_by(cols, seq) AS cols FROM ch WHERE known GROUP BY 1)"""


@query(
    _KEYED_SQL
    + """
SELECT 't' || p_partkey % 50 AS table_name, 'c' || p_partkey AS name,
       CASE WHEN pk.table_name IS NULL THEN p_partkey % 10 = 0
            ELSE list_contains(cols, 'c' || p_partkey) END AS is_primary_key,
       coalesce(array_to_string(cols, ','), '') AS primary_keys
FROM part LEFT JOIN pk ON pk.table_name = 't' || p_partkey % 50"""
)
def set_primary_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables, columns, _, _ = _keyed(spark, sf_dir)
    stored = tables.select("table_name", _joined("primary_keys"))
    return columns.join(stored, "table_name").select(
        "table_name", "name", "is_primary_key", "primary_keys"
    )


@query(
    _KEYED_SQL
    + """
SELECT seq, table_name, c AS name FROM (SELECT seq, table_name, unnest(cols) AS c FROM ch WHERE known)
WHERE (table_name, c) NOT IN (SELECT ('t' || p_partkey % 50, 'c' || p_partkey) FROM part)"""
)
def unlisted_key_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, _, _, unlisted = _keyed(spark, sf_dir)
    return unlisted.select("seq", "table_name", "name")


@query(
    """
WITH ch AS (SELECT o_orderkey AS seq, 't' || (o_orderkey % 2100) % 50 AS table_name, 'c' || o_orderkey % 2100 AS name,
              CASE o_orderstatus WHEN 'F' THEN 'pii' WHEN 'O' THEN 'internal' END AS classification FROM orders),
f AS (SELECT table_name, name, max_by(classification, seq) AS classification FROM ch
      WHERE classification IS NOT NULL GROUP BY 1, 2)
SELECT 't' || p_partkey % 50 AS table_name, 'c' || p_partkey AS name,
       coalesce(classification, 'unspecified') AS classification
FROM part LEFT JOIN f ON f.table_name = 't' || p_partkey % 50 AND f.name = 'c' || p_partkey"""
)
def set_classifications(spark: SparkSession, sf_dir: str) -> DataFrame:
    k, status = F.col("o_orderkey") % 2100, F.col("o_orderstatus")
    rows = table(spark, sf_dir, "orders").select(
        F.lit("p0").alias("project_id"),
        F.col("o_orderkey").alias("seq"),
        _num("t", k % 50).alias("table_name"),
        _num("c", k).alias("name"),
        F.when(status == "F", "pii").when(status == "O", "internal").otherwise("secret").alias("classification"),
    )
    columns, _ = changes.set_classification(_columns(spark, sf_dir), rows)
    return columns.select("table_name", "name", "classification")


@query(
    """
WITH ch AS (SELECT doc_id AS seq, 't' || doc_id % 60 AS table_name, text AS grain FROM documents
            WHERE length(text) <= 240),
f AS (SELECT table_name, max_by(grain, seq) AS grain FROM ch GROUP BY 1)
SELECT DISTINCT 't' || p_partkey % 50 AS table_name, md5(coalesce(nullif(grain, ''), '')) AS grain
FROM part LEFT JOIN f ON f.table_name = 't' || p_partkey % 50"""
)
def set_grains(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "documents").select(
        F.lit("p0").alias("project_id"),
        F.col("doc_id").alias("seq"),
        _num("t", F.col("doc_id") % 60).alias("table_name"),
        F.col("text").alias("grain"),
    )
    tables = _tables(spark, sf_dir, 50).withColumn("grain", F.lit(None).cast("string"))
    updated, _ = changes.set_table_grain(tables, rows)
    return updated.select("table_name", F.md5(F.coalesce("grain", F.lit(""))).alias("grain"))


@query(
    """
SELECT 'columns/' || source || '/' || doc_id || '/description' AS path, 'at most 500 characters' AS rule,
       'enforced' AS severity, length(text) AS value_length FROM documents WHERE length(text) > 500
UNION ALL
SELECT 'columns/' || source || '/' || doc_id || '/classification', 'allowed word', 'enforced', length(lang)
FROM documents
UNION ALL
SELECT 'tables/' || doc_id || '/description', 'at most 8000 characters', 'enforced', length(text)
FROM documents WHERE length(text) > 8000
UNION ALL
SELECT 'tables/' || doc_id || '/owner', 'at most 240 characters', 'enforced', length(text)
FROM documents WHERE length(text) > 240
UNION ALL
SELECT 'tables/' || doc_id || '/pitfalls/1', 'at most 240 characters', 'documented', length(text)
FROM documents WHERE length(text) > 240
UNION ALL
SELECT 'connections/' || p_partkey || '/engine', 'allowed word', 'enforced', length(p_type) FROM part
UNION ALL
SELECT 'upstream/x/' || doc_id || '/description', 'at most 500 characters', 'documented', length(text)
FROM documents WHERE length(text) > 500"""
)
def violations(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    base = [F.lit("p0").alias("project_id"), F.col("doc_id").alias("pos")]
    columns = docs.select(
        *base,
        F.col("source").alias("table_name"),
        F.lit("c").alias("name"),
        F.col("text").alias("description"),
        F.col("lang").alias("classification"),
    )
    tables = docs.select(
        *base,
        F.col("source").alias("table_name"),
        F.col("text").alias("description"),
        F.col("text").alias("owner"),
        F.array(F.lit("short"), F.col("text")).alias("pitfalls"),
        F.lit("daily").alias("refresh_cadence"),
    )
    connections = table(spark, sf_dir, "part").select(
        F.lit("p0").alias("project_id"),
        F.col("p_partkey").alias("pos"),
        F.col("p_name").alias("name"),
        F.col("p_type").alias("engine"),
        F.col("p_name").alias("dsn"),
    )
    upstream = docs.select(
        *base, F.lit("x").alias("table_name"), F.lit("r").alias("ref"), F.col("text").alias("description")
    )
    found = changes.violations(columns, "columns")
    for rows, entity in ((tables, "tables"), (connections, "connections"), (upstream, "upstream")):
        found = found.unionByName(changes.violations(rows, entity))
    return found.drop("project_id")
