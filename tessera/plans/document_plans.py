"""Project documents, one JSON text per customer, and what is read from them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.functions.text import slug
from tessera.operators import documents, rendering
from tessera.plans.registry import dealt, query, table, text
from tessera.sources import projects


def _num(prefix: str, n: Column) -> Column:
    return F.concat(F.lit(prefix), n.cast("string"))


def _doc_columns(k: Column, i: Column) -> Column:
    return F.transform(
        F.sequence(F.lit(1).cast("long"), 1 + (k + i) % 3),
        lambda j: F.struct(
            _num("k", j).alias("name"),
            F.lit("bigint").alias("type"),
            (j != 1).alias("nullable"),
            (j == 1).alias("is_primary_key"),
            F.when(j == 2, "pii").alias("classification"),
            F.when(j == 3, "less < more & so").alias("description"),
            F.when(j == 3, F.array(F.lit("a"), F.lit("b"))).alias("example_values"),
        ),
    )


def _doc_table(k: Column, i: Column) -> Column:
    nothing = F.array()
    return F.struct(
        _num("t", i).alias("table_name"),
        F.when(i % 2 == 0, "main").alias("connection"),
        F.when(i == 1, 'say "hi" & <go>').alias("description"),
        F.when(i == 2, "one row per k1").alias("grain"),
        F.when(i == 3, "daily").alias("refresh_cadence"),
        F.when(i == 3, "by noon").alias("refresh_notes"),
        F.when(i == 1, k * 1000 + i).alias("row_count_last_run"),
        F.array(F.lit("k1")).alias("primary_keys"),
        F.when(i == 4, F.array(F.lit("x"), F.lit("y"))).alias("aliases"),
        F.when(i == 4, F.array(F.lit("mind the gap"))).alias("pitfalls"),
        F.when(
            i == 2,
            F.struct(F.lit("scd2").alias("type"), F.lit("vf").alias("valid_from")),
        ).alias("scd"),
        _doc_columns(k, i).alias("columns"),
        F.when(
            i > 1,
            F.array(
                F.struct(
                    F.lit("t1").alias("to_table"),
                    F.array(F.lit("k1")).alias("from_columns"),
                    F.array(F.lit("k1")).alias("to_columns"),
                    F.lit("one_to_many").alias("cardinality"),
                )
            ),
        )
        .otherwise(nothing)
        .alias("relationships"),
        F.when(i > 1, F.array(F.struct(_num("t", i - 1).alias("ref"))))
        .otherwise(nothing)
        .alias("upstream"),
    )


def project_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(file, content)``; every 13th text is cut off."""
    k = F.col("c_custkey")
    doc = F.struct(
        F.lit(1).alias("schema_version"),
        F.when(k % 2 == 0, "2024-01-01T00:00:00Z").alias("updated_at"),
        F.lit("dropped").alias("unknown_field"),
        F.struct(
            F.col("c_name").alias("name"),
            F.when(k % 3 == 0, "star").alias("modeling_paradigm"),
            F.col("c_mktsegment").alias("description"),
            F.when(
                k % 2 == 0,
                F.array(
                    F.struct(F.lit("churn").alias("term"), F.lit("left us").alias("definition"))
                ),
            ).alias("glossary"),
            F.when(
                k % 5 == 0,
                F.array(
                    F.struct(
                        F.lit("n").alias("name"),
                        F.lit("rows").alias("definition"),
                        F.lit("count(*)").alias("formula"),
                    )
                ),
            ).alias("measures"),
        ).alias("project"),
        F.array(
            F.struct(
                F.lit("main").alias("name"),
                F.lit("trino").alias("engine"),
                _num("d", F.col("c_nationkey")).alias("dsn"),
                F.lit("hive").alias("catalog"),
            )
        ).alias("connections"),
        F.transform(
            F.sequence(F.lit(1).cast("long"), 1 + k % 4), lambda i: _doc_table(k, i)
        ).alias("tables"),
    )
    content = F.to_json(doc)
    return dealt(table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment"), "c_custkey").select(
        F.concat(F.lit("/projects/c"), k.cast("string"), F.lit(".json")).alias("file"),
        F.when(k % 13 == 0, F.substring(content, 1, 60)).otherwise(content).alias("content"),
    )


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projects.parse_projects(project_files(spark, sf_dir))


@query(
    """
SELECT 'c' || c_custkey || '.json' AS file,
       CASE WHEN c_custkey % 13 = 0 THEN '<unparseable>' ELSE c_name END AS name,
       CASE WHEN c_custkey % 13 <> 0 AND c_custkey % 2 = 0 THEN '2024-01-01T00:00:00Z' ELSE '' END AS updated_at
FROM customer"""
)
def list_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return projects.list_projects(parsed(spark, sf_dir))


_TABLES_SQL = """
WITH c AS (SELECT c_custkey AS k, 'c' || c_custkey || '.json' AS project_id, c_name, c_mktsegment, c_nationkey
           FROM customer WHERE c_custkey % 13 <> 0),
t AS (SELECT *, unnest(range(1, 2 + k % 4)) AS i FROM c)"""


@query(
    _TABLES_SQL
    + """
SELECT 'projects' AS entity, project_id, 0::BIGINT AS pos, c_name AS name,
       CASE WHEN k % 3 = 0 THEN 'star' ELSE 'unspecified' END AS value FROM c
UNION ALL SELECT 'connections', project_id, 0, 'main', 'd' || c_nationkey FROM c
UNION ALL SELECT 'glossary', project_id, 0, 'churn', 'left us' FROM c WHERE k % 2 = 0
UNION ALL SELECT 'measures', project_id, 0, 'n', 'count(*)' FROM c WHERE k % 5 = 0
UNION ALL SELECT 'tables', project_id, i - 1, 't' || i, CASE WHEN i = 3 THEN 'daily' ELSE 'unknown' END FROM t
UNION ALL SELECT 'columns', project_id, j - 1, 't' || i || '.k' || j,
                 CASE WHEN j = 2 THEN 'pii' ELSE 'unspecified' END
          FROM (SELECT *, unnest(range(1, 2 + (k + i) % 3)) AS j FROM t)
UNION ALL SELECT 'relationships', project_id, 0, 't' || i, 't1:k1=k1' FROM t WHERE i > 1
UNION ALL SELECT 'upstream', project_id, 0, 't' || i, 't' || (i - 1) FROM t WHERE i > 1"""
)
def flatten_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All eight tables; the documents are parsed once and then read by column."""
    flat = documents.flatten(projects.parsed_once(parsed(spark, sf_dir)))
    shown = {
        "projects": (F.lit(0), F.col("name"), F.col("modeling_paradigm")),
        "connections": (F.col("pos"), F.col("name"), F.col("dsn")),
        "glossary": (F.col("pos"), F.col("term"), F.col("definition")),
        "measures": (F.col("pos"), F.col("name"), F.col("formula")),
        "tables": (F.col("pos"), F.col("table_name"), F.col("refresh_cadence")),
        "columns": (
            F.col("pos"),
            F.concat_ws(".", "table_name", "name"),
            F.col("classification"),
        ),
        "relationships": (
            F.col("pos"),
            F.col("table_name"),
            F.format_string(
                "%s:%s=%s", F.col("to_table"), F.array_join("from_columns", ","),
                F.array_join("to_columns", ","),
            ),
        ),
        "upstream": (F.col("pos"), F.col("table_name"), F.col("ref")),
    }
    out = None
    for entity, (pos, name, value) in shown.items():
        rows = flat[entity].select(
            F.lit(entity).alias("entity"),
            "project_id",
            pos.cast("long").alias("pos"),
            name.alias("name"),
            value.alias("value"),
        )
        out = rows if out is None else out.unionByName(rows)
    return out


@query(
    _TABLES_SQL
    + """
SELECT project_id, 't2' AS table_name, 'main' AS connection, 'one row per k1' AS grain FROM t WHERE i = 2"""
)
def find_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = documents.flatten(parsed(spark, sf_dir))["tables"]
    return documents.find(tables, "table_name", "t2").select(
        "project_id", "table_name", "connection", "grain"
    )


@query(
    _TABLES_SQL
    + """
SELECT project_id, 't' || (i - 1) AS ref, i - 1 AS table_pos, 't' || i AS table_name FROM t WHERE i > 1"""
)
def downstream(spark: SparkSession, sf_dir: str) -> DataFrame:
    flat = documents.flatten(parsed(spark, sf_dir))
    return documents.downstream(flat["upstream"], flat["tables"]).select(
        "project_id", "ref", F.col("table_pos").cast("long").alias("table_pos"), "table_name"
    )


@query(
    """
WITH e AS (SELECT o_custkey % 50 AS t, o_orderpriority AS ref FROM orders)
SELECT 'p0' AS project_id, ref, count(*) AS n_declared, min('t' || t) AS first_table FROM e GROUP BY ref"""
)
def downstream_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Few sources with very many readers each."""
    edges = table(spark, sf_dir, "orders").select(
        F.lit("p0").alias("project_id"),
        _num("t", F.col("o_custkey") % 50).alias("table_name"),
        F.col("o_orderpriority").alias("ref"),
    )
    return documents.downstream_counts(edges)


@query(
    _TABLES_SQL
    + """,
cols AS (
  SELECT k, i, string_agg('      <column name="t' || i || '.k' || j || '" raw_name="k' || j || '" type="bigint"'
      || CASE j WHEN 1 THEN ' pk="true" not_null="true"/>' WHEN 2 THEN ' classification="pii"/>'
         ELSE '>' || chr(10) || '        <description>less &lt; more &amp; so</description>' || chr(10)
              || '        <example_values>a, b</example_values>' || chr(10) || '      </column>' END,
      chr(10) ORDER BY j) AS body
  FROM (SELECT *, unnest(range(1, 2 + (k + i) % 3)) AS j FROM t) GROUP BY 1, 2),
tabs AS (
  SELECT t.k, t.i, '  <table name="t' || t.i || '"' || CASE WHEN t.i % 2 = 0 THEN ' connection="main"' ELSE '' END
    || CASE WHEN t.i = 3 THEN ' refresh_cadence="daily"' ELSE '' END
    || CASE WHEN t.i = 1 THEN ' row_count_last_run="' || (t.k * 1000 + 1) || '"' ELSE '' END || '>' || chr(10)
    || CASE t.i WHEN 1 THEN '    <description>say "hi" &amp; &lt;go&gt;</description>' || chr(10)
       WHEN 2 THEN '    <grain>one row per k1</grain>' || chr(10) || '    <scd type="scd2" valid_from="vf"/>' || chr(10)
       WHEN 3 THEN '    <refresh_notes>by noon</refresh_notes>' || chr(10)
       ELSE '    <aliases>x, y</aliases>' || chr(10) || '    <pitfalls>' || chr(10)
            || '      <pitfall>mind the gap</pitfall>' || chr(10) || '    </pitfalls>' || chr(10) END
    || '    <primary_key>k1</primary_key>' || chr(10) || '    <columns>' || chr(10) || body || chr(10)
    || '    </columns>' || chr(10)
    || CASE WHEN t.i > 1 THEN '    <relationships>' || chr(10) || '      <relationship from="t' || t.i
       || '.k1" to="t1.k1" cardinality="one_to_many">Each t' || t.i || ' relates to one t1; a t1 has many t' || t.i
       || '.</relationship>' || chr(10) || '    </relationships>' || chr(10) || '    <upstream>' || chr(10)
       || '      <depends_on ref="t' || (t.i - 1) || '">t' || t.i || ' reads from t' || (t.i - 1)
       || '.</depends_on>' || chr(10) || '    </upstream>' || chr(10) ELSE '' END
    || CASE WHEN t.i < 1 + t.k % 4 THEN '    <downstream>t' || (t.i + 1) || '</downstream>' || chr(10) ELSE '' END
    || '  </table>' || chr(10) AS body
  FROM t JOIN cols ON cols.k = t.k AND cols.i = t.i),
every AS (SELECT k, string_agg(body, '' ORDER BY i % 2, i) AS body FROM tabs GROUP BY 1)
SELECT project_id, '<project name="' || c_name || '" dialect="tsql"'
    || CASE WHEN c.k % 3 = 0 THEN ' paradigm="star"' ELSE '' END || '>' || chr(10)
    || '  <description>' || c_mktsegment || '</description>' || chr(10)
    || CASE WHEN c.k % 2 = 0 THEN '  <glossary>' || chr(10) || '    <term name="churn">left us</term>' || chr(10)
       || '  </glossary>' || chr(10) ELSE '' END
    || CASE WHEN c.k % 5 = 0 THEN '  <measures>' || chr(10) || '    <measure name="n">' || chr(10)
       || '      <definition>rows</definition>' || chr(10) || '      <formula>count(*)</formula>' || chr(10)
       || '    </measure>' || chr(10) || '  </measures>' || chr(10) ELSE '' END
    || '  <connection name="main" engine="trino" catalog="hive">' || chr(10) || '    <dsn>d' || c_nationkey
    || '</dsn>' || chr(10) || '  </connection>' || chr(10) || body || '</project>' || chr(10) AS text
FROM c JOIN every ON every.k = c.k"""
)
def render_xml(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendering.render_xml(parsed(spark, sf_dir).where("ok"))


@query(
    _TABLES_SQL
    + """,
cols AS (
  SELECT k, i, string_agg('- `k' || j || '` bigint' || CASE j WHEN 1 THEN '  _(PK, NOT NULL)_' WHEN 2 THEN '  _(PII)_'
      ELSE ' — less < more & so' || chr(10) || '    - Examples: a, b' END, chr(10) ORDER BY j) AS body
  FROM (SELECT *, unnest(range(1, 2 + (k + i) % 3)) AS j FROM t) GROUP BY 1, 2),
tabs AS (
  SELECT t.k, t.i, chr(10) || '### t' || t.i || chr(10)
    || CASE WHEN t.i % 2 = 0 THEN '- Connection: `main`' || chr(10) ELSE '' END
    || CASE t.i WHEN 1 THEN '- Row count: ' || format('{:,}', t.k * 1000 + 1) || chr(10) || chr(10) || 'say "hi" & <go>' || chr(10)
       WHEN 2 THEN '- Grain: one row per k1' || chr(10) || '- SCD: type=scd2, valid_from=vf' || chr(10)
       WHEN 3 THEN '- Refresh: `daily` — by noon' || chr(10)
       ELSE '- Aliases: x, y' || chr(10) || chr(10) || 'Pitfalls:' || chr(10) || '- mind the gap' || chr(10) END
    || chr(10) || 'PK: `k1`' || chr(10) || chr(10) || 'Columns:' || chr(10) || body || chr(10)
    || CASE WHEN t.i > 1 THEN chr(10) || 'Relationships:' || chr(10) || '- t' || t.i || '.k1 → t1.k1 (one_to_many)' || chr(10)
       || chr(10) || 'Upstream:' || chr(10) || '- `t' || (t.i - 1) || '`' || chr(10) ELSE '' END
    || CASE WHEN t.i < 1 + t.k % 4 THEN chr(10) || 'Downstream: t' || (t.i + 1) || chr(10) ELSE '' END AS body
  FROM t JOIN cols ON cols.k = t.k AND cols.i = t.i),
every AS (SELECT k, string_agg(body, '' ORDER BY i) AS body FROM tabs GROUP BY 1)
SELECT project_id, '# ' || c_name || chr(10) || chr(10) || c_mktsegment || chr(10) || chr(10) || '- Dialect: `tsql`' || chr(10)
    || CASE WHEN c.k % 3 = 0 THEN '- Paradigm: `star`' || chr(10) ELSE '' END
    || CASE WHEN c.k % 2 = 0 THEN chr(10) || '## Glossary (1)' || chr(10) || '- **churn** — left us' || chr(10) ELSE '' END
    || CASE WHEN c.k % 5 = 0 THEN chr(10) || '## Measures (1)' || chr(10) || '- **n** — rows' || chr(10)
       || '    - Formula: `count(*)`' || chr(10) ELSE '' END
    || chr(10) || '## Connections (1)' || chr(10) || '- **main** — trino, dsn=`d' || c_nationkey || '`, catalog=`hive`' || chr(10)
    || chr(10) || '## Tables (' || (1 + c.k % 4) || ')' || chr(10) || body AS text
FROM c JOIN every ON every.k = c.k"""
)
def render_markdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rendering.render_markdown(parsed(spark, sf_dir).where("ok"))


@query(
    """
SELECT 'part' AS kind, p_partkey AS id, regexp_replace(lower(p_name), '[^a-z0-9]+', '_', 'g') AS slug FROM part
UNION ALL SELECT 'customer', c_custkey, regexp_replace(lower(c_name), '[^a-z0-9]+', '_', 'g') FROM customer
UNION ALL SELECT 'page', page_id,
  coalesce(nullif(trim(lower(regexp_replace(url, '[^a-zA-Z0-9]+', '_', 'g')), '_'), ''), 'untitled') FROM pages
UNION ALL SELECT 'conversation', conv_id * 1000 + turn,
  coalesce(nullif(trim(lower(regexp_replace(text, '[^a-zA-Z0-9]+', '_', 'g')), '_'), ''), 'untitled') FROM conversations"""
)
def slugs(spark: SparkSession, sf_dir: str) -> DataFrame:
    sources = (
        ("part", "part", F.col("p_partkey"), "p_name"),
        ("customer", "customer", F.col("c_custkey"), "c_name"),
        ("page", "pages", F.col("page_id"), "url"),
        ("conversation", "conversations", F.col("conv_id") * 1000 + F.col("turn"), "text"),
    )
    out = None
    for kind, name, key, column in sources:
        rows = table(spark, sf_dir, name).select(
            F.lit(kind).alias("kind"), key.alias("id"), slug(F.col(column)).alias("slug")
        )
        out = rows if out is None else out.unionByName(rows)
    return out


_RAW_SQL = """
WITH c AS (SELECT c_custkey AS k, c_name, c_nationkey, c_mktsegment FROM customer),
t AS (
  SELECT k, i, '{"table_name":"t' || i || '"'
    || CASE WHEN i % 2 = 0 THEN ',"connection":"main"' ELSE '' END
    || CASE WHEN i = 1 THEN ',"description":"say \\"hi\\" & <go>"' ELSE '' END
    || CASE WHEN i = 2 THEN ',"grain":"one row per k1"' ELSE '' END
    || CASE WHEN i = 3 THEN ',"refresh_cadence":"daily","refresh_notes":"by noon"' ELSE '' END
    || CASE WHEN i = 1 THEN ',"row_count_last_run":' || (k * 1000 + i) ELSE '' END
    || ',"primary_keys":["k1"]'
    || CASE WHEN i = 4 THEN ',"aliases":["x","y"],"pitfalls":["mind the gap"]' ELSE '' END
    || CASE WHEN i = 2 THEN ',"scd":{"type":"scd2","valid_from":"vf"}' ELSE '' END
    || ',"columns":[' || array_to_string(list_transform(range(1, 2 + (k + i) % 3), lambda j:
         '{"name":"k' || j || '","type":"bigint","nullable":' || (j <> 1)::VARCHAR
         || ',"is_primary_key":' || (j = 1)::VARCHAR
         || CASE WHEN j = 2 THEN ',"classification":"pii"' ELSE '' END
         || CASE WHEN j = 3 THEN ',"description":"less < more & so","example_values":["a","b"]' ELSE '' END
         || '}'), ',') || '],"relationships":['
    || CASE WHEN i > 1 THEN '{"to_table":"t1","from_columns":["k1"],"to_columns":["k1"],"cardinality":"one_to_many"}'
            ELSE '' END
    || '],"upstream":[' || CASE WHEN i > 1 THEN '{"ref":"t' || (i - 1) || '"}' ELSE '' END || ']}' AS j
  FROM (SELECT k, unnest(range(1, 2 + k % 4)) AS i FROM c)),
d AS (
  SELECT k, '{"schema_version":1,' || CASE WHEN k % 2 = 0 THEN '"updated_at":"2024-01-01T00:00:00Z",' ELSE '' END
    || '"unknown_field":"dropped","project":{"name":"' || c_name || '"'
    || CASE WHEN k % 3 = 0 THEN ',"modeling_paradigm":"star"' ELSE '' END
    || ',"description":"' || c_mktsegment || '"'
    || CASE WHEN k % 2 = 0 THEN ',"glossary":[{"term":"churn","definition":"left us"}]' ELSE '' END
    || CASE WHEN k % 5 = 0 THEN ',"measures":[{"name":"n","definition":"rows","formula":"count(*)"}]' ELSE '' END
    || '},"connections":[{"name":"main","engine":"trino","dsn":"d' || c_nationkey || '","catalog":"hive"}],"tables":['
    || (SELECT string_agg(t.j, ',' ORDER BY t.i) FROM t WHERE t.k = c.k) || ']}' AS content
  FROM c)
SELECT 'c' || k || '.json' AS project_id, k % 13 <> 0 AS ok,
       md5(CASE WHEN k % 13 = 0 THEN content[1:60] ELSE content END) AS content_md5 FROM d"""


@query(_RAW_SQL)
def raw_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stored texts as they are, shown by their digests."""
    return projects.raw_documents(parsed(spark, sf_dir)).select(
        "project_id", "ok", F.md5(F.col("content").cast("binary")).alias("content_md5")
    )
