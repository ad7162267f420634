"""Queries over files: written with Spark below the shared folder, read back with the library's readers."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import catalog, changes, discovery, documents, drift, keys
from tessera.plans.registry import dealt, query, table, text
from tessera.plans.semantics_plans import NAMES
from tessera.sources import corpus, mined, projects
from tessera.sources.checkpoints import working_folder

_DESCRIBED = "', '".join(NAMES)


@query(
    f"""
SELECT table_name, column_name, ordinal_position::BIGINT AS ordinal_position,
       CASE data_type WHEN 'VARCHAR' THEN 'string' WHEN 'TIMESTAMP' THEN 'timestamp_ntz' WHEN 'INTEGER' THEN 'int'
            WHEN 'FLOAT[]' THEN 'array<float>' WHEN 'DOUBLE[]' THEN 'array<double>' ELSE lower(data_type) END AS data_type
FROM information_schema.columns WHERE table_name IN ('{_DESCRIBED}')"""
)
def described_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Schemas of all given tables; no data is read."""
    frames = {n: table(spark, sf_dir, n) for n in NAMES}
    return catalog.describe_tables(spark, frames).select("table_name", "column_name", "ordinal_position", "data_type")


# -- SQL files -------------------------------------------------------------------

_FILES_SQL = """
WITH o AS (
  SELECT DISTINCT o_custkey % 20 AS a, o_orderkey % 20 AS b, CASE WHEN o_orderkey % 3 <> 0 THEN 'stg' ELSE '' END AS s,
         o_orderkey % 6 AS shape, CASE WHEN o_orderkey % 17 = 0 THEN 'node_modules' ELSE 'kept' END AS folder
  FROM orders),
j AS (SELECT DISTINCT a, b, s FROM o WHERE folder = 'kept'),
edges AS (
  SELECT s || '.dim_' || b || '.id|' || s || '.fact_' || a || '.dim_' || b || '_id' AS id,
         s || '.fact_' || a AS fact, s || '.dim_' || b AS dim FROM j)"""

_SHAPES = (
    "create table {s}Copy_{a} as select * from {s}Fact_{a} f join {s}Dim_{b} d on f.dim_{b}_id = d.id",
    "select 1 from {s}Fact_{a} f join {s}Dim_{b} d on f.dim_{b}_id = d.id where f.x in (1, 2)",
    "select * from {s}Fact_{a} f join\u0085{s}Dim_{b} d on f.dim_{b}_id = d.id and f.arr[1] = d.id",
    "select * from {s}Fact_{a} f join {s}Dim_{b} d on f.dim_{b}_id = d.id and not (f.u = d.u)",
    "select * from {s}Fact_{a} f join {s}Dim_{b} d on f.dim_{b}_id = d.id join {s}Dim_{b} e on f.dim_{b}_id = e.id",
    "select * from {s}Fact_{a} f join {s}Dim_{b} d on f.dim_{b}_id = d.id or f.u = d.u",
)


def sql_files(spark: SparkSession, sf_dir: str) -> str:
    """A folder of .sql files, one statement per line, and one of a directory that is to be ignored."""
    k = F.col("o_orderkey")
    values = {
        "{a}": (F.col("o_custkey") % 20).cast("string"),
        "{b}": (k % 20).cast("string"),
        "{s}": F.when(k % 3 != 0, "stg.").otherwise(""),
    }
    sql = None
    for i, shape in enumerate(_SHAPES):
        t = F.lit(shape + ";")
        for mark, value in values.items():
            t = F.replace(t, F.lit(mark), value)
        sql = F.when(k % 6 == i, t) if sql is None else sql.when(k % 6 == i, t)
    rows = table(spark, sf_dir, "orders").select(
        sql.alias("sql"), F.when(k % 17 == 0, "node_modules").otherwise("kept").alias("folder")
    )
    root = working_folder(spark, "sql-corpus")
    for folder in ("kept", "node_modules"):
        lines = rows.where(F.col("folder") == folder).select("sql")
        # one statement per order, so the corpus grows with the table
        lines.write.options(extension="sql", quote="", sep="\x01", maxRecordsPerFile=1000).csv(f"{root}/{folder}")
    return root


@query(_FILES_SQL + " SELECT id FROM edges")
def corpus_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of files read back from a folder."""
    edges, _ = discovery.discover(corpus.read_sql_corpus(spark, sql_files(spark, sf_dir)))
    return edges.select("id")


@query(_FILES_SQL + " SELECT DISTINCT id FROM edges WHERE lower(fact) = 'stg.fact_7' OR lower(dim) = 'stg.fact_7'")
def stored_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of one table out of the stored index; the corpus is not mined again."""
    edges, _ = discovery.discover(corpus.read_sql_corpus(spark, sql_files(spark, sf_dir)))
    folder = working_folder(spark, "edge-store")
    corpus.write_edge_store(discovery.edges_by_table(edges), folder)
    return corpus.read_edges_of(spark, folder, "STG", "Fact_7").select("id")


_VERSIONS_SQL = """
WITH j AS (SELECT o_custkey % 50 AS a, o_orderkey % 997 AS b, o_orderkey % 3 AS folder, o_orderkey AS k FROM orders),
held AS (
  SELECT v.version, j.a, j.b FROM j JOIN (VALUES (0, 0), (0, 1), (1, 1), (1, 2), (2, 1), (3, 1), (3, 0)) v(version, folder)
    ON v.folder = j.folder
  UNION ALL
  SELECT 2, a, b + 1000 FROM j WHERE folder = 2)"""


def _folder_of_files(rows: DataFrame, path: str, shift: int = 0) -> None:
    """Replace a folder by files of one statement a line."""
    b = (F.col("o_orderkey") % 997 + shift).cast("string")
    dim = F.concat(F.lit("dim_"), b)
    sql = F.concat(
        F.lit("select * from fact_"), (F.col("o_custkey") % 50).cast("string"), F.lit(" f join "), dim,
        F.lit(" d on f."), dim, F.lit("_id = d.id;"),
    )
    lines = rows.select(sql.alias("sql"))
    lines.write.mode("overwrite").options(extension="sql", quote="", sep="\x01", maxRecordsPerFile=1000).csv(path)


@query(
    _VERSIONS_SQL
    + """
SELECT DISTINCT version, '.dim_' || b || '.id|.fact_' || a || '.dim_' || b || '_id' AS id FROM held"""
)
def edge_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Edges of a corpus over four versions: a folder goes and one comes, one is rewritten, one goes and one comes back."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey")
    part = [orders.where(F.col("o_orderkey") % 3 == i) for i in range(3)]
    root = working_folder(spark, "versions")
    # a version of the corpus is one folder with a folder of each part
    store = mined.mined_buckets(f"{root}/state", 16)
    mined.begin(spark, store)
    versions = []
    steps: list[list[tuple[int, int | None]]] = [[(0, 0), (1, 0)], [(0, None), (2, 0)], [(2, 1000)], [(2, None), (0, 0)]]
    for version, step in enumerate(steps):
        for i, shift in step:
            # a folder that goes keeps no files
            _folder_of_files(part[i].limit(0) if shift is None else part[i], f"{root}/sql/{i}", shift or 0)
        mined.update(spark, store, f"{root}/sql", version)
        edges = mined.edges_of(spark, store, version).select(F.lit(version).alias("version"), "id")
        # older versions do not stay
        path = f"{root}/edges/{version}"
        edges.write.parquet(path)
        versions.append(path)
    return spark.read.parquet(*versions)


# -- project files ---------------------------------------------------------------


@query(
    """
SELECT CASE WHEN s_suppkey % 5 = 0 THEN '<unparseable>' ELSE s_name END AS name,
       CASE WHEN s_suppkey % 5 <> 0 AND s_suppkey % 2 = 0 THEN '2024-01-01T00:00:00Z' ELSE '' END AS updated_at
FROM supplier"""
)
def scanned_projects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Project files, one per supplier, listed from their folder."""
    k = F.col("s_suppkey")
    doc = F.to_json(
        F.struct(
            F.lit(1).alias("schema_version"),
            F.when(k % 2 == 0, "2024-01-01T00:00:00Z").alias("updated_at"),
            F.struct(F.col("s_name").alias("name")).alias("project"),
        )
    )
    folder = working_folder(spark, "projects")
    broken = F.when(k % 5 == 0, F.substring(doc, 1, 20)).otherwise(doc)
    # a file costs far more than its row: all tasks write some
    suppliers = dealt(table(spark, sf_dir, "supplier"), "s_suppkey")
    suppliers.select(broken.alias("value")).write.option("maxRecordsPerFile", 1).text(folder)
    return projects.list_projects(projects.read_projects(spark, folder, ".txt")).select("name", "updated_at")


# -- whole documents and records under all rules ------------------------------------


@query(
    """
WITH d AS (SELECT c_custkey AS k, c_custkey % 6 AS f FROM customer)
SELECT 'c' || k || '.json' AS project_id, p.path, p.rule, p.severity, p.n AS value_length
FROM d JOIN (VALUES
  (0, 'tables/0/refresh_cadence', 'allowed word', 'enforced', 5), (0, 'tables/0/table_name', 'required, not empty', 'enforced', 0),
  (1, 'glossary/1/term', 'required, not empty', 'enforced', 0),
  (2, 'projects/schema_version', 'supported version', 'documented', 0),
  (3, 'measures/0/owner', 'at most 240 characters', 'enforced', 300), (3, 'projects/name', 'required, not empty', 'enforced', 0),
  (4, 'relationships/t/0/cardinality', 'allowed word', 'enforced', 3),
  (4, 'columns/t/0/classification', 'allowed word', 'enforced', 6)) p(f, path, rule, severity, n) ON p.f = d.f"""
)
def validate_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rules over whole documents; the sixth kind of document is faultless."""
    k = F.col("c_custkey")
    bad = k % 6
    doc = F.struct(
        F.when(bad == 2, 2).otherwise(1).alias("schema_version"),
        F.struct(
            F.when(bad == 3, "").otherwise("n").alias("name"),
            F.array(
                F.struct(F.lit("a").alias("term"), F.lit("b").alias("definition")),
                F.struct(F.when(bad == 1, "").otherwise("c").alias("term"), F.lit("d").alias("definition")),
            ).alias("glossary"),
            F.array(
                F.struct(
                    F.lit("m").alias("name"), F.lit("d").alias("definition"),
                    F.when(bad == 3, F.repeat(F.lit("o"), 300)).alias("owner"),
                )
            ).alias("measures"),
        ).alias("project"),
        F.array(
            F.struct(
                F.when(bad == 0, "").otherwise("t").alias("table_name"),
                F.when(bad == 0, "often").otherwise("daily").alias("refresh_cadence"),
                F.array(
                    F.struct(F.lit("c").alias("name"), F.when(bad == 4, "secret").otherwise("pii").alias("classification"))
                ).alias("columns"),
                F.array(
                    F.struct(
                        F.lit("u").alias("to_table"), F.array(F.lit("c")).alias("from_columns"),
                        F.array(F.lit("c")).alias("to_columns"),
                        F.when(bad == 4, "two").otherwise("one_to_one").alias("cardinality"),
                    )
                ).alias("relationships"),
            )
        ).alias("tables"),
    )
    files = table(spark, sf_dir, "customer").select(
        F.concat(F.lit("c"), k.cast("string"), F.lit(".json")).alias("file"), F.to_json(doc).alias("content")
    )
    return changes.validate(documents.flatten(projects.parsed_once(projects.parse_projects(files))))


_UPSERT_SQL = """
WITH state AS (SELECT c_custkey, 't' || c_custkey AS table_name, c_custkey AS pos, c_mktsegment AS description
               FROM customer WHERE c_custkey % 2 = 0),
ch AS (SELECT o_orderkey AS seq, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 't' || o_custkey END AS table_name,
              o_orderpriority AS description, o_orderkey % 11 = 0 AS unnamed, o_orderkey % 7 = 0 AS often,
              o_orderkey % 5 = 0 AS secret FROM orders),
good AS (SELECT table_name, max_by(description, seq) AS description, max_by(seq % 7 = 1, seq) AS unknown, min(seq) AS first
         FROM ch WHERE NOT (unnamed OR often OR secret) GROUP BY table_name)"""


def _tables(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    part = F.array(F.struct(F.lit("k").alias("name"), F.lit("pii").alias("classification")))
    state = table(spark, sf_dir, "customer").where("c_custkey % 2 = 0").select(
        F.lit("p0").alias("project_id"), F.col("c_custkey").alias("pos"),
        F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("table_name"),
        F.col("c_mktsegment").alias("description"), F.lit("daily").alias("refresh_cadence"), part.alias("columns"),
    )
    k = F.col("o_orderkey")
    rows = table(spark, sf_dir, "orders").select(
        F.lit("p0").alias("project_id"), k.alias("seq"),
        F.when(k % 11 == 0, "").otherwise(F.concat(F.lit("t"), F.col("o_custkey").cast("string"))).alias("table_name"),
        F.col("o_orderpriority").alias("description"),
        F.when(k % 7 == 0, "often").when(k % 7 != 1, "weekly").alias("refresh_cadence"),
        F.array(
            F.struct(F.lit("k").alias("name"), F.when(k % 5 == 0, "secret").otherwise("pii").alias("classification"))
        ).alias("columns"),
    )
    return changes.upsert_tables(state, rows)


@query(
    _UPSERT_SQL
    + """
SELECT coalesce(s.table_name, g.table_name) AS table_name, s.table_name IS NULL AS appended, coalesce(s.pos, g.first) AS pos,
       coalesce(g.description, s.description) AS description,
       CASE WHEN g.table_name IS NULL THEN 'daily' WHEN g.unknown THEN '' ELSE 'weekly' END AS refresh_cadence
FROM state s FULL OUTER JOIN good g ON s.table_name = g.table_name"""
)
def upsert_tables(spark: SparkSession, sf_dir: str) -> DataFrame:
    after, _ = _tables(spark, sf_dir)
    return after.select("table_name", "appended", "pos", "description", text("refresh_cadence"))


@query(
    _UPSERT_SQL
    + """
SELECT seq, ch.table_name,
       CASE WHEN unnamed OR often OR secret THEN 'rejected' WHEN s.table_name IS NOT NULL OR seq > first THEN 'updated'
            ELSE 'added' END AS outcome,
       CASE WHEN unnamed THEN 'table_name is required' WHEN often THEN 'refresh_cadence is not an allowed word'
            WHEN secret THEN 'columns has an invalid entry' ELSE '' END AS reason
FROM ch LEFT JOIN state s ON s.table_name = ch.table_name LEFT JOIN good g ON g.table_name = ch.table_name"""
)
def upsert_table_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, outcomes = _tables(spark, sf_dir)
    return outcomes.select("seq", "table_name", "outcome", text("reason"))


# -- column names: duplicates, exact case ----------------------------------------------


@query(
    """
SELECT 't' || c_custkey AS table_name, n.change_type, n.name, n.before_type, n.after_type
FROM customer JOIN (VALUES (0, 'changed', 'A', 'bigint', 'int'), (0, 'removed', 'gone', 'date', ''),
                           (1, 'added', 'new', '', 'text'), (1, 'removed', 'gone', 'date', ''))
     n(f, change_type, name, before_type, after_type) ON n.f = c_custkey % 2"""
)
def duplicate_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Of live columns that share a name the last one counts; authored names match in any case."""
    k = F.col("c_custkey")

    def columns(*rows: tuple[str, str]) -> DataFrame:
        listed = F.array(*[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type")) for n, t in rows])
        return table(spark, sf_dir, "customer").select(
            F.concat(F.lit("t"), k.cast("string")).alias("table_name"), k.alias("k"), F.posexplode(listed).alias("pos", "c")
        ).select("table_name", "k", "pos", "c.*", F.lit(True).alias("nullable"))

    live = columns(("a", "int"), ("a", "bigint"), ("gone", "date"))
    authored = columns(("A", "int"), ("A", "bigint"), ("new", "text")).where(
        ((F.col("k") % 2 == 0) & (F.col("pos") == 0)) | ((F.col("k") % 2 == 1) & (F.col("pos") > 0))
    )
    found = drift.diff_columns(authored.drop("k"), live.drop("k"), ["table_name"])
    return found.select("table_name", "change_type", "name", text("before_type"), text("after_type"))


@query(
    """
SELECT 't' || c_custkey AS table_name, n.pos, n.name, n.type, n.description
FROM customer, (VALUES (0, 'Id', 'bigint', 'kept'), (1, 'NAME', 'text', '')) n(pos, name, type, description)"""
)
def refresh_exact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hints follow names of exactly the same spelling."""
    name = F.concat(F.lit("t"), F.col("c_custkey").cast("string")).alias("table_name")

    def columns(*rows: tuple[str, str, str]) -> DataFrame:
        listed = F.array(
            *[F.struct(F.lit(n).alias("name"), F.lit(t).alias("type"), F.lit(d).alias("description")) for n, t, d in rows]
        )
        return table(spark, sf_dir, "customer").select(name, F.posexplode(listed).alias("pos", "c")).select(
            "table_name", "pos", "c.*", F.lit(True).alias("nullable")
        )

    authored = columns(("Id", "int", "kept"), ("name", "text", "lost"))
    live = columns(("Id", "bigint", ""), ("NAME", "text", "")).drop("description")
    out = drift.refresh_columns(authored, live, ["table_name"])
    return out.select("table_name", "pos", "name", "type", text("description"))


# -- proposed keys confirmed on data ------------------------------------------------------


@query(
    """
SELECT 'orders' AS table_name, 'o_orderkey' AS key_columns, count(*) AS n_rows, count(DISTINCT o_orderkey) AS n_keys,
       count(*) = count(DISTINCT o_orderkey) AS ok FROM orders
UNION ALL
SELECT 'lineitem', 'l_orderkey', count(*), count(DISTINCT l_orderkey), count(*) = count(DISTINCT l_orderkey) FROM lineitem"""
)
def confirmed_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Keys proposed by name, counted on the tables; one holds, one does not."""
    orders = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "orders_id")
    lines = table(spark, sf_dir, "lineitem").withColumnRenamed("l_orderkey", "lineitem_id")
    frames = {"orders": orders, "lineitem": lines}
    described = catalog.describe_tables(spark, frames).select(
        "table_name", F.col("column_name").alias("name"), F.col("ordinal_position").alias("pos")
    )
    found = keys.confirm_primary_keys(keys.propose_primary_key(described), frames)
    original = F.when(F.col("table_name") == "orders", "o_orderkey").otherwise("l_orderkey")
    return found.select("table_name", original.alias("key_columns"), "n_rows", "n_keys", "ok")
