"""Join discovery over a corpus with one SQL file per order.

Tables, spelling and shape of each file follow from the order's keys, so the SQL
side states the expected edges from the same keys and never reads SQL text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import discovery, keys
from tessera.plans.registry import dealt, query, table, text
from tessera.sources.corpus import visible

_TEMPLATES = (
    "SELECT f.*, d.name FROM {s}Fact_{a} f\n  LEFT JOIN {s}Dim_{b} AS d ON f.dim_{b}_id = d.id WHERE f.x > 1",
    "select count(*) from {q}[Fact_{a}] inner join {q}[Dim_{b}] on [Fact_{a}].[dim_{b}_id]=[Dim_{b}].[id] order by 1",
    "select `f`.x from {s}`Fact_{a}` `f` full outer join {s}`Dim_{b}` `d` on `f`.`dim_{b}_id` = `d`.`id`",
    "select * from {s}Dim_{b} as d right join {s}Fact_{a} as f on D.id = F.dim_{b}_id",
    "select * from {s}Fact_{a} f join {s}Dim_{b} d on (f.dim_{b}_id = d.id and f.day = d.day and f.n >= d.n)",
    "with c as (select f.y, d.z from {s}Fact_{a} f join {s}Dim_{b} d on f.dim_{b}_id = d.id)"
    " select extract(year from c.y) from c cross join limits",
    "select q.v from (select f.v from {s}Fact_{a} f join {s}Dim_{b} d on f.dim_{b}_id = d.id) q"
    " where q.v > (select max(v) from limits)",
    "select * from {s}Fact_{a} f cross join {s}Dim_{b} d join {s}other using (id)",
    "select * from {s}Fact_{a} f join (select id from {s}Dim_{b}) d on f.dim_{b}_id = d.id",
    "-- first; join\nINSERT INTO log VALUES ('a;b JOIN c ON x.y = z.w');\n/* x join y; */ SELECT 1 FROM {s}Fact_{a} f"
    " JOIN {s}Dim_{b} d ON f.dim_{b}_id = d.id AND d.flag = {{{{ flag }}}} AND d.note <> 'it''s = (;'",
)


def corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("o_orderkey")
    a, b = (F.col("o_custkey") % 20).cast("string"), (k % 20).cast("string")
    schema = F.when(k % 3 != 0, "stg.").otherwise("")
    quoted = F.when(k % 3 != 0, "[stg].").otherwise("")
    shape = F.floor(k / 20) % 10
    chosen = None
    for i, template in enumerate(_TEMPLATES):
        t = F.lit(template.replace("{{{{", "\x01").replace("}}}}", "\x02"))
        for mark, value in (("{s}", schema), ("{q}", quoted), ("{a}", a), ("{b}", b)):
            t = F.replace(t, F.lit(mark), value)
        t = F.replace(F.replace(t, F.lit("\x01"), F.lit("{{")), F.lit("\x02"), F.lit("}}"))
        chosen = F.when(shape == i, t) if chosen is None else chosen.when(shape == i, t)
    folder = F.when(k % 17 == 0, "q/node_modules/").otherwise("q/")
    files = dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey").select(
        F.concat(folder, k.cast("string"), F.lit(".sql")).alias("file"), chosen.alias("sql")
    )
    return visible(files)


JOINS_SQL = """
WITH o AS (
  SELECT o_orderkey AS k, o_custkey % 20 AS a, o_orderkey % 20 AS b,
         CASE WHEN o_orderkey % 3 <> 0 THEN 'stg' ELSE '' END AS s,
         (o_orderkey // 20) % 10 AS shape
  FROM orders WHERE o_orderkey % 17 <> 0),
j AS (
  SELECT *, 'q/' || k || '.sql' AS file,
         s || '.dim_' || b || '.id|' || s || '.fact_' || a || '.dim_' || b || '_id' AS id
  FROM o WHERE shape NOT IN (7, 8)),
occ AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY file) AS rn,
               count(*) OVER (PARTITION BY id) AS n FROM j),
edges AS (
  SELECT id, s AS left_schema, CASE WHEN shape = 3 THEN 'Dim_' || b ELSE 'Fact_' || a END AS left_table,
         CASE WHEN shape = 3 THEN 'id' ELSE 'dim_' || b || '_id' END AS left_column,
         s AS right_schema, CASE WHEN shape = 3 THEN 'Fact_' || a ELSE 'Dim_' || b END AS right_table,
         CASE WHEN shape = 3 THEN 'dim_' || b || '_id' ELSE 'id' END AS right_column,
         CASE WHEN shape = 4 THEN 'day=day' ELSE '' END AS extra,
         n AS n_occurrences, file AS first_file
  FROM occ WHERE rn = 1)"""


def _flat(edges: DataFrame) -> DataFrame:
    return edges.select(
        *[c for c in ("table_key",) if c in edges.columns],
        "id",
        text("left.schema", "left_schema"),
        text("left.table", "left_table"),
        text("left.column", "left_column"),
        text("right.schema", "right_schema"),
        text("right.table", "right_table"),
        text("right.column", "right_column"),
        F.array_join(
            F.transform(
                "extra", lambda e: F.concat_ws("=", e["left"]["column"], e["right"]["column"])
            ),
            ",",
        ).alias("extra"),
        "n_occurrences",
        "first_file",
    )


@query(JOINS_SQL + " SELECT * FROM edges")
def discover_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = discovery.discover(corpus(spark, sf_dir))
    return _flat(found)


@query(
    JOINS_SQL
    + """
SELECT id, file, CASE shape WHEN 0 THEN 'LEFT' WHEN 1 THEN 'INNER' WHEN 2 THEN 'FULL' WHEN 3 THEN 'RIGHT'
            ELSE 'JOIN' END AS kind,
       CASE shape WHEN 1 THEN 'Fact_' || a || '.dim_' || b || '_id = Dim_' || b || '.id'
            WHEN 3 THEN 'D.id = F.dim_' || b || '_id'
            WHEN 4 THEN '(f.dim_' || b || '_id = d.id AND f.day = d.day AND f.n >= d.n)'
            WHEN 9 THEN 'f.dim_' || b || '_id = d.id AND d.flag = 1 AND d.note <> ''it''''s = (;'''
            ELSE 'f.dim_' || b || '_id = d.id' END AS on_text
FROM j"""
)
def edge_occurrences(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found = discovery.discover(corpus(spark, sf_dir))
    return found.select("id", "file", "kind", "on_text")


#: Conditions behind several joins, one condition twice in a file, and statements without semicolons.
_STACKED = (
    "select * from {s}Fact_{a} f join {s}Bridge_{b} x join {s}Dim_{b} d on x.dim_id = d.id on f.bridge_id = x.id",
    "select * from {s}Fact_{a} f left join {s}Bridge_{b} x inner join {s}Dim_{b} d right outer join {s}Dim_{b}_Names"
    " on d.name_id = Dim_{b}_Names.id on x.dim_id = d.id on f.bridge_id = x.id where f.n > 1",
    "select 1 from {s}Fact_{a} f join {s}Dim_{b} d on f.dim_id = d.id;\nselect 2 from {s}Fact_{a} f join {s}Dim_{b} d"
    " on f.dim_id = d.id",
    "create view v1 as select * from {s}Fact_{a} f left join {s}Dim_{b} d on f.dim_id = d.id\n"
    "create or replace view v2 as select * from {s}Bridge_{b} x join {s}Dim_{b} d on x.dim_id = d.id\ndrop table old",
)


def stacked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per order; the order's keys name its tables and its shape."""
    k = F.col("o_orderkey")
    values = {"{s}": F.when(k % 3 != 0, "stg.").otherwise(""), "{a}": F.col("o_custkey") % 20, "{b}": k % 20}
    shapes = [F.lit(t) for t in _STACKED]
    for mark, value in values.items():
        shapes = [F.replace(t, F.lit(mark), value.cast("string")) for t in shapes]
    orders = dealt(table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"), "o_orderkey")
    chosen = F.element_at(F.array(*shapes), (F.floor(k / 20) % len(_STACKED) + 1).cast("int"))
    return orders.select(F.concat(k.cast("string"), F.lit(".sql")).alias("file"), chosen.alias("sql"))


@query(
    """
WITH o AS (SELECT o_orderkey || '.sql' AS file, o_custkey % 20 AS a, o_orderkey % 20 AS b, (o_orderkey // 20) % 4 AS shape,
                  CASE WHEN o_orderkey % 3 <> 0 THEN 'stg' ELSE '' END AS s FROM orders),
n AS (SELECT *, CASE s WHEN '' THEN '' ELSE s || '.' END AS p FROM o),
j AS (
  SELECT file, s, p, 'bridge_' || b || '.dim_id' AS l, 'dim_' || b || '.id' AS r,
         CASE shape WHEN 1 THEN 'INNER' ELSE 'JOIN' END AS kind, 'Dim_' || b || ' d' AS shown, 'x.dim_id = d.id' AS on_text
  FROM n WHERE shape IN (0, 1, 3)
  UNION ALL
  SELECT file, s, p, 'bridge_' || b || '.id', 'fact_' || a || '.bridge_id', CASE shape WHEN 1 THEN 'LEFT' ELSE 'JOIN' END,
         'Bridge_' || b || ' x', 'f.bridge_id = x.id' FROM n WHERE shape IN (0, 1)
  UNION ALL
  SELECT file, s, p, 'dim_' || b || '.name_id', 'dim_' || b || '_names.id', 'RIGHT', 'Dim_' || b || '_Names',
         'd.name_id = Dim_' || b || '_Names.id' FROM n WHERE shape = 1
  UNION ALL
  SELECT file, s, p, 'dim_' || b || '.id', 'fact_' || a || '.dim_id', CASE shape WHEN 3 THEN 'LEFT' ELSE 'JOIN' END,
         'Dim_' || b || ' d', 'f.dim_id = d.id' FROM n WHERE shape IN (2, 3))
SELECT s || '.' || l || '|' || s || '.' || r AS id, file, kind, on_text,
       kind || ' JOIN ' || p || shown || ' ON ' || on_text AS clause_text FROM j"""
)
def stacked_joins(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, found = discovery.discover(stacked(spark, sf_dir))
    return found.select("id", "file", "kind", "on_text", "clause_text")


@query(
    JOINS_SQL
    + """
SELECT DISTINCT unnest([lower(left_schema || '.' || left_table), lower(right_schema || '.' || right_table)])
       AS table_key, edges.* FROM edges"""
)
def edges_by_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, _ = discovery.discover(corpus(spark, sf_dir))
    return _flat(discovery.edges_by_table(found))


@query(
    JOINS_SQL
    + """
SELECT file, (CASE WHEN shape = 9 THEN 1 ELSE 0 END)::INT AS stmt_no, e AS eq_no,
       CASE WHEN e = 1 THEN 'day' WHEN shape = 3 THEN 'id' ELSE 'dim_' || b || '_id' END AS left_column,
       CASE WHEN e = 1 THEN 'day' WHEN shape = 3 THEN 'dim_' || b || '_id' ELSE 'id' END AS right_column
FROM (SELECT *, unnest(CASE WHEN shape = 4 THEN [0, 1] ELSE [0] END) AS e FROM j)"""
)
def join_equalities(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = discovery.equality_rows(discovery.extract_joins(corpus(spark, sf_dir)))
    return rows.select(
        "file",
        "stmt_no",
        "eq_no",
        F.col("left.column").alias("left_column"),
        F.col("right.column").alias("right_column"),
    )


@query(
    JOINS_SQL
    + """
SELECT (SELECT count(*) FROM o) AS files_scanned, (SELECT count(*) FROM j) AS joins_found,
       (SELECT count(*) FROM j) AS joins_usable"""
)
def scan_statistics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.scan_statistics(corpus(spark, sf_dir))


@query(
    """
SELECT 'q/' || o_orderkey || '.sql' AS file, 'unbalanced brackets in statement 0' AS message
FROM orders WHERE o_orderkey % 17 <> 0 AND (o_orderkey // 20) % 10 = 6"""
)
def scan_errors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus with the last bracket of each scalar subquery lost."""
    broken = corpus(spark, sf_dir).select(
        "file", F.replace("sql", F.lit("limits)"), F.lit("limits")).alias("sql")
    )
    return discovery.scan_errors(broken)


#: Edges of the corpus, by key columns; ``alt.lineitem`` has half of the lines and decimal order keys.
_STAR = (
    ("wh.orders", ("o_custkey",), "wh.customer", ("c_custkey",)),
    ("wh.lineitem", ("l_orderkey",), "wh.orders", ("o_orderkey",)),
    ("wh.lineitem", ("l_suppkey",), "wh.supplier", ("s_suppkey",)),
    ("wh.customer", ("c_nationkey",), "wh.nation", ("n_nationkey",)),
    ("wh.orders", ("o_orderkey",), "wh.part", ("p_partkey",)),
    ("wh.lineitem", ("l_orderkey", "l_linenumber"), "alt.lineitem", ("l_orderkey", "l_linenumber")),
    ("alt.lineitem", ("l_partkey", "l_linenumber"), "wh.customer", ("c_custkey", "c_custkey")),
)


def _star_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file per order that joins one edge of the star."""
    pick = F.col("o_orderkey") % len(_STAR)
    sql = None
    for i, (left, lcs, right, rcs) in enumerate(_STAR):
        on = " and ".join(f"x.{a} = y.{b}" for a, b in zip(lcs, rcs, strict=True))
        t = F.lit(f"select 1 from {left} x join {right} y on {on}")
        sql = F.when(pick == i, t) if sql is None else sql.when(pick == i, t)
    return dealt(table(spark, sf_dir, "orders").select("o_orderkey"), "o_orderkey").select(
        F.concat(F.col("o_orderkey").cast("string"), F.lit(".sql")).alias("file"), sql.alias("sql")
    )


def _corroborate_sql() -> str:
    def source(full: str, columns: tuple[str, ...]) -> str:
        where = " WHERE l_linenumber % 2 = 1" if full.startswith("alt.") else ""
        listed = ", ".join(f"{c} AS k{i}" for i, c in enumerate(columns))
        return f"(SELECT {listed} FROM {full.partition('.')[2]}{where})"

    rows = []
    for left, lcs, right, rcs in _STAR:
        ends = sorted((f"{left}.{lcs[0]}", f"{right}.{rcs[0]}"))
        keys_ = ", ".join(f"k{i}" for i in range(len(lcs)))
        a, b = source(left, lcs), source(right, rcs)
        rows.append(
            f"""
SELECT '{'|'.join(ends)}' AS id,
  (SELECT count(*) FROM {a}) AS left_rows, (SELECT count(*) FROM {b}) AS right_rows,
  (SELECT count(*) FROM {a} WHERE ({keys_}) IN (SELECT ({keys_}) FROM {b})) AS left_matched,
  (SELECT count(*) FROM {b} WHERE ({keys_}) IN (SELECT ({keys_}) FROM {a})) AS right_matched,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM {a} GROUP BY {keys_})) AS left_per_key,
  (SELECT max(n) FROM (SELECT count(*) AS n FROM {b} GROUP BY {keys_})) AS right_per_key"""
        )
    return f"""
WITH m AS ({" UNION ALL ".join(rows)}),
r AS (SELECT *, left_matched / left_rows AS left_rate, right_matched / right_rows AS right_rate FROM m)
SELECT *, CASE WHEN left_per_key <= 1 AND right_per_key <= 1 THEN 'one_to_one'
               WHEN left_per_key <= 1 OR right_per_key <= 1 THEN 'one_to_many' ELSE 'many_to_many' END AS cardinality,
       CASE WHEN left_matched = 0 THEN 'refuted'
            WHEN (right_per_key <= 1 AND left_rate >= 0.95) OR (left_per_key <= 1 AND right_rate >= 0.95) THEN 'confirmed'
            ELSE 'weak' END AS verdict
FROM r"""


@query(_corroborate_sql())
def corroborate_edges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Single and composite edges, two schemas with one table name, integers against decimals."""
    found, _ = discovery.discover(_star_corpus(spark, sf_dir))
    names = sorted({full for left, _, right, _ in _STAR for full in (left, right)})
    frames = {full: table(spark, sf_dir, full.partition(".")[2]) for full in names}
    half = frames["alt.lineitem"].where("l_linenumber % 2 = 1")
    frames["alt.lineitem"] = half.withColumn("l_orderkey", F.col("l_orderkey").cast("decimal(12,2)"))
    return keys.corroborate(found, frames)
