"""Declared semantics run over the star tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import history, keys, measures, quality, sketches
from tessera.operators.declared import ColumnHint, Measure, Relationship, Scd
from tessera.plans.registry import query, table, text
from tessera.sources.checkpoints import working_folder

NAMES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents",
    "embeddings", "pages", "benchmark", "labels", "conversations",
)
PRIMARY_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}
EDGES = (
    Relationship("lineitem", "orders", ("l_orderkey",), ("o_orderkey",)),
    Relationship("lineitem", "part", ("l_partkey",), ("p_partkey",)),
    Relationship("orders", "customer", ("o_custkey",), ("c_custkey",)),
    Relationship("customer", "nation", ("c_nationkey",), ("n_nationkey",)),
    Relationship("nation", "region", ("n_regionkey",), ("r_regionkey",)),
    Relationship("labels", "documents", ("doc_id",), ("doc_id",), "one_to_one"),
)


def _union(frames) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def _pk_sql(name: str, cols: list[str]) -> str:
    c = ", ".join(cols)
    return (
        f"SELECT '{name}' AS table_name, '{','.join(cols)}' AS key_columns, sum(n)::BIGINT AS n_rows,"
        f" count(*) AS n_keys, count(*) FILTER (WHERE n > 1) AS duplicate_keys,"
        f" coalesce(sum(n) FILTER (WHERE n > 1), 0)::BIGINT AS duplicate_rows, 0::BIGINT AS null_key_rows,"
        f" max(n) = 1 AS ok FROM (SELECT {c}, count(*) AS n FROM {name} GROUP BY {c})"
    )


@query(" UNION ALL ".join(_pk_sql(n, c) for n, c in PRIMARY_KEYS.items()))
def pk_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(
        keys.check_primary_key(table(spark, sf_dir, n), c, n) for n, c in PRIMARY_KEYS.items()
    )


@query(
    """
SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1"""
)
def pk_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return keys.duplicate_keys(table(spark, sf_dir, "lineitem"), PRIMARY_KEYS["lineitem"])


@query(
    """
WITH cols AS (
  SELECT CASE o_orderkey % 3 WHEN 0 THEN 'item' WHEN 1 THEN 'link' ELSE 'things' END || o_custkey AS base,
         o_orderkey % 4 AS shape, o_orderkey AS pos FROM orders),
tab AS (SELECT base || '_' || shape AS table_name, min(pos) AS pos, shape FROM cols GROUP BY base, shape),
c AS (
  SELECT table_name, shape, unnest(CASE shape WHEN 0 THEN ['id', 'a_id'] WHEN 1 THEN [table_name || '_id', 'b_id', 'c_id']
                  WHEN 2 THEN ['x_id', 'y_id', 'name'] ELSE ['x_id', 'name'] END) AS name FROM tab)
SELECT table_name, (shape + 1)::INT AS rule, name FROM c
WHERE (shape = 0 AND name = 'id') OR (shape = 1 AND name = table_name || '_id')
   OR (shape = 2 AND name IN ('x_id', 'y_id'))"""
)
def pk_propose(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = F.col("o_orderkey")
    shape = o % 4
    base = F.when(o % 3 == 0, "item").when(o % 3 == 1, "link").otherwise("things")
    tables = (
        table(spark, sf_dir, "orders")
        .select(
            F.concat(base, F.col("o_custkey").cast("string"), F.lit("_"), shape.cast("string")).alias(
                "table_name"
            ),
            shape.alias("shape"),
        )
        .distinct()
    )
    s, own = F.col("shape"), F.concat("table_name", F.lit("_id"))
    names = (
        F.when(s == 0, F.array(F.lit("id"), F.lit("a_id")))
        .when(s == 1, F.array(own, F.lit("b_id"), F.lit("c_id")))
        .when(s == 2, F.array(F.lit("x_id"), F.lit("y_id"), F.lit("name")))
        .otherwise(F.array(F.lit("x_id"), F.lit("name")))
    )
    columns = tables.select("table_name", F.posexplode(names).alias("pos", "name"))
    return keys.propose_primary_key(columns).select("table_name", "rule", "name")


@query(
    """
SELECT 'orders->customer' AS edge, count(DISTINCT o_custkey) AS orphan_keys, count(*) AS orphan_rows
FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_mktsegment <> 'BUILDING')
UNION ALL
SELECT 'lineitem->supplier', count(DISTINCT (l_suppkey, l_returnflag)), count(*)
FROM lineitem WHERE (l_suppkey, l_returnflag) NOT IN (SELECT (s_suppkey, 'A') FROM supplier)"""
)
def fk_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    some = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    composite = Relationship(
        "lineitem", "supplier", ("l_suppkey", "l_returnflag"), ("s_suppkey", "flag")
    )
    suppliers = table(spark, sf_dir, "supplier").withColumn("flag", F.lit("A"))
    return keys.check_foreign_key(table(spark, sf_dir, "orders"), some, EDGES[2]).unionByName(
        keys.check_foreign_key(table(spark, sf_dir, "lineitem"), suppliers, composite)
    )


def _cardinality_sql(r: Relationship) -> str:
    f, t = r.from_columns[0], r.to_columns[0]
    return f"""
SELECT '{r.from_table}->{r.to_table}' AS edge, mf AS max_from, mt AS max_to,
       CASE WHEN mt > 1 THEN 'many_to_many' WHEN mf > 1 THEN 'one_to_many' ELSE 'one_to_one' END AS observed,
       '{r.cardinality}' AS declared
FROM (SELECT (SELECT max(n) FROM (SELECT count(*) AS n FROM {r.from_table} GROUP BY {f})) AS mf,
             (SELECT max(n) FROM (SELECT count(*) AS n FROM {r.to_table} GROUP BY {t})) AS mt)"""


@query(" UNION ALL ".join(_cardinality_sql(r) for r in EDGES))
def cardinality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _union(
        keys.check_cardinality(
            table(spark, sf_dir, r.from_table), table(spark, sf_dir, r.to_table), r
        )
        for r in EDGES
    ).drop("as_declared")


def _star(spark: SparkSession, sf_dir: str) -> DataFrame:
    """lineitem joined along its declared edges up to region."""
    out = table(spark, sf_dir, "lineitem")
    for rel in (EDGES[0], EDGES[2], EDGES[3], EDGES[4]):
        out = keys.join_along(out, table(spark, sf_dir, rel.to_table), rel)
    return out


_STAR_SQL = """
FROM lineitem JOIN orders ON l_orderkey = o_orderkey JOIN customer ON o_custkey = c_custkey
JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey"""
MEASURES = (
    Measure("revenue", "sum(cast(l_extendedprice * (1 - l_discount) as decimal(28,4)))"),
    Measure("line_count", "count(*)"),
    Measure("late_buyers", "count(distinct o_custkey) where l_shipdate > o_orderdate + interval 90 days"),
)


@query(
    f"""
SELECT n_name, sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(28,4)))::DOUBLE AS revenue, count(*) AS line_count,
       count(DISTINCT o_custkey) FILTER (WHERE l_shipdate > o_orderdate + INTERVAL 90 DAY) AS late_buyers
{_STAR_SQL} GROUP BY n_name"""
)
def measure_by_nation(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measures.evaluate_measures(_star(spark, sf_dir), MEASURES, ["n_name"])
    return out.withColumn("revenue", F.col("revenue").cast("double"))


@query(
    f"""
SELECT coalesce(r_name, '') AS r_name, coalesce(l_returnflag, '') AS l_returnflag,
       grouping_id(r_name, l_returnflag)::BIGINT AS grouping_level,
       sum(CAST(l_extendedprice * (1 - l_discount) AS DECIMAL(28,4)))::DOUBLE AS revenue, count(*) AS line_count
{_STAR_SQL} GROUP BY ROLLUP (r_name, l_returnflag)"""
)
def measure_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measures.evaluate_measures(
        _star(spark, sf_dir), MEASURES[:2], ["r_name", "l_returnflag"], "rollup"
    )
    return out.select(
        text("r_name"), text("l_returnflag"), "grouping_level",
        F.col("revenue").cast("double").alias("revenue"), "line_count",
    )


@query(
    """
SELECT l_returnflag AS a, l_linestatus AS b, grouping_id(l_returnflag, l_linestatus)::BIGINT AS grouping_level,
       count(*) AS line_count FROM lineitem GROUP BY CUBE (l_returnflag, l_linestatus)"""
)
def measure_cube(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = measures.evaluate_measures(
        table(spark, sf_dir, "lineitem"), MEASURES[1:2], ["l_returnflag", "l_linestatus"], "cube"
    )
    return out.withColumnsRenamed({"l_returnflag": "a", "l_linestatus": "b"})


@query(
    """
SELECT o_orderkey, o_custkey, c_name, c_mktsegment FROM orders JOIN customer ON o_custkey = c_custkey"""
)
def join_along(spark: SparkSession, sf_dir: str) -> DataFrame:
    """With explicit salting of the customer key."""
    out = keys.join_along(
        table(spark, sf_dir, "orders"),
        table(spark, sf_dir, "customer"),
        EDGES[2],
        salts=4,
        spread_by=["o_orderkey"],
    )
    return out.select("o_orderkey", "o_custkey", "c_name", "c_mktsegment")


# -- history -------------------------------------------------------------------

SCD = Scd("valid_from", "valid_to", "is_current")


def versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Status versions per customer, one per slot of 20 days that an order falls on.

    Versions last less than a slot, apart from those of the last slot, still open.
    """
    slot = F.col("slot").cast("int")
    return (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey", (F.col("o_orderkey") % 150).alias("slot"))
        .agg(
            F.max("o_orderkey").alias("o_orderkey"),
            F.max_by("o_orderstatus", "o_orderkey").alias("o_orderstatus"),
        )
        .withColumn(
            "valid_from",
            F.timestamp_add("DAY", 20 * slot, F.lit("1995-01-01").cast("timestamp_ntz")),
        )
        .select(
            "o_custkey",
            "o_orderkey",
            "o_orderstatus",
            "valid_from",
            F.when(
                slot < 149,
                F.timestamp_add("DAY", (5 + F.col("o_orderkey") % 15).cast("int"), "valid_from"),
            ).alias("valid_to"),
            (slot == 149).alias("is_current"),
        )
    )


_VERSIONS_SQL = """
WITH g AS (SELECT o_custkey, o_orderkey % 150 AS slot, max(o_orderkey) AS o_orderkey,
                  max_by(o_orderstatus, o_orderkey) AS o_orderstatus FROM orders GROUP BY 1, 2),
f AS (SELECT *, TIMESTAMP '1995-01-01' + to_days((20 * slot)::INT) AS valid_from FROM g),
v AS (SELECT o_custkey, o_orderkey, o_orderstatus, valid_from,
             CASE WHEN slot < 149 THEN valid_from + to_days((5 + o_orderkey % 15)::INT) END AS valid_to FROM f)"""


@query(_VERSIONS_SQL + " SELECT o_custkey, o_orderkey, o_orderstatus FROM v WHERE valid_to IS NULL")
def scd_current(spark: SparkSession, sf_dir: str) -> DataFrame:
    return history.scd_current(versions(spark, sf_dir), SCD).select(
        "o_custkey", "o_orderkey", "o_orderstatus"
    )


@query(
    _VERSIONS_SQL
    + """
SELECT o_custkey, o_orderkey, o_orderstatus FROM v
WHERE valid_from <= TIMESTAMP '1998-06-01' AND (valid_to IS NULL OR TIMESTAMP '1998-06-01' < valid_to)"""
)
def scd_as_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    at = F.lit("1998-06-01").cast("timestamp_ntz")
    return history.scd_as_of(versions(spark, sf_dir), SCD, at).select(
        "o_custkey", "o_orderkey", "o_orderstatus"
    )


@query(
    _VERSIONS_SQL
    + """
, x AS (SELECT l_orderkey, l_linenumber, l_partkey, o_custkey, l_shipdate FROM lineitem
        JOIN orders ON l_orderkey = o_orderkey)
, w AS (SELECT * FROM v UNION ALL
        SELECT o_custkey, -o_orderkey, 'X', valid_from, valid_from + INTERVAL 300 DAY FROM v WHERE o_custkey % 3 = 0)
SELECT x.l_orderkey, x.l_linenumber, x.l_partkey, x.o_custkey, coalesce(v.o_orderkey::VARCHAR, '') AS version,
       coalesce(v.o_orderstatus, '') AS o_orderstatus
FROM x LEFT JOIN w v ON v.o_custkey = x.o_custkey AND v.valid_from <= x.l_shipdate
     AND (v.valid_to IS NULL OR x.l_shipdate < v.valid_to)"""
)
def scd_as_of_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    facts = keys.join_along(
        table(spark, sf_dir, "lineitem").select(
            "l_orderkey", "l_linenumber", "l_partkey", "l_shipdate"
        ),
        table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey"),
        EDGES[0],
    )
    own = versions(spark, sf_dir)
    # every third customer also has versions that overlap
    longer = own.where("o_custkey % 3 = 0").select(
        "o_custkey", (-F.col("o_orderkey")).alias("o_orderkey"), F.lit("X").alias("o_orderstatus"), "valid_from",
        F.timestamp_add("DAY", F.lit(300), "valid_from").alias("valid_to"), F.lit(False).alias("is_current"),
    )
    dim = own.unionByName(longer).withColumnRenamed("o_orderkey", "version")
    return history.scd_as_of_join(facts, dim, SCD, ["o_custkey"], "l_shipdate", how="left").select(
        "l_orderkey", "l_linenumber", "l_partkey", "o_custkey", text("version"), text("o_orderstatus")
    )


# -- sensitivity, computed columns, quality --------------------------------------


@query(
    """
SELECT c_custkey, sha256(c_name) AS c_name, c_nationkey, NULL::DOUBLE AS c_acctbal,
       regexp_replace(c_mktsegment, '[A-Z]', 'X', 'g') AS c_mktsegment FROM customer"""
)
def redacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    hints = [
        ColumnHint("C_Name", "pii"),
        ColumnHint("c_name", "internal"),
        ColumnHint("C_ACCTBAL", "restricted"),
        ColumnHint("c_mktsegment", "phi"),
        ColumnHint("c_nationkey", "internal"),
    ]
    return quality.redact(table(spark, sf_dir, "customer"), hints, methods={"phi": "mask"})


@query(
    """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice * (1 - l_discount) AS net,
       year(l_shipdate)::INT AS ship_year FROM lineitem"""
)
def computed(spark: SparkSession, sf_dir: str) -> DataFrame:
    hints = [
        ColumnHint("net", expression="l_extendedprice * (1 - l_discount)"),
        ColumnHint("ship_year", expression="year(l_shipdate)"),
    ]
    return measures.add_computed(table(spark, sf_dir, "lineitem"), hints).select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "net", "ship_year"
    )


_PROFILED = (
    "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority", "maybe",
)
_MAYBE = "CASE WHEN o_orderkey % 3 <> 0 THEN o_orderpriority END"


def _profiled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("maybe", F.expr(_MAYBE))


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null,"
        f" count(DISTINCT {c}) AS n_distinct, (count(*) - count({c})) / count(*) AS null_ratio"
        f" FROM (SELECT *, {_MAYBE} AS maybe FROM orders)"
        for c in _PROFILED
    )
)
def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.profile(_profiled(spark, sf_dir), _PROFILED)


@query(
    " UNION ALL ".join(
        f"(SELECT '{c}' AS column_name, {c}::VARCHAR AS value, count(*) AS n,"
        f" (row_number() OVER (ORDER BY count(*) DESC, {c}::VARCHAR))::INT AS rank"
        f" FROM (SELECT *, {_MAYBE} AS maybe FROM orders) WHERE {c} IS NOT NULL GROUP BY {c}"
        f" ORDER BY rank LIMIT 3)"
        for c in _PROFILED
    )
)
def top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.top_values(_profiled(spark, sf_dir), _PROFILED, 3)


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null,"
        f" (count(*) - count({c})) / count(*) AS null_ratio FROM (SELECT *, {_MAYBE} AS maybe FROM orders)"
        for c in _PROFILED
    )
)
def profile_approx(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One-pass profile; its estimates of distinct values differ from exact ones and are tested apart."""
    return quality.profile_approx(_profiled(spark, sf_dir), _PROFILED).drop("n_distinct")


_NUMBERS = ("o_orderkey", "o_custkey", "o_totalprice")


@query(
    " UNION ALL ".join(
        f"SELECT '{c}' AS column_name, count(*) AS n_rows, count(*) - count({c}) AS n_null,"
        f" count(DISTINCT {c}) AS n_distinct, true AS distinct_within, '{'true' if c in _NUMBERS else ''}' AS quartiles_within"
        f" FROM (SELECT *, {_MAYBE} AS maybe FROM orders)"
        for c in _PROFILED
    )
)
def profile_sketches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sketches per month, stored and merged; the exact values lie inside the bounds they state."""
    rows = _profiled(spark, sf_dir)
    stored = working_folder(spark, "profile-parts")
    months = rows.withColumn("month", F.date_format("o_orderdate", "yyyy-MM"))
    sketches.sketch_profile(months, _PROFILED, ["month"]).write.parquet(stored)
    read = sketches.estimates(sketches.merge_profiles(spark.read.parquet(stored)))
    held = sketches.ranks(rows, read, _NUMBERS).groupBy("column_name").agg(F.every("within").alias("quartiles_within"))
    exact = quality.profile(rows, _PROFILED).select("column_name", F.col("n_distinct").alias("exact"))
    inside = F.col("exact").between(F.col("n_distinct_low"), F.col("n_distinct_high"))
    return (
        read.join(exact, "column_name").join(held, "column_name", "left")
        .select("column_name", "n_rows", "n_null", F.col("exact").alias("n_distinct"),
                inside.alias("distinct_within"), text("quartiles_within"))
    )


@query(
    """
SELECT 'events' AS table_name, 'daily' AS cadence, max(ts)::VARCHAR AS newest,
       (epoch_us(TIMESTAMP '2024-02-05') - epoch_us(max(ts))) // 1000000 AS lag_seconds,
       (epoch_us(TIMESTAMP '2024-02-05') - epoch_us(max(ts))) // 1000000 > 2 * 86400 AS stale FROM events
UNION ALL
SELECT 'orders', 'adhoc', max(o_orderdate)::VARCHAR,
       (epoch_us(TIMESTAMP '2024-02-05') - epoch_us(max(o_orderdate))) // 1000000, false FROM orders"""
)
def freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    now = F.lit("2024-02-05 00:00:00").cast("timestamp_ntz")
    both = quality.check_freshness(
        table(spark, sf_dir, "events"), "ts", "daily", now, "events"
    ).unionByName(
        quality.check_freshness(
            table(spark, sf_dir, "orders"), "o_orderdate", "adhoc", now, "orders"
        )
    )
    return both.withColumn("newest", F.col("newest").cast("string"))


@query(
    " UNION ALL ".join(f"SELECT '{n}' AS table_name, count(*) AS row_count FROM {n}" for n in NAMES)
)
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.row_counts({n: table(spark, sf_dir, n) for n in NAMES})


@query(
    """
WITH tabs AS (SELECT s_suppkey AS pos, 't' || s_suppkey AS table_name,
                     ['n' || s_nationkey, 't' || (s_suppkey + 1)] AS aliases FROM supplier),
cand AS (SELECT table_name AS name, 0 AS b, pos, table_name FROM tabs
         UNION ALL SELECT unnest(aliases), 1, pos, table_name FROM tabs),
best AS (SELECT *, row_number() OVER (PARTITION BY name ORDER BY b, pos) AS rn FROM cand),
asked AS (SELECT o_orderkey, CASE WHEN o_orderkey % 2 = 0 THEN 't' || o_custkey ELSE 'n' || o_custkey % 30 END AS name
          FROM orders)
SELECT o_orderkey, asked.name, coalesce(table_name, '') AS table_name, coalesce((b = 1)::VARCHAR, '') AS by_alias
FROM asked LEFT JOIN best ON best.name = asked.name AND rn = 1"""
)
def alias_resolution(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = F.col("s_suppkey")
    tables = table(spark, sf_dir, "supplier").select(
        F.lit("p0").alias("project_id"),
        s.alias("pos"),
        F.concat(F.lit("t"), s.cast("string")).alias("table_name"),
        F.array(
            F.concat(F.lit("n"), F.col("s_nationkey").cast("string")),
            F.concat(F.lit("t"), (s + 1).cast("string")),
        ).alias("aliases"),
    )
    asked = table(spark, sf_dir, "orders").select(
        F.lit("p0").alias("project_id"),
        "o_orderkey",
        F.when(
            F.col("o_orderkey") % 2 == 0, F.concat(F.lit("t"), F.col("o_custkey").cast("string"))
        )
        .otherwise(F.concat(F.lit("n"), (F.col("o_custkey") % 30).cast("string")))
        .alias("name"),
    )
    return quality.resolve_alias(asked, tables).select(
        "o_orderkey", "name", text("table_name"), text("by_alias")
    )


@query(
    """
WITH terms AS (SELECT text AS term FROM benchmark
               UNION ALL SELECT unnest(string_split(text, ' ')) FROM benchmark),
norm AS (SELECT DISTINCT term,
           trim(regexp_replace(lower(term), '[^\\p{L}\\p{N}_]+', ' ', 'g')) AS t FROM terms),
docs AS (SELECT doc_id, ' ' || trim(regexp_replace(lower(text), '[^\\p{L}\\p{N}_]+', ' ', 'g')) || ' ' AS t FROM documents)
SELECT doc_id, term FROM docs JOIN norm ON norm.t <> '' AND contains(docs.t, ' ' || norm.t || ' ')"""
)
def tag_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole benchmark passages and each of their words as terms."""
    texts = table(spark, sf_dir, "benchmark").select("text")
    terms = texts.select(F.col("text").alias("term")).unionByName(
        texts.select(F.explode(F.split("text", " ")).alias("term"))
    )
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return quality.tag_terms(docs, terms, "doc_id")
