import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import catalog, drift, keys, quality
from tessera.sources.information_schema import spark_catalog_columns, with_connection

COLS = (
    "table_schema string, table_name string, column_name string, data_type string,"
    " is_nullable string, ordinal_position int"
)


def harvest(spark):
    return spark.createDataFrame(
        [
            ("s", "t", "b", "int", "NO", 2),
            ("s", "t", "a", "int", None, 1),
            ("s", "t", "late", None, "no", None),
            ("s", "t", "", "int", "NO", 3),
            ("S", "t", "other", "int", "NO", 1),
            ("s", "", "x", "int", "NO", 1),
        ],
        COLS,
    )


def test_columns_of_one_table(spark):
    got = [tuple(r) for r in catalog.list_columns(harvest(spark), "s", "t").collect()]
    assert got == [("late", "", False, 0), ("a", "int", True, 1), ("b", "int", False, 2)]


def test_requested_tables_always_appear(spark):
    wanted = spark.createDataFrame([("s", "t"), ("s", "none"), ("s", "t")], COLS.split(", c")[0])
    got = catalog.columns_for_requested(harvest(spark), wanted).collect()
    assert {(r.table_name, r.name, r.found) for r in got} == {
        ("t", "b", True), ("t", "a", True), ("t", "late", True), ("t", "", True), ("none", None, False),
    }


def test_search_is_literal(spark):
    df = spark.createDataFrame([("a%b",), ("aXb",), ("",), (None,)], "schema_name string")
    assert [r.name for r in catalog.list_schemas(df, "A%").collect()] == ["a%b"]
    assert catalog.list_schemas(df).count() == 2


def test_types(spark):
    df = spark.createDataFrame(
        [
            ("nvarchar", 40, None, None, "nvarchar(40)"),
            ("varbinary", -1, None, None, "varbinary(max)"),
            ("varchar", None, None, None, "varchar"),
            ("decimal", None, 18, None, "decimal(18,0)"),
            ("numeric", None, 18, 2, "numeric(18,2)"),
            ("int", 4, 10, 0, "int"),
        ],
        "t string, l int, p int, s int, expected string",
    )
    bad = df.where(catalog.render_type(df.t, df.l, df.p, df.s) != df.expected)
    assert bad.count() == 0


def test_age_equal_to_the_ttl_is_fresh(spark):
    now = dt.datetime(2024, 1, 1, 12, 0, 0)
    fetched = spark.createDataFrame(
        [("a", now - dt.timedelta(seconds=300)), ("b", now - dt.timedelta(seconds=301)),
         ("a", now - dt.timedelta(seconds=900))],
        "key string, fetched_at timestamp_ntz",
    )
    asked = spark.createDataFrame([("a",), ("b",), ("c",)], "key string")
    out = catalog.split_stale(asked, fetched, ["key"], F.lit(now))
    assert {r.key: r.stale for r in out.collect()} == {"a": False, "b": True, "c": True}


def test_scalar_status(spark):
    def status(rows):
        return tuple(catalog.scalar_status(spark.createDataFrame(rows, "x int, y int")).first())[:3]

    assert status([(7, 1)]) == (True, "7", "")
    assert status([]) == (False, "", "no_rows")
    assert status([(None, 1)]) == (False, "", "null_value")


def test_describe_and_browse(spark):
    df = spark.createDataFrame([(1, "a")], "id long, name string")
    rows = catalog.describe_tables(spark, {"t": df}, "s")
    assert [tuple(r) for r in catalog.list_columns(rows, "s", "t", "NAM").collect()] == [
        ("name", "string", True, 2)
    ]
    conns = spark.createDataFrame([("c", "trino", "d", None)], "name string, engine string, dsn string, catalog string")
    all_rows = with_connection(rows, "c")
    args = (conns, all_rows.withColumnRenamed("table_schema", "schema_name"),
            all_rows.withColumn("table_type", F.lit("view")), all_rows)
    assert tuple(catalog.browse(*args).first()) == ("c", "trino", "d", "none")
    assert catalog.browse(*args, connection="other").count() == 0
    assert [r.table_type for r in catalog.browse(*args, connection="c", schema="s").collect()] == ["VIEW"] * 2
    assert spark_catalog_columns(spark, "default").count() == 0


def test_outcomes_of_a_refresh(spark):
    tables = spark.createDataFrame(
        [("p", "a", "c", "s.a"), ("p", "b", "c", "nodot"), ("p", "d", "x", "s.d"), ("p", "e", "c", "s.e"),
         ("p", "f", None, "s.f")],
        "project_id string, table_name string, connection string, staging_target string",
    )
    connections = spark.createDataFrame([("p", "c")], "project_id string, name string")
    failed = spark.createDataFrame(
        [("p", "c", "s", "e", "query_failed", "boom")],
        "project_id string, connection string, table_schema string, live_table string, reason string, detail string",
    )
    status = drift.target_status(tables, connections, failed)
    got = {
        r.table_name: (r.outcome, r.reason, r.last_run_at)
        for r in drift.refresh_outcomes(status, F.lit("now")).collect()
    }
    assert got == {
        "a": ("refreshed", None, "now"),
        "b": ("skipped", "no connection or staging_target", None),
        "d": ("skipped", "connection 'x' not found", None),
        "e": ("failed", "query_failed", None),
        "f": ("skipped", "no connection or staging_target", None),
    }


def test_corroborate_without_known_tables_is_empty(spark):
    edges = spark.createDataFrame(
        [("e", ("s", "t", "c"), ("s", "u", "c"))],
        "id string, left struct<schema:string,table:string,column:string>,"
        " right struct<schema:string,table:string,column:string>",
    )
    assert keys.corroborate(edges, {"t": spark.range(3).toDF("c")}).count() == 0


def test_row_count_stamp_and_alias_order(spark):
    tables = spark.createDataFrame(
        [("p", 0, "a", ["b", "z"], None, None), ("p", 1, "b", ["z"], 5, "then")],
        "project_id string, pos int, table_name string, aliases array<string>,"
        " row_count_last_run long, last_run_at string",
    )
    counts = quality.row_counts({"a": spark.range(3)})
    out = {r.table_name: (r.row_count_last_run, r.last_run_at)
           for r in quality.stamp_row_counts(tables, counts, F.lit("now")).collect()}
    assert out == {"a": (3, "now"), "b": (5, "then")}
    asked = spark.createDataFrame([("p", "b"), ("p", "z"), ("p", "q")], "project_id string, name string")
    got = {r.name: (r.table_name, r.by_alias) for r in quality.resolve_alias(asked, tables).collect()}
    assert got == {"b": ("b", False), "z": ("a", True), "q": (None, None)}


def test_corroborate_whole_keys_schemas_and_types(spark):
    end = "struct<schema:string,table:string,column:string>"
    kind = f"id string, left {end}, right {end}, extra array<struct<left:{end},right:{end}>>"
    at = lambda s, t, c: (s, t, c)
    edges = spark.createDataFrame(
        [
            ("pair", at("s1", "a", "x"), at("s1", "b", "x"), [(at("s1", "b", "y"), at("s1", "A", "Y"))]),
            ("other", at("s2", "a", "x"), at("s1", "b", "x"), []),
            ("bare", at(None, "b", "x"), at("s1", "a", "x"), None),
            ("unclear", at(None, "a", "x"), at("s1", "b", "x"), None),
            ("gone", at("s1", "a", "no"), at("s1", "b", "x"), None),
        ],
        kind,
    )
    tables = {
        "s1.a": spark.createDataFrame([(1, 2), (2, 1), (None, 1)], "x int, y int"),
        "S1.b": spark.createDataFrame([(1, 1), (2, 2)], "x int, y int").selectExpr("cast(x as decimal(9,2)) x", "y"),
        "s2.a": spark.createDataFrame([(1,), (1,), (7,)], "x long"),
    }
    got = {r.id: r for r in keys.corroborate(edges, tables).collect()}
    assert set(got) == {"pair", "other", "bare"}
    pair, other, bare = got["pair"], got["other"], got["bare"]
    assert (pair.left_rows, pair.left_matched, pair.verdict) == (2, 0, "refuted")
    assert (other.left_rows, other.left_matched, other.right_matched, other.cardinality, other.verdict) == (
        3, 2, 1, "one_to_many", "weak",
    )
    assert (bare.left_rate, bare.right_rate, bare.cardinality, bare.verdict) == (1.0, 1.0, "one_to_one", "confirmed")
