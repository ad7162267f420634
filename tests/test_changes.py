from pyspark.sql import functions as F

from tessera.operators import changes

TABLES = (
    "project_id string, pos int, table_name string, description string, owner string, grain string,"
    " primary_keys array<string>"
)


def tables(spark):
    return spark.createDataFrame(
        [("p", 0, "a", "x", "me", None, []), ("p", 1, "b", "y", None, "old", ["k"])], TABLES
    )


def outcome(df):
    return {r.seq: (r.outcome, r.reason) for r in df.collect()}


def test_upsert_keeps_the_place(spark):
    rows = spark.createDataFrame(
        [("p", 1, "c", "new"), ("p", 2, "a", "again"), ("p", 3, "c", "newer")],
        "project_id string, seq long, table_name string, description string",
    )
    state, out = changes.upsert_tables(tables(spark), rows)
    got = [(r.table_name, r.description, r.owner) for r in state.orderBy(*changes.ORDER).collect()]
    # whole records: the owner of a is gone
    assert got == [("a", "again", None), ("b", "y", None), ("c", "newer", None)]
    assert {k: v[0] for k, v in outcome(out).items()} == {1: "added", 2: "updated", 3: "updated"}


def test_grain(spark):
    rows = spark.createDataFrame(
        [("p", 1, "a", "one row"), ("p", 2, "b", ""), ("p", 3, "a", "x" * 241), ("p", 4, "zz", "g")],
        "project_id string, seq long, table_name string, grain string",
    )
    state, out = changes.set_table_grain(tables(spark), rows)
    assert {r.table_name: r.grain for r in state.collect()} == {"a": "one row", "b": None}
    assert outcome(out) == {
        1: ("set", None), 2: ("set", None), 3: ("rejected", "grain too long"),
        4: ("rejected", "unknown table"),
    }


def test_pitfalls(spark):
    old = spark.createDataFrame(
        [("p", "a", 0, "mind")], "project_id string, table_name string, pos int, message string"
    )
    rows = spark.createDataFrame(
        [("p", 1, "a", " mind "), ("p", 2, "a", "gap"), ("p", 3, "a", "gap"), ("p", 4, "a", " "),
         ("p", 5, "b", "mind"), ("p", 6, "a", "x" * 241)],
        "project_id string, seq long, table_name string, message string",
    )
    state, out = changes.add_pitfall(old, tables(spark), rows)
    got = [(r.table_name, r.message) for r in state.orderBy("table_name", *changes.ORDER).collect()]
    assert got == [("a", "mind"), ("a", "gap"), ("b", "mind")]
    assert [outcome(out)[i][0] for i in range(1, 7)] == [
        "already recorded", "added", "already recorded", "rejected", "added", "rejected",
    ]


def test_classification(spark):
    columns = spark.createDataFrame(
        [("p", "a", 0, "Id", "unspecified")],
        "project_id string, table_name string, pos int, name string, classification string",
    )
    rows = spark.createDataFrame(
        [("p", 1, "a", "Id", "pii"), ("p", 2, "a", "id", "pii"), ("p", 3, "a", "Id", "secret"),
         ("p", 4, "q", "Id", "pii")],
        "project_id string, seq long, table_name string, name string, classification string",
    )
    state, out = changes.set_classification(columns, rows)
    assert state.first().classification == "pii"
    assert [outcome(out)[i][1] for i in range(1, 5)] == [
        None, "unknown column", "unknown classification", "unknown table",
    ]


def test_primary_key(spark):
    columns = spark.createDataFrame(
        [("p", "b", 0, "k", True), ("p", "b", 1, "l", False), ("p", "a", 0, "x", True)],
        "project_id string, table_name string, pos int, name string, is_primary_key boolean",
    )
    rows = spark.createDataFrame(
        [("p", 1, "b", ["k"]), ("p", 2, "b", ["l", "later"]), ("p", 3, "zz", ["k"])],
        "project_id string, seq long, table_name string, columns array<string>",
    )
    state, cols, out, unlisted = changes.set_primary_key(tables(spark), columns, rows)
    assert {r.table_name: r.primary_keys for r in state.collect()} == {"a": [], "b": ["l", "later"]}
    assert {(r.table_name, r.name): r.is_primary_key for r in cols.collect()} == {
        ("b", "k"): False, ("b", "l"): True, ("a", "x"): True,
    }
    assert outcome(out)[3] == ("rejected", "unknown table")
    assert [(r.seq, r.name) for r in unlisted.collect()] == [(2, "later")]
    cleared, cols, _, _ = changes.set_primary_key(
        tables(spark), columns, rows.where("seq = 1").withColumn("columns", F.expr("array()"))
    )
    assert {r.table_name: r.primary_keys for r in cleared.collect()}["b"] == []
    assert not any(r.is_primary_key for r in cols.where("table_name = 'b'").collect())


def test_patch_null_overwrites_and_absent_keeps(spark):
    rows = spark.createDataFrame(
        [
            ("p", 1, "a", ["owner"], None, None, None),
            ("p", 2, "b", ["grain"], None, None, "g"),
            ("p", 3, "b", ["description"], None, None, None),
            ("p", 4, "n", ["owner"], None, "you", None),
            ("p", 5, "a", ["source_file"], None, None, None),
            ("p", 6, "a", ["grain", "nope"], None, None, "g"),
            ("p", 7, "n", [], None, None, None),
            ("p", 8, "a", ["grain"], None, None, "x" * 241),
        ],
        "project_id string, seq long, table_name string, present array<string>, description string,"
        " owner string, grain string",
    )
    state, out = changes.patch_tables(tables(spark), rows)
    got = {r.table_name: (r.description, r.owner, r.grain) for r in state.collect()}
    assert got == {"a": ("x", None, None), "b": ("y", None, "g"), "n": ("", "you", None)}
    assert [outcome(out)[i][0] for i in range(1, 9)] == [
        "updated", "updated", "rejected", "added", "rejected", "rejected", "updated", "rejected",
    ]


def test_config_patch(spark):
    projects = spark.createDataFrame(
        [("p", "Name", "tsql", "before")],
        "project_id string, name string, dialect string, updated_at string",
    )
    rows = spark.createDataFrame(
        [("p", 1, ["dialect"], None, "spark"), ("p", 2, ["name"], "", None), ("p", 3, [], None, None),
         ("p", 4, ["glossary"], None, None), ("q", 5, ["dialect"], None, "spark")],
        "project_id string, seq long, present array<string>, name string, dialect string",
    )
    state, out = changes.patch_project_config(projects, rows)
    stamped = changes.stamp(state, out, F.lit("now")).first()
    assert (stamped.name, stamped.dialect, stamped.updated_at) == ("Name", "spark", "now")
    assert [outcome(out)[i][1] for i in range(1, 6)] == [
        None, "name may not be empty", "patch must not be empty", "unknown patch fields", "unknown project",
    ]


def test_nothing_changes_nothing_is_stamped(spark):
    projects = spark.createDataFrame([("p", "before")], "project_id string, updated_at string")
    out = spark.createDataFrame([("p", "already recorded"), ("p", "rejected")], "project_id string, outcome string")
    assert changes.stamp(projects, out, F.lit("now")).first().updated_at == "before"


def test_connections_need_a_catalog_under_trino(spark):
    old = spark.createDataFrame(
        [("p", 0, "c", "trino", "d", "hive", "text")],
        "project_id string, pos int, name string, engine string, dsn string, catalog string, description string",
    )
    rows = spark.createDataFrame(
        [("p", 1, "c", "databricks", "d2", None), ("p", 2, "x", "trino", "d", " "), ("p", 3, "y", "db2", "d", "c")],
        "project_id string, seq long, name string, engine string, dsn string, catalog string",
    )
    state, out = changes.upsert_connections(old, rows)
    (row,) = state.collect()
    assert (row.engine, row.dsn, row.catalog, row.description) == ("databricks", "d2", None, None)
    assert [outcome(out)[i][0] for i in (1, 2, 3)] == ["updated", "rejected", "rejected"]


def test_upserted_tables_are_tested_to_the_bottom(spark):
    part = "columns array<struct<name: string, classification: string>>"
    state = spark.createDataFrame(
        [], f"project_id string, pos int, table_name string, refresh_cadence string, scd struct<type: string>, {part}"
    )
    good = [("Id", "pii"), ("x", None)]
    rows = spark.createDataFrame(
        [
            ("p", 1, "a", None, None, good),
            ("p", 2, "", "daily", None, good),
            ("p", 3, None, "daily", None, None),
            ("p", 4, "b", "often", None, None),
            ("p", 5, "c", "daily", ("bogus",), None),
            ("p", 6, "d", "daily", ("scd2",), [("Id", "secret")]),
            ("p", 7, "e", "daily", ("scd2",), [("", "pii")]),
            ("p", 8, "f", "daily", (None,), []),
        ],
        f"project_id string, seq long, table_name string, refresh_cadence string, scd struct<type: string>, {part}",
    )
    after, out = changes.upsert_tables(state, rows)
    assert {r.table_name for r in after.collect()} == {"a", "f"}
    assert [outcome(out)[i][1] for i in range(1, 9)] == [
        None, "table_name is required", "table_name is required", "refresh_cadence is not an allowed word",
        "scd type is not an allowed word", "columns has an invalid entry", "columns has an invalid entry", None,
    ]
    patches = rows.where("seq in (5, 6, 8)").withColumn("present", F.expr("array('scd', 'columns')"))
    _, out = changes.patch_tables(after, patches.withColumn("table_name", F.lit("a")))
    assert [outcome(out)[i][1] for i in (5, 6)] == ["scd type is not an allowed word", "columns has an invalid entry"]


def test_descriptions_and_key_lists_are_tested(spark):
    old = spark.createDataFrame(
        [], "project_id string, pos int, name string, engine string, dsn string, catalog string, description string"
    )
    rows = spark.createDataFrame(
        [("p", 1, "c", "databricks", "d", None, "x" * 5000), ("p", 2, "e", None, "d", None, None)],
        "project_id string, seq long, name string, engine string, dsn string, catalog string, description string",
    )
    state, out = changes.upsert_connections(old, rows)
    assert state.count() == 0 and [outcome(out)[i][1] for i in (1, 2)] == ["description too long", "unknown engine"]
    columns = spark.createDataFrame([], "project_id string, table_name string, pos int, name string, is_primary_key boolean")
    keys = spark.createDataFrame([("p", 1, "a", None)], "project_id string, seq long, table_name string, columns array<string>")
    _, _, out, _ = changes.set_primary_key(tables(spark), columns, keys)
    assert outcome(out) == {1: ("rejected", "columns are required")}


def test_a_small_batch_moves_no_state(spark):
    """State rows reach the result through broadcast joins alone."""
    state = spark.range(50_000).selectExpr(
        "'p' as project_id", "cast(id as int) as pos", "concat('t', id) as table_name", "'d' as description"
    )
    rows = spark.range(5).selectExpr("'p' as project_id", "id as seq", "concat('t', id) as table_name", "'n' as description")
    for after in (changes.upsert_tables(state, rows)[0], changes.append_distinct(state, rows, ("project_id", "table_name"), ("description",))[0]):
        after.collect()
        plan = after._jdf.queryExecution().executedPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
