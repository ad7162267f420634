import pytest

from tessera.operators import drift

SHAPE = "project_id string, table_name string, pos int, name string, type string, nullable boolean"


def rows(spark, *columns):
    return spark.createDataFrame(
        [("p", "t", i, *c) for i, c in enumerate(columns)], SHAPE
    )


CASES = {
    "identical": ([("x", "int", False)], [("x", "int", False)], set()),
    "added and removed": (
        [("a", "int", True), ("b", "varchar(40)", True)],
        [("a", "int", True), ("gone", "varchar", True)],
        {("added", "b"), ("removed", "gone")},
    ),
    "case only": ([("OrderId", "bigint", False)], [("orderid", "bigint", False)], set()),
    "type change across case": (
        [("OrderId", "bigint", True)],
        [("orderid", "int", True)],
        {("changed", "OrderId")},
    ),
    "unknown type is no change": ([("col", "", True)], [("col", "bigint", False)], set()),
    "blank type is no change": ([("col", " \t", True)], [("col", "bigint", False)], set()),
    "unknown type can be added": ([("newcol", "", True)], [], {("added", "newcol")}),
    "nullability": ([("x", "INT ", True)], [("x", "int", False)], {("changed", "x")}),
    "last duplicate is compared": (
        [("x", "int", True)],
        [("X", "text", True), ("x", "int", True)],
        set(),
    ),
    "authored duplicates are all compared": (
        [("x", "text", True), ("X", "date", True)],
        [("x", "int", True)],
        {("changed", "x"), ("changed", "X")},
    ),
    "live duplicates are all removed": (
        [],
        [("x", "int", True), ("X", "int", True)],
        {("removed", "x"), ("removed", "X")},
    ),
}


@pytest.mark.parametrize("case", list(CASES))
def test_diff(spark, case):
    authored, live, expected = CASES[case]
    out = drift.diff_columns(rows(spark, *authored), rows(spark, *live))
    assert {(r.change_type, r.name) for r in out.collect()} == expected


def test_before_is_live_and_after_is_authored(spark):
    out = drift.diff_columns(rows(spark, ("a", "bigint", True)), rows(spark, ("A", "int", False)))
    r = out.first()
    assert (r.before_type, r.before_nullable, r.after_type, r.after_nullable) == (
        "int", False, "bigint", True,
    )


def test_target_is_cut_at_the_first_dot(spark):
    df = spark.createDataFrame([("a.b.c",)], "t string")
    r = df.select(drift.target_schema(df.t), drift.target_table(df.t)).first()
    assert tuple(r) == ("a", "b.c")


def test_refresh_keeps_hints_by_exact_name(spark):
    from pyspark.sql import functions as F

    authored = rows(spark, ("OrderId", "int", True), ("gone", "int", True)).withColumns(
        {
            "description": F.lit("the key"),
            "is_primary_key": F.lit(True),
            "example_values": F.array(F.lit("1")),
        }
    )
    live = rows(spark, ("orderid", "bigint", False), ("fresh", "int", True))
    exact = {r.name: r for r in drift.refresh_columns(authored, live).collect()}
    assert set(exact) == {"orderid", "fresh"}
    assert exact["orderid"].description is None and exact["orderid"].is_primary_key is False
    assert exact["orderid"].example_values == []
    loose = drift.refresh_columns(authored, live, case_insensitive=True)
    kept = {r.name: r for r in loose.collect()}["orderid"]
    assert (kept.type, kept.nullable, kept.description, kept.is_primary_key) == (
        "bigint", False, "the key", True,
    )
