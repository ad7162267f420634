import pytest
from pyspark.sql import functions as F

from tessera.operators import history, keyed, keys, measures, quality
from tessera.operators.declared import ColumnHint, Measure, Relationship, Scd


def test_keys_with_nulls(spark):
    df = spark.createDataFrame([(1, 1), (1, 1), (1, 2), (None, 1), (None, 1)], "a int, b int")
    r = keys.check_primary_key(df, ["a", "b"], "t").first()
    assert (r.n_rows, r.n_keys, r.duplicate_keys, r.duplicate_rows, r.null_key_rows, r.ok) == (
        5, 2, 1, 2, 2, False,
    )
    assert [tuple(x) for x in keys.duplicate_keys(df, ["a", "b"]).collect()] == [(1, 1, 2)]
    assert keys.check_primary_key(df.limit(0), ["a"]).first().ok


def test_null_foreign_keys_are_no_orphans(spark):
    child = spark.createDataFrame([(1, "a"), (2, "a"), (2, "a"), (None, "a"), (1, None)], "x int, y string")
    parent = spark.createDataFrame([(1, "a")], "p int, q string")
    rel = Relationship("c", "p", ("x", "y"), ("p", "q"))
    r = keys.check_foreign_key(child, parent, rel).first()
    assert (r.orphan_keys, r.orphan_rows) == (1, 2)
    assert keys.check_cardinality(child, parent, rel).first().observed == "one_to_many"
    with pytest.raises(ValueError):
        Relationship("c", "p", ("x",), ())


@pytest.mark.parametrize("how", ["inner", "left", "left_semi", "left_anti"])
def test_salted_join_equals_plain_join(spark, how):
    many = spark.range(500).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    one = spark.createDataFrame([(0, "a"), (1, "b"), (1, "c")], "k long, n string")
    plain = many.join(one, ["k"], how)
    salted = keyed.salted_join(many, one, ["k"], how, 5, ["v"])
    assert sorted(map(tuple, plain.collect())) == sorted(map(tuple, salted.collect()))


def test_first_and_latest(spark):
    df = spark.createDataFrame([("a", 2, "x"), ("a", 1, None), ("b", 1, "y")], "k string, n int, v string")
    assert {r.k: r.v for r in keyed.first_per_key(df, ["k"], "n").collect()} == {"a": None, "b": "y"}
    assert {r.k: r.v for r in keyed.latest_per_key(df, ["k"], "n").collect()} == {"a": "x", "b": "y"}


def test_measure_with_where(spark):
    df = spark.createDataFrame([("g", 1, True), ("g", 1, True), ("g", 2, False)], "g string, c int, f boolean")
    ms = [Measure("m", "count(distinct c) WHERE f"), Measure("s", "sum(c) / count(*)")]
    r = measures.evaluate_measures(df, ms, ["g"]).first()
    assert (r.m, r.s) == (1, 4 / 3)


def test_as_of_join_bounds_and_buckets(spark):
    scd = Scd("f", "t", None)
    dim = spark.createDataFrame(
        [("k", "2020-01-01", "2020-03-01", "a"), ("k", "2020-03-01", "2020-06-01", "b"),
         ("k", "2020-03-01", "2020-03-01", "empty"), ("k", "2020-09-01", None, "open"),
         ("j", "2099-01-01", None, "future"), (None, "2020-01-01", None, "nobody"), ("i", None, None, "never")],
        "k string, f string, t string, v string",
    ).withColumns({"f": F.col("f").cast("timestamp"), "t": F.col("t").cast("timestamp")})
    facts = spark.createDataFrame(
        [("k", "2019-12-31"), ("k", "2020-01-01"), ("k", "2020-02-29"), ("k", "2020-03-01"), ("k", "2020-03-01"),
         ("k", "2020-07-01"), ("k", "2025-07-01"), ("z", "2021-01-01"), ("j", "2021-01-01"), (None, "2021-01-01"),
         ("k", None), ("i", "2021-01-01")],
        "k string, at string",
    ).withColumn("at", F.col("at").cast("timestamp"))
    expected = [
        ("", "2021-01-01", None), ("i", "2021-01-01", None), ("j", "2021-01-01", None), ("k", "", None),
        ("k", "2019-12-31", None), ("k", "2020-01-01", "a"), ("k", "2020-02-29", "a"), ("k", "2020-03-01", "b"),
        ("k", "2020-03-01", "b"), ("k", "2020-07-01", None), ("k", "2025-07-01", "open"), ("z", "2021-01-01", None),
    ]
    for seconds in (3_600, 86_400 * 30, 86_400 * 5000):
        out = history.scd_as_of_join(facts, dim, scd, ["k"], "at", "left", seconds)
        got = sorted((r.k or "", str(r["at"] or "")[:10], r.v) for r in out.collect())
        assert got == expected
        inner = history.scd_as_of_join(facts, dim, scd, ["k"], "at", "inner", seconds)
        assert sorted((r.k, str(r["at"])[:10], r.v) for r in inner.collect()) == [
            e for e in expected if e[2]
        ]
    assert {r.v for r in history.scd_current(dim, scd).collect()} == {
        "open", "future", "nobody", "never",
    }


def test_redaction(spark):
    df = spark.createDataFrame([("Ann", 1, "x", 2.0)], "name string, id int, open string, pay double")
    hints = [ColumnHint("name", "pii"), ColumnHint("pay", "restricted"), ColumnHint("id", "public")]
    r = quality.redact(df, hints).first()
    assert r.pay is None and len(r.name) == 64 and (r.id, r.open) == (1, "x")
    assert quality.redact(df, hints, allowed=["pii"]).first().name == "Ann"
    assert quality.redact(df, hints, methods={"pii": "mask"}).first().name == "Xxx"


def test_hints_match_names_as_the_session_does(spark):
    df = spark.createDataFrame([("Ann", 1)], "email string, id int")
    hidden = quality.redact(df, [ColumnHint("Email", "pii"), ColumnHint("EMAIL", "public")]).first()
    assert len(hidden.email) == 64
    with pytest.raises(ValueError, match="e_mail"):
        quality.redact(df, [ColumnHint("e_mail", "restricted")])
    assert quality.redact(df, [ColumnHint("gone", "public"), ColumnHint("x", "pii")], allowed=["pii"]).count() == 1


def test_estimates_of_distinct_values_are_near(spark):
    df = spark.range(200_000).select((F.col("id") % 50_000).alias("a"), F.col("id").alias("b"))
    got = {r.column_name: r.n_distinct for r in quality.profile_approx(df, ["a", "b"]).collect()}
    assert abs(got["a"] - 50_000) < 5_000 and abs(got["b"] - 200_000) < 20_000


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp"])
def test_as_of_join_against_all_pairs(spark, zone, kind):
    """Overlapping, nested, equal, open and empty versions; facts before, within and behind them."""
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        hour = lambda c: F.expr(f"timestampadd(HOUR, cast({c} as int), timestamp_ntz'2024-03-09 00:00:00')").cast(kind)
        spans = [(0, 900, "long"), (24, 60, "short"), (24, 60, "same"), (40, None, "open"), (70, 70, "empty"), (71, 72, "hour")]
        rows = [("x", s, e, v) for s, e, v in spans] + [("y", 0, 30, "a"), ("y", 30, 50, "b"), ("y", 90, None, "c")]
        dim = spark.createDataFrame(rows, "k string, s int, e int, v string").select(
            "k", hour("s").alias("f"), hour("e").alias("t"), "v"
        )
        times = [("x", h) for h in range(-3, 100, 4)] + [("y", h) for h in range(-2, 120, 5)] + [("z", 5), ("x", 5000)]
        facts = spark.createDataFrame(times, "k string, h int").select("k", "h", hour("h").alias("at"))
        want = []
        for k, h in times:
            hits = [v for key, s, e, v in rows if key == k and s <= h and (e is None or h < e)]
            want += [(k, h, v) for v in hits] or [(k, h, None)]
        for seconds in (3_600, 86_400, 86_400 * 400):
            out = history.scd_as_of_join(facts, dim, Scd("f", "t", None), ["k"], "at", "left", seconds)
            assert sorted(((r.k, r.h, r.v) for r in out.collect()), key=str) == sorted(want, key=str)
            inner = history.scd_as_of_join(facts, dim, Scd("f", "t", None), ["k"], "at", "inner", seconds)
            assert inner.count() == sum(v is not None for _, _, v in want)
        at = hour("41")
        assert {r.v for r in history.scd_as_of(dim, Scd("f", "t", None), at).collect()} == {"long", "short", "same", "open", "b"}
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_profiles_agree(spark):
    df = spark.range(100).select((F.col("id") % 7).alias("a"), F.when(F.col("id") % 4 == 0, "x").alias("b"))
    exact = {r.column_name: tuple(r) for r in quality.profile(df, ["a", "b"]).collect()}
    rough = {r.column_name: tuple(r) for r in quality.profile_approx(df, ["a", "b"]).collect()}
    assert exact == rough == {"a": ("a", 100, 0, 7, 0.0), "b": ("b", 100, 75, 1, 0.75)}
    plan = quality.top_values(df, ["a"], 2)._jdf.queryExecution().executedPlan().toString()
    assert "WindowGroupLimit" in plan


def test_terms_are_whole_words(spark):
    docs = spark.createDataFrame([(1, "The active Customer, active!"), (2, "reactive customers"), (3, "")], "id int, text string")
    terms = spark.createDataFrame([("Active customer",), ("active",), ("??",)], "term string")
    got = {tuple(r) for r in quality.tag_terms(docs, terms, "id").collect()}
    assert got == {(1, "Active customer"), (1, "active")}
    assert quality.tag_terms(docs, terms.where("term = '??'"), "id").count() == 0


def test_only_runs_that_begin_a_term_are_formed(spark):
    rows = [(k, f"filler{k} words{k} and Red  green, blue{k % 3} tail{k}") for k in range(500)]
    docs = spark.createDataFrame([*rows, (500, None), (501, "")], "id int, text string")
    terms = spark.createDataFrame([("red green",), ("red green blue1 tail1",), ("tail7",), ("blue2",)], "term string")
    got = {tuple(r) for r in quality.tag_terms(docs, terms, "id").collect()}
    expected = {(k, "red green") for k in range(500)} | {(k, "blue2") for k in range(500) if k % 3 == 2}
    assert got == expected | {(7, "tail7"), (1, "red green blue1 tail1")}
    wanted = terms.selectExpr("term", "slice(split(term, ' '), 1, 3) AS _first")
    formed = quality._beginnings(docs, wanted, "id", "text").collect()
    beginnings = {"red green", "blue2", "tail7"} | {"red green blue1"}
    # two in a million other runs may share a bit
    assert len(formed) <= 2 * 500 + 10 and {r["_anchor"] for r in formed} >= beginnings
    assert quality.tag_terms(docs, terms.limit(0), "id").count() == 0


def test_runs_are_made_once_for_terms_of_any_length(spark):
    rows = [(None, "Red green blue tail"), (None, "red, green blue tail"), (1, "tail red green blue"), (1, "red green blue tail")]
    docs = spark.createDataFrame([*rows, (2, "red green blue")], "id int, text string")
    terms = spark.createDataFrame([("Tail",), ("tail",), ("red green blue tail",), ("tail",)], "term string")
    tagged = quality.tag_terms(docs, terms, "id")
    every = {(k, t) for k in (None, 1) for t in ("Tail", "tail", "red green blue tail")}
    got = list(map(tuple, tagged.collect()))
    assert len(got) == len(every) and set(got) == every
    # both uses of the runs ask for the same rows, so that one exchange serves both
    made = [n for n in tagged._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Filter" in n and "isnotnull(id" in n]
    assert not made


def test_as_of_join_reads_facts_once(spark, tmp_path):
    spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ '2020-01-02' AS at, 7 AS pay").write.parquet(f"{tmp_path}/facts")
    facts = spark.read.parquet(f"{tmp_path}/facts")
    dim = spark.sql("SELECT 1 AS k, TIMESTAMP_NTZ '2020-01-01' AS f, TIMESTAMP_NTZ '2020-01-03' AS t, 'x' AS v")
    for how in ("inner", "left"):
        out = history.scd_as_of_join(facts, dim, Scd("f", "t", None), ["k"], "at", how)
        plan = out._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        assert plan.count("FileScan") == 1
        assert [tuple(r) for r in out.select("pay", "v").collect()] == [(7, "x")]
