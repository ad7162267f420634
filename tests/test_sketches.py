"""Sketched profiles: parts, merging, bounds."""

from pyspark.sql import functions as F

from tessera.operators import quality, sketches


def rows(spark, n=60_000):
    return spark.range(n, numPartitions=4).select(
        (F.col("id") % 9_973).alias("a"), F.col("id").cast("string").alias("s"),
        F.when(F.col("id") % 4 > 0, F.pow("id", F.lit(2)).cast("double")).alias("d"), (F.col("id") % 7).alias("part"),
    )


COLUMNS = ["a", "s", "d"]


def test_exact_values_lie_inside_the_bounds(spark):
    df = rows(spark)
    read = sketches.estimates(sketches.merge_profiles(sketches.sketch_profile(df, COLUMNS, ["part"])))
    exact = {r.column_name: r for r in quality.profile(df, COLUMNS).collect()}
    got = {r.column_name: r for r in read.collect()}
    for c in COLUMNS:
        assert (got[c].n_rows, got[c].n_null) == (exact[c].n_rows, exact[c].n_null)
        assert got[c].n_distinct_low <= exact[c].n_distinct <= got[c].n_distinct_high
    assert got["s"].q50 is None and got["s"].rank_error is None
    # the sketch is an estimate: its bounds are no wider than stated
    assert got["s"].n_distinct_high <= 60_000 and got["s"].n_distinct_low > 60_000 * 0.85
    held = sketches.ranks(df, read, ["a", "d"]).collect()
    assert len(held) == 6 and all(r.within for r in held)


def test_merged_parts_equal_one_part(spark):
    df = rows(spark)
    parts = sketches.sketch_profile(df, COLUMNS, ["part"])
    at_once = sketches.merge_profiles(parts)
    # in two steps, through a coarser part
    half = sketches.merge_profiles(parts.withColumn("half", F.col("part") % 2), ["half"])
    keep = ("column_name", "n_rows", "n_null", "n_distinct", "n_distinct_low", "n_distinct_high")
    one = sorted(map(tuple, sketches.estimates(at_once).select(*keep).collect()))
    assert one == sorted(map(tuple, sketches.estimates(sketches.merge_profiles(half)).select(*keep).collect()))
    # registers do not depend on how rows were split; a sketch that was never merged may read otherwise
    whole = sketches.sketch_profile(df, COLUMNS)
    assert {(r.column_name, r.n_rows) for r in whole.collect()} == {(c, 60_000) for c in COLUMNS}
    for a, b in zip(one, sorted(map(tuple, sketches.estimates(whole).select(*keep).collect())), strict=True):
        assert abs(a[3] - b[3]) <= 2 * sketches.DEVIATIONS * sketches.DISTINCT_ERROR * b[3]


def test_nulls_nan_few_values_and_empty_tables(spark):
    df = spark.createDataFrame([(None, 1.0), (None, float("nan")), (None, None)], "x int, y double")
    got = {r.column_name: r for r in sketches.estimates(sketches.merge_profiles(sketches.sketch_profile(df, ["x", "y"]))).collect()}
    assert (got["x"].n_null, got["x"].n_distinct, got["x"].q50) == (3, 0, None)
    assert (got["y"].n_null, got["y"].n_distinct, got["y"].q50) == (1, 2, 1.0)
    few = spark.range(50).select((F.col("id") % 5).alias("v"))
    r = sketches.estimates(sketches.merge_profiles(sketches.sketch_profile(few, ["v"]))).first()
    assert r.n_distinct == 5 and r.q50 == 2.0
    assert sketches.sketch_profile(df.limit(0), ["x"], ["y"]).count() == 0
    empty = sketches.estimates(sketches.merge_profiles(sketches.sketch_profile(df.limit(0), ["x", "y"]))).collect()
    assert [(r.n_rows, r.n_distinct, r.q50) for r in empty] == [(0, 0, None)] * 2


def test_values_do_not_move(spark):
    plan = sketches.sketch_profile(rows(spark), COLUMNS, ["part"])._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "partial_hll_sketch_agg" in plan and "Expand" not in plan
