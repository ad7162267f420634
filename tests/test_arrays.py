"""Runs and running values against plain Python."""

import itertools

import pytest
from pyspark.sql import functions as F

from tessera.functions.arrays import BLOCK, runs, running


@pytest.mark.parametrize("n", [0, 1, 2, BLOCK - 1, BLOCK, BLOCK + 1, 3 * BLOCK + 7, 20_000])
def test_running(spark, n):
    values = [(i * 7919) % 1000 for i in range(n)]
    df = spark.createDataFrame([(values,)], "v array<long>")
    row = df.select(
        running(F.col("v"), lambda a, b: a + b).alias("sums"), running(F.col("v"), F.greatest).alias("tops")
    ).first()
    assert row.sums == list(itertools.accumulate(values))
    assert row.tops == list(itertools.accumulate(values, max))


def test_runs(spark):
    given = [[], [None], ["a"], [None, None, "a", "a", "b"], ["a", "b", "c"], ["x"] * 5_000]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(given)], "i int, v array<string>")
    got = {r.i: r.r for r in df.select("i", runs(F.col("v"), lambda x: x).alias("r")).collect()}
    assert got == {i: [list(g) for _, g in itertools.groupby(v)] for i, v in enumerate(given)}
