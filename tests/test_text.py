"""Text helpers."""

from pyspark.sql import functions as F

from tessera.functions.text import WHITESPACE, strip


def test_only_white_space_at_an_end_is_searched_for(spark):
    texts = [None, "", " ", "a", " a", "a\n", " a b\x85", "a \n b", "\x1c\U0001f600 ", "\U0001f600", "a\r\n", "\n  "]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.regexp_replace("t", f"^{WHITESPACE}+|{WHITESPACE}+$", "")
    got = rows.select("t", plain.alias("want"), strip(F.col("t")).alias("got")).collect()
    assert [r["got"] for r in got] == [r["want"] for r in got]
    # the search throughout a text stands behind a test of its ends
    searched = rows.select(strip(F.col("t")).alias("s"))._jdf.queryExecution().optimizedPlan().toString()
    assert searched.index("CASE WHEN") < searched.index("regexp_replace")
