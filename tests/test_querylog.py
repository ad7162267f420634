import datetime as dt

from pyspark.sql import functions as F

from tessera.operators import querylog
from tessera.plans import log_plans

EVENT = (
    "ts string, duration_ms long, dsn string, source string, ok boolean, row_count long,"
    " reason string, detail string, sql string"
)


def line_of(spark, *event, caps=()):
    line = querylog.format_event(*caps)
    return spark.createDataFrame([event], EVENT).select(line.alias("l")).first().l


def test_lines(spark):
    assert line_of(spark, "T", 12, "wh", "s", True, 3, None, None, " select\n  1\t") == (
        "T 12ms dsn=wh src=s ok rows=3 sql=select 1"
    )
    assert line_of(spark, "T", None, None, None, True, None, None, None, None) == (
        "T 0ms dsn= ok rows=1 sql="
    )
    assert line_of(spark, "T", 1, "d", "", False, None, None, "a\nb", "x") == (
        "T 1ms dsn=d fail unknown a b sql=x"
    )


def test_caps_count_characters_where_they_are_asked_for(spark):
    caps = (querylog.SQL_CAP, querylog.DETAIL_CAP)
    long = line_of(spark, "T", 1, "d", None, True, 1, None, None, "é" * 501, caps=caps)
    assert long.split("sql=")[1] == "é" * 499 + "…"
    whole = line_of(spark, "T", 1, "d", None, False, 1, "r", "y" * 241, "é" * 501)
    assert whole == f"T 1ms dsn=d fail r {'y' * 241} sql={'é' * 501}"
    fits = line_of(spark, "T", 1, "d", None, False, 1, "r", "y" * 240, "é" * 500, caps=caps)
    assert fits == f"T 1ms dsn=d fail r {'y' * 240} sql={'é' * 500}"


def test_parse_is_the_inverse(spark):
    events = [
        ("T", 12, "a b", "list x", True, 3, None, None, "select 1"),
        ("T", 0, "", None, False, None, "timeout", "took = too ok rows=1 long", "select sql=2"),
        ("T", 5, "d", None, False, None, "no_rows", "", ""),
    ]
    df = spark.createDataFrame(events, EVENT).select(querylog.format_event().alias("line"))
    got = df.select(F.explode(querylog.parse_line(F.col("line"))).alias("e")).select("e.*").collect()
    assert [tuple(r) for r in got][0] == events[0]
    assert [tuple(r) for r in got][2] == events[2]
    assert got[1].reason == "timeout" and got[1].ok is False
    junk = spark.createDataFrame([("junk",), ("",), (None,)], "line string")
    assert querylog.parse_log(junk).count() == 0


def brute_tail(rows, limit):
    total, kept = 0, []
    for seq, line in sorted(rows, reverse=True):
        total += len(line.encode()) + 1
        if total > limit:
            break
        kept.append(seq)
    return set(kept)


def test_tail_is_exact_for_any_salting(spark):
    rows = [(i, "x" * ((i * 37) % 90) + ("é" if i % 3 else "")) for i in range(400)]
    rows[398] = (398, "y" * 500)
    df = spark.createDataFrame([("k", *r) for r in rows], "key string, seq long, line string")
    for limit in (0, 10, 300, 700, 5_000, 10**6):
        expected = brute_tail(rows, limit)
        for salts in (1, 7):
            got = querylog.tail_bytes(df, limit, ["key"], ["seq"], salts=salts)
            assert {r.seq for r in got.collect()} == expected, (limit, salts)


def test_refetches_against_brute_force(spark):
    start = dt.datetime(2024, 1, 1)
    at = [start + dt.timedelta(seconds=(i * 7919) % 5000, microseconds=i) for i in range(300)]
    fetches = [(f"k{i % 2}", t) for i, t in enumerate(at) if i % 11 == 0]
    fetches.append(("k0", start))
    asked = [(i, f"k{i % 2}", t) for i, t in enumerate(at)]
    asked.append((1000, "k0", start + dt.timedelta(seconds=300)))
    asked.append((1001, "k9", start))
    ttl = dt.timedelta(seconds=300)
    expected = {
        i: not any(k == fk and t - ttl <= ft <= t for fk, ft in fetches) for i, k, t in asked
    }
    out = querylog.refetches(
        spark.createDataFrame(asked, "i int, key string, ts timestamp"),
        spark.createDataFrame(fetches, "key string, ts timestamp"),
        ["key"],
        "ts",
    )
    assert {r.i: r.stale for r in out.collect()} == expected


def test_tail_by_histogram_moves_only_what_may_be_in_the_tail(spark, tmp_path):
    rows = [(k, f"s{k % 3}" if k % 7 else None, "é" * (k % 13), k // 50) for k in range(2000)]
    frame = spark.createDataFrame(rows, "at long, source string, line string, day long")
    frame.write.partitionBy("day").parquet(f"{tmp_path}/log")
    stored = spark.read.parquet(f"{tmp_path}/log").select("at", "source", "line", "day")
    for limit in (0, 1, 300, 5_000, 10**9):
        plain = querylog.tail_bytes(frame, limit, ["source"], ["at"])
        cut = querylog.tail_by_histogram(stored, limit, ["source"], ["at"], "day")
        assert cut.columns == plain.columns
        assert sorted(map(str, cut.collect())) == sorted(map(str, plain.select(*cut.columns).collect()))
    plan = querylog.tail_by_histogram(stored, 300, ["source"], ["at"], "day")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(day" in plan and "BroadcastHashJoin" in plan
    assert querylog.tail_by_histogram(stored.limit(0), 10, ["source"], ["at"], "day").count() == 0


def test_a_stored_period_is_one_file(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(log_plans, "working_folder", lambda _, name: str(tmp_path / name))
    assert log_plans.log_tail_stored(spark, "/root/testdata/sf0.1").count() > 0
    periods = list((tmp_path / "log-by-period").glob("period=*"))
    assert len(periods) >= 20 and all(len(list(p.glob("*.parquet"))) == 1 for p in periods)
