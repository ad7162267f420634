import pytest
from pyspark.sql import functions as F

from tessera.operators import changes as ops
from tessera.operators import querylog
from tessera.plans import registry, stream_plans
from tessera.sources import snapshots
from tessera.sources.buckets import Buckets
from tessera.streaming import changes, logs


def test_log_stream(spark, tmp_path):
    events = spark.range(200).select(
        F.concat(F.lit("2024-01-01T0"), (F.col("id") % 5).cast("string"), F.lit(":10:00Z")).alias("ts"),
        F.col("id").alias("duration_ms"),
        F.lit("d").alias("dsn"),
        F.lit("src").alias("source"),
        (F.col("id") % 4 != 0).alias("ok"),
        F.lit(1).alias("row_count"),
        F.lit("no_rows").alias("reason"),
        F.lit("d").alias("detail"),
        F.lit("select 1").alias("sql"),
    )
    lines = events.select(querylog.format_event().alias("line"), F.lit("2024-01-01").alias("day"))
    snapshots.write_log(lines, str(tmp_path / "log"))
    stream = logs.read_log_stream(spark, str(tmp_path / "log" / "day=2024-01-01"))
    done = (
        logs.failure_counts(stream)
        .writeStream.format("memory").queryName("counts").outputMode("append")
        .option("checkpointLocation", str(tmp_path / "ck"))
        .trigger(availableNow=True).start()
    )
    done.awaitTermination()
    got = spark.table("counts")
    # hours 0 and 1 are final: the watermark is two hours behind 04:10
    hours = {r[0].hour for r in got.select("bucket_start").distinct().collect()}
    assert hours == {0, 1}
    batch = querylog.failure_rollup(querylog.parse_log(lines)).where("hour(bucket_start) < 2")
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, batch.collect()))


def test_change_stream_equals_one_batch(spark, tmp_path):
    shape = "project_id string, seq long, term string, definition string"
    for i in range(3):
        rows = [("p", 10 * i + j, f"t{(i + j) % 4}", f"v{i}{j}") for j in range(3)]
        spark.createDataFrame(rows, shape).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
    initial = spark.createDataFrame(
        [("p", 0, "t1", "old", False)],
        "project_id string, pos long, term string, definition string, appended boolean",
    )
    seen = []
    state_root, out_root = str(tmp_path / "state"), str(tmp_path / "out")
    changes.begin(initial, state_root)
    stream = (
        spark.readStream.schema(shape).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "in"))
    )
    changes.start(
        stream, ops.upsert_glossary, state_root, out_root, str(tmp_path / "ck"), seen.append
    ).awaitTermination()
    assert seen == [0, 1, 2]
    whole, _ = ops.upsert_glossary(initial, spark.read.schema(shape).parquet(str(tmp_path / "in")))

    def listed(df):
        return [
            (r.term, r.definition, r.appended) for r in df.orderBy(*ops.ORDER).collect()
        ]

    assert listed(snapshots.read_snapshot(spark, state_root, 2)) == listed(whole)
    outcomes = [snapshots.read_snapshot(spark, out_root, v).count() for v in seen]
    assert outcomes == [3, 3, 3]


SHAPE = "project_id string, seq long, term string, definition string"
STATE = "project_id string, pos long, term string, definition string, appended boolean"


def listed(df):
    return [(r.term, r.definition, r.appended) for r in df.orderBy(*ops.ORDER).collect()]


def fold(spark, tmp_path, state, batches):
    """Each batch in a run of its own."""
    for rows in batches:
        spark.createDataFrame(rows, SHAPE).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        changes.start_bucketed(
            spark.readStream.schema(SHAPE).parquet(str(tmp_path / "in")),
            ops.upsert_glossary, state, str(tmp_path / "out"), str(tmp_path / "ck"),
        ).awaitTermination()


def test_buckets_equal_one_batch(spark, tmp_path):
    initial = spark.createDataFrame([("p", i, f"t{i}", "old " * 50, False) for i in range(400)], STATE)
    batches = [[("p", 10 * n + j, f" t{7 * n + j * 150} ", f"v{n}{j}") for j in range(4)] for n in range(5)]
    batches.insert(3, batches[2])
    state = Buckets(str(tmp_path / "state"), [F.col("project_id"), F.trim("term")], count=16)
    state.begin(initial)
    whole = sum(e.n_bytes for e in state.manifest(spark, -1).values())
    fold(spark, tmp_path, state, batches)
    together = spark.createDataFrame([r for rows in batches[:3] + batches[4:] for r in rows], SHAPE)
    expected, _ = ops.upsert_glossary(initial, together)
    assert listed(state.read(spark, 5)) == listed(expected)
    for version in (4, 5):
        entries = state.manifest(spark, version)
        rewritten = [e for e in entries.values() if e.version == version]
        assert 0 < len(rewritten) <= 4 and sum(e.n_bytes for e in rewritten) < whole / 2
        assert sum(e.n_rows for e in entries.values()) == state.read(spark, version).count()
    # two versions are kept, and no file that neither of them names
    assert sorted(p.name for p in (tmp_path / "state/manifest").iterdir()) == ["version=4", "version=5"]
    there = {(int(b.name[8:]), int(v.name[8:])) for v in (tmp_path / "state/data").iterdir() for b in v.glob("_b*")}
    assert there == {(b, e.version) for v in (4, 5) for b, e in state.manifest(spark, v).items()}


def test_a_batch_run_again_takes_effect_once(spark, tmp_path):
    state = Buckets(str(tmp_path / "state"), [F.col("project_id"), F.trim("term")], count=4)
    state.begin(spark.createDataFrame([], STATE))
    rows = [[("p", 1, "a", "x"), ("p", 2, None, "y")], [("p", 3, "b", "x")], [("p", 4, "a", "z"), ("p", 5, "c", "w")]]
    fold(spark, tmp_path, state, rows)
    before = listed(state.read(spark, 2))
    assert before == [("a", "z", True), ("b", "x", True), ("c", "w", True)]
    for name in ("2", ".2.crc"):
        (tmp_path / "ck/commits" / name).unlink()
    changes.start_bucketed(
        spark.readStream.schema(SHAPE).parquet(str(tmp_path / "in")),
        ops.upsert_glossary, state, str(tmp_path / "out"), str(tmp_path / "ck"),
    ).awaitTermination()
    assert listed(state.read(spark, 2)) == before
    outcomes = snapshots.read_snapshot(spark, str(tmp_path / "out"), 2)
    assert sorted(r.outcome for r in outcomes.collect()) == ["added", "updated"]


def test_another_number_of_buckets_is_refused(spark, tmp_path):
    keys = [F.col("project_id")]
    Buckets(str(tmp_path), keys, count=4).begin(spark.createDataFrame([("p", 0, "t", "d", False)], STATE))
    with pytest.raises(ValueError, match="number of buckets"):
        Buckets(str(tmp_path), keys, count=5).read(spark, -1)


def test_the_glossary_stream_reads_a_table_of_several_files(spark, tmp_path):
    given = "/root/testdata/sf0.001"
    for name in ("benchmark", "conversations"):
        rows = registry.table(spark, given, name)
        rows.repartition(3).write.parquet(str(tmp_path / f"{name}.parquet"))

    def found(folder):
        return sorted(map(tuple, stream_plans.upsert_glossary_stream(spark, folder).collect()))

    assert found(str(tmp_path)) == found(given)
