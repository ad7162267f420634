"""The same tables read as streams, to the end of what is there."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import changes as operators
from tessera.functions.text import strip
from tessera.operators import querylog
from tessera.plans.change_plans import GLOSSARY_SQL, glossary_changes, glossary_state
from tessera.plans.log_plans import LINES_SQL, log_events
from tessera.plans.registry import query, table
from tessera.sources.buckets import Buckets
from tessera.sources.checkpoints import working_folder
from tessera.sources.snapshots import read_snapshot
from tessera.streaming import changes, logs

#: Batches that the conversations arrive in, by ranges of their number; the third comes twice.
ARRIVALS = (0, 1, 2, 2, 3, 4)


def _stream(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A given table as a stream, whether it is one file or a folder of files."""
    path = f"{sf_dir}/{name}.parquet"
    reader = spark.readStream.schema(table(spark, sf_dir, name).schema)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    if hadoop.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(hadoop).isDirectory():
        return reader.parquet(path)
    # a stream reads folders
    return reader.option("pathGlobFilter", f"{name}.parquet").parquet(sf_dir)


@query(
    LINES_SQL
    + """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket_start,
       CASE WHEN event_id % 5 <> 0 THEN src ELSE '' END AS source,
       CASE WHEN bad THEN reason ELSE '' END AS reason, count(*) AS n, sum(ms)::BIGINT AS total_ms
FROM lines
WHERE date_trunc('hour', ts) + INTERVAL 1 HOUR <= (SELECT max(ts) FROM lines) - INTERVAL 2 HOUR
GROUP BY 1, 2, 3"""
)
def log_rollup_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hours that are final under a watermark of two hours."""
    events = log_events(_stream(spark, sf_dir, "events"))
    parsed = querylog.parse_log(events.select(querylog.format_event().alias("line")))
    folder = working_folder(spark, "log-rollup")
    running = (
        logs.failure_counts(parsed)
        .writeStream.format("parquet")
        .option("path", f"{folder}/out")
        .option("checkpointLocation", f"{folder}/checkpoint")
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )
    running.awaitTermination()
    return spark.read.parquet(f"{folder}/out").withColumn(
        "bucket_start", querylog.utc_text(F.col("bucket_start"))
    )


@query(GLOSSARY_SQL)
def upsert_glossary_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The glossary after the last batch of a change stream."""
    folder = working_folder(spark, "glossary")
    changes.begin(operators.as_state(glossary_state(spark, sf_dir)), f"{folder}/state")
    versions = [-1]
    changes.start(
        glossary_changes(_stream(spark, sf_dir, "conversations")),
        operators.upsert_glossary,
        f"{folder}/state",
        f"{folder}/outcomes",
        f"{folder}/checkpoint",
        versions.append,
    ).awaitTermination()
    state = read_snapshot(spark, f"{folder}/state", versions[-1])
    return state.select("term", "appended", F.md5("definition").alias("definition"))


def _glossary_in_batches(spark: SparkSession, sf_dir: str) -> tuple[Buckets, str]:
    """A bucketed glossary after all of ``ARRIVALS``, each a run of its own that goes on from the last."""
    folder = working_folder(spark, "glossary-batches")
    conversations = table(spark, sf_dir, "conversations")
    low, high = conversations.agg(F.min("conv_id"), F.max("conv_id")).first()
    parts = max(ARRIVALS) + 1
    part = F.floor((F.col("conv_id") - F.lit(low)) * parts / F.lit((high or 0) - (low or 0) + 1))
    state = Buckets(f"{folder}/state", [F.col("project_id"), strip(F.col("term"))], count=16)
    state.begin(operators.as_state(glossary_state(spark, sf_dir)))
    for number in ARRIVALS:
        conversations.where(part == number).write.mode("append").parquet(f"{folder}/arrived")
        arrived = spark.readStream.schema(conversations.schema).parquet(f"{folder}/arrived")
        changes.start_bucketed(
            glossary_changes(arrived),
            operators.upsert_glossary,
            state,
            f"{folder}/outcomes",
            f"{folder}/checkpoint",
        ).awaitTermination()
    return state, f"{folder}/outcomes"


@query(GLOSSARY_SQL)
def upsert_glossary_batches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The glossary after six batches into buckets, one of them delivered twice."""
    state, _ = _glossary_in_batches(spark, sf_dir)
    rows = state.read(spark, len(ARRIVALS) - 1)
    return rows.select("term", "appended", F.md5("definition").alias("definition"))


@query(
    """
WITH ch AS (
  SELECT conv_id * 1000 + turn AS seq, 'term ' || conv_id % 60 AS term,
         regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS definition,
         floor((conv_id - min(conv_id) OVER ()) * 5 / (max(conv_id) OVER () - min(conv_id) OVER () + 1)) AS part
  FROM conversations),
arrived AS (
  SELECT a.batch, ch.*, definition IS NULL OR definition = '' OR length(definition) > 1000 AS bad
  FROM ch JOIN (VALUES (0, 0), (1, 1), (2, 2), (3, 2), (4, 3), (5, 4)) a(batch, part) USING (part)),
placed AS (
  SELECT *, NOT bad AND term NOT IN (SELECT 'term ' || item_id FROM benchmark)
         AND row_number() OVER (PARTITION BY term, bad ORDER BY batch, seq) = 1 AS fresh
  FROM arrived)
SELECT batch::BIGINT AS batch,
       CASE WHEN bad THEN 'rejected' WHEN fresh THEN 'added' ELSE 'updated' END AS outcome, count(*) AS n
FROM placed GROUP BY 1, 2"""
)
def glossary_batch_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What became of the changes of each batch; a repeated batch only updates."""
    _, outcomes = _glossary_in_batches(spark, sf_dir)
    rows = spark.read.parquet(outcomes)
    return rows.groupBy(F.col("version").cast("long").alias("batch"), "outcome").agg(F.count(F.lit(1)).alias("n"))
