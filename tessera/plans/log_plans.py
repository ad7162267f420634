"""Query-log queries: every ``events`` row is one logged catalog read."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import querylog
from tessera.plans.registry import dealt, query, table, text
from tessera.sources.checkpoints import working_folder


def log_events(events: DataFrame) -> DataFrame:
    """Log events of ``events`` rows, batch or stream."""
    e = F.col("event_id")
    failed = F.col("event_type") == "error"
    reason = (
        F.when(e % 4 == 0, "connect_failed")
        .when(e % 4 == 1, "query_failed")
        .when(e % 4 == 2, "no_rows")
        .otherwise("null_value")
    )
    base = events.select(
        "event_id",
        "user_id",
        # times without a zone are UTC
        F.from_utc_timestamp(F.col("ts").cast("timestamp"), F.current_timezone()).alias("at"),
        F.concat(F.lit("wh"), (F.col("user_id") % 3).cast("string")).alias("dsn"),
        F.when(e % 5 != 0, F.col("event_type")).alias("source"),
        F.repeat(F.lit("select x,\n  "), (e % 100).cast("int")).alias("sql"),
        F.floor("value").alias("_seconds"),
        F.when(failed, reason).alias("_reason"),
        F.repeat(F.lit("no\tluck "), (e % 60).cast("int")).alias("_detail"),
    )
    made = querylog.make_events(
        base, F.col("_seconds"), F.col("_reason"), F.col("_detail"), F.when(e % 7 != 0, e % 100)
    )
    return made.withColumn("ts", querylog.iso_utc(F.col("at")))


def log_lines_of(
    spark: SparkSession, sf_dir: str, capped: bool = False, by: str | Column = "event_id"
) -> DataFrame:
    rows = table(spark, sf_dir, "events").select(
        "event_id", "user_id", "ts", "event_type", "value"
    )
    line = querylog.format_event()
    short = querylog.format_event(querylog.SQL_CAP, querylog.DETAIL_CAP)
    return log_events(dealt(rows, by)).select(
        "event_id", "dsn", line.alias("line"), *([short.alias("short_line")] if capped else [])
    )


LINES_SQL = """
WITH raw AS (
  SELECT event_id AS e, 'wh' || user_id % 3 AS dsn, event_type AS src, ts, event_type = 'error' AS bad,
         floor(value)::BIGINT * 1000 AS ms,
         trim(repeat('select x, ', (event_id % 100)::INT)) AS sql,
         trim(repeat('no luck ', (event_id % 60)::INT)) AS detail,
         CASE event_id % 4 WHEN 0 THEN 'connect_failed' WHEN 1 THEN 'query_failed' WHEN 2 THEN 'no_rows'
              ELSE 'null_value' END AS reason
  FROM events),
log AS (
  SELECT e AS event_id, dsn, src, bad, ms, reason, ts, sql, detail,
         CASE WHEN length(sql) > 500 THEN sql[1:499] || '…' ELSE sql END AS short_sql,
         CASE WHEN length(detail) > 240 THEN detail[1:239] || '…' ELSE detail END AS short_detail
  FROM raw),
heads AS (
  SELECT *, strftime(ts, '%Y-%m-%dT%H:%M:%S')
    || CASE WHEN epoch_us(ts) % 1000000 = 0 THEN '' ELSE '.' || lpad((epoch_us(ts) % 1000000)::VARCHAR, 6, '0') END
    || 'Z ' || ms || 'ms dsn=' || dsn || CASE WHEN event_id % 5 <> 0 THEN ' src=' || src ELSE '' END AS head,
    ' ok rows=' || CASE WHEN event_id % 7 <> 0 THEN event_id % 100 ELSE 1 END AS good
  FROM log),
lines AS (
  SELECT *, head || CASE WHEN bad THEN ' fail ' || reason || ' ' || detail ELSE good END || ' sql=' || sql AS line,
    head || CASE WHEN bad THEN ' fail ' || reason || ' ' || short_detail ELSE good END || ' sql=' || short_sql AS short_line
  FROM heads)"""


@query(LINES_SQL + " SELECT event_id, line, short_line FROM lines")
def log_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole lines, and lines with SQL and detail at the log's caps."""
    return log_lines_of(spark, sf_dir, capped=True).select("event_id", "line", "short_line")


@query(
    LINES_SQL
    + """
, t AS (SELECT event_id, dsn, line,
          sum(strlen(line) + 1) OVER (PARTITION BY dsn ORDER BY event_id DESC)::BIGINT AS bytes_from_end FROM lines)
SELECT * FROM t WHERE bytes_from_end <= 32768"""
)
def log_tail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return querylog.tail_bytes(log_lines_of(spark, sf_dir), 32 * 1024, ["dsn"], ["event_id"])


@query(
    LINES_SQL
    + """
, t AS (SELECT event_id, dsn, line,
          sum(strlen(line) + 1) OVER (PARTITION BY dsn ORDER BY event_id DESC)::BIGINT AS bytes_from_end FROM lines)
SELECT * FROM t WHERE bytes_from_end <= 32768"""
)
def log_tail_stored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same tail of a log stored by period, of which most is neither moved nor read twice."""
    folder = working_folder(spark, "log-by-period")
    period = F.floor(F.col("event_id") / 5_000)
    # a period's lines are made in one task, so there is one file per period, not one per period and task
    written = log_lines_of(spark, sf_dir, by=period).withColumn("period", period)
    written.write.partitionBy("period").parquet(folder)
    lines = spark.read.parquet(folder)
    found = querylog.tail_by_histogram(lines, 32 * 1024, ["dsn"], ["event_id"], "period")
    return found.drop("period")


@query(
    LINES_SQL
    + """
SELECT event_id, dsn, CASE WHEN event_id % 5 <> 0 THEN src ELSE '' END AS source, NOT bad AS ok,
       ms AS duration_ms, CASE WHEN bad THEN reason ELSE '' END AS reason,
       CASE WHEN bad THEN detail ELSE '' END AS detail, sql, ts::VARCHAR AS event_time
FROM lines"""
)
def log_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = log_lines_of(spark, sf_dir)
    rows = lines.select("event_id", F.explode(querylog.parse_line(F.col("line"))).alias("e"))
    return rows.select(
        "event_id", "e.dsn", text("e.source", "source"), "e.ok", "e.duration_ms",
        text("e.reason", "reason"), text("e.detail", "detail"), "e.sql",
        text(F.col("e.ts").cast("timestamp_ntz"), "event_time"),
    )


@query(
    LINES_SQL
    + """
SELECT strftime(date_trunc('hour', ts), '%Y-%m-%d %H:%M:%S') AS bucket_start,
       CASE WHEN event_id % 5 <> 0 THEN src ELSE '' END AS source,
       CASE WHEN bad THEN reason ELSE '' END AS reason, count(*) AS n, sum(ms)::BIGINT AS total_ms
FROM lines GROUP BY 1, 2, 3"""
)
def log_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    parsed = querylog.parse_log(log_lines_of(spark, sf_dir))
    return querylog.failure_rollup(parsed).withColumn(
        "bucket_start", querylog.utc_text(F.col("bucket_start"))
    )


@query(
    """
SELECT r.event_id, NOT EXISTS (SELECT 1 FROM events f WHERE f.event_type = 'purchase' AND f.user_id = r.user_id
         AND f.ts <= r.ts AND f.ts >= r.ts - INTERVAL 86400 SECOND) AS stale
FROM events r WHERE r.event_type <> 'purchase'"""
)
def ttl_misses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchases count as fetches of the user, valid for a day."""
    events = table(spark, sf_dir, "events").select("event_id", "user_id", "ts", "event_type")
    fetched = F.col("event_type") == "purchase"
    out = querylog.refetches(
        events.where(~fetched), events.where(fetched), ["user_id"], "ts", 86_400
    )
    return out.select("event_id", "stale")
