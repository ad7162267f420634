"""Query-log rows to log lines and back, tails and roll-ups."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.text import squeeze_and_cap
from tessera.functions.times import utc_micros
from tessera.schemas import CATALOG_TTL_SECONDS
from tessera.sources.checkpoints import checkpointed

# Longest SQL and failure detail in a capped log line, in characters.
SQL_CAP = 500
DETAIL_CAP = 240
# Why a catalog read failed.
REASONS = ("no_native_odbc", "connect_failed", "query_failed", "no_rows", "null_value", "timeout")

_LINE = (
    r"^(\S+) (\d+)ms dsn=(.*?)(?: src=(.*?))? "
    r"(?:ok rows=(\d+)|fail (\S+) (.*?)) sql=(.*)$"
)
_MARK = "\ue008"
_MARKED = _MARK.join(f"${i}" for i in range(1, 9))


def make_events(
    df: DataFrame, elapsed_seconds: Column, failure_reason: Column, failure_detail: Column,
    row_count: Column,
) -> DataFrame:
    """Add ``ok, duration_ms, row_count, reason, detail`` from a finished read."""
    ok = failure_reason.isNull()
    return df.withColumns(
        {
            "ok": ok,
            "duration_ms": (elapsed_seconds * 1000).cast("long"),
            "row_count": F.when(ok, F.coalesce(row_count.cast("long"), F.lit(1))),
            "reason": failure_reason,
            "detail": F.when(~ok, failure_detail),
        }
    )


def utc_text(ts: Column, pattern: str = "yyyy-MM-dd HH:mm:ss") -> Column:
    """A timestamp as UTC wall-clock text, whatever the session time zone."""
    return F.date_format(F.to_utc_timestamp(ts, F.current_timezone()), pattern)


def iso_utc(ts: Column) -> Column:
    """``2024-01-31T10:20:30.123456Z``; no fraction when it is zero."""
    micros = utc_text(ts, "SSSSSS")
    fraction = F.when(micros == "000000", "").otherwise(F.concat(F.lit("."), micros))
    return F.concat(utc_text(ts, "yyyy-MM-dd'T'HH:mm:ss"), fraction, F.lit("Z"))


def format_event(sql_cap: int | None = None, detail_cap: int | None = None) -> Column:
    """One line per event from columns ``ts, duration_ms, dsn, source, ok, row_count,
    reason, detail, sql``; ``ts`` is text.  SQL and detail are whole unless caps are given."""
    sql = squeeze_and_cap(F.col("sql"), sql_cap)
    head = F.concat_ws(
        " ",
        F.col("ts"),
        F.concat(F.coalesce(F.col("duration_ms"), F.lit(0)).cast("string"), F.lit("ms")),
        F.concat(F.lit("dsn="), F.coalesce("dsn", F.lit(""))),
        F.concat(F.lit("src="), F.nullif("source", F.lit(""))),
    )
    good = F.concat(
        F.lit(" ok rows="), F.coalesce(F.col("row_count"), F.lit(1)).cast("string")
    )
    bad = F.concat(
        F.lit(" fail "),
        F.coalesce("reason", F.lit("unknown")),
        F.lit(" "),
        squeeze_and_cap(F.col("detail"), detail_cap),
    )
    return F.concat(head, F.when(F.col("ok"), good).otherwise(bad), F.lit(" sql="), sql)


def parse_line(line: Column) -> Column:
    """Fields of a log line as an array of one struct; empty when it is no log line.

    The pattern runs once per line: its groups come back as one marked text.  An array
    is exploded by the caller, which keeps the optimizer from repeating the match in
    a filter and in every field.
    """
    groups = F.split(F.regexp_replace(line, _LINE, _MARKED), _MARK)

    def fields(g: Column) -> Column:
        ok = F.element_at(g, 6) == ""

        def text(i: int) -> Column:
            return F.element_at(g, i)

        return F.struct(
            text(1).alias("ts"),
            text(2).cast("long").alias("duration_ms"),
            text(3).alias("dsn"),
            F.nullif(text(4), F.lit("")).alias("source"),
            ok.alias("ok"),
            F.when(ok, text(5).cast("long")).alias("row_count"),
            F.when(~ok, text(6)).alias("reason"),
            F.when(~ok, text(7)).alias("detail"),
            text(8).alias("sql"),
        )

    return F.transform(F.filter(F.array(groups), lambda g: F.size(g) == 8), fields)


def parse_log(lines: DataFrame, column: str = "line") -> DataFrame:
    """Rows of the readable lines, batch or stream; ``event_time`` is the timestamp."""
    parsed = lines.select(F.explode(parse_line(F.col(column))).alias("_e"))
    return parsed.select("_e.*").withColumn("event_time", F.col("ts").cast("timestamp"))


def tail_bytes(
    lines: DataFrame, max_bytes: int, keys: Sequence[str], order: Sequence[str],
    line: str = "line", salts: int | None = None,
) -> DataFrame:
    """Last whole lines per key whose UTF-8 size, newlines included, is within ``max_bytes``.

    Two steps, so that one busy source is no single sort: within each salt bucket of
    a key only the newest lines up to the first one past the limit can matter; those
    few are summed again over the whole key.  Keeping that first line past the limit
    makes the second sum exact.  ``order`` must be unique per key.
    """
    if salts is None:
        salts = int(lines.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    newest = [F.col(c).desc() for c in order]
    sized = lines.withColumns(
        {
            "_bytes": (F.octet_length(F.col(line)) + 1).cast("long"),
            "_salt": F.pmod(F.xxhash64(*order), F.lit(salts)).cast("int"),
        }
    )
    so_far = (Window.unboundedPreceding, Window.currentRow)
    part = Window.partitionBy(*keys, "_salt").orderBy(*newest).rowsBetween(*so_far)
    near = sized.withColumn("_sum", F.sum("_bytes").over(part)).where(
        F.col("_sum") - F.col("_bytes") <= max_bytes
    )
    whole = Window.partitionBy(*keys).orderBy(*newest).rowsBetween(*so_far)
    return (
        near.withColumn("bytes_from_end", F.sum("_bytes").over(whole))
        .where(F.col("bytes_from_end") <= max_bytes)
        .drop("_bytes", "_salt", "_sum")
    )


#: Cut-offs of at most this number of keys go to every task; more are joined by key.
_BROADCAST_KEYS = 100_000


def tail_by_histogram(
    lines: DataFrame, max_bytes: int, keys: Sequence[str], order: Sequence[str], period: str, line: str = "line"
) -> DataFrame:
    """As ``tail_bytes``, for logs whose rows have a ``period`` that never falls along ``order``, such as
    the hour or the day they are stored by.

    Bytes are summed per key and period first, which combines within tasks; of that histogram the period
    in which a key's tail begins is found.  Only lines from there on are moved and sorted, and stored days
    before the first of these periods are not read again.  ``period`` must not be null.
    """
    size = (F.octet_length(F.col(line)) + 1).cast("long")
    histogram = lines.groupBy(*keys, period).agg(F.sum(size).alias("_bytes"))
    later = Window.partitionBy(*keys).orderBy(F.col(period).desc()).rowsBetween(Window.unboundedPreceding, -1)
    begun = histogram.withColumn("_later", F.coalesce(F.sum("_bytes").over(later), F.lit(0)))
    cuts = begun.where(F.col("_later") <= max_bytes).groupBy(*keys).agg(F.min(period).alias("_from"))
    cuts = checkpointed(cuts)
    n, first = cuts.agg(F.count("*"), F.min("_from")).first()
    same = reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_of_{k}")) for k in keys])
    near = cuts.select(*[F.col(k).alias(f"_of_{k}") for k in keys], "_from")
    met = lines.where(F.col(period) >= F.lit(first)).join(F.broadcast(near) if n <= _BROADCAST_KEYS else near, same)
    return tail_bytes(met.where(F.col(period) >= F.col("_from")).select(*lines.columns), max_bytes, keys, order, line)


def refetches(
    requests: DataFrame, fetches: DataFrame, keys: Sequence[str], ts: str,
    ttl_seconds: int = CATALOG_TTL_SECONDS,
) -> DataFrame:
    """Requests with ``stale``: no fetch of the key in the TTL up to the request.

    With time cut into buckets as long as the TTL, two values per key and bucket
    decide: the first fetch of the request's own bucket and the last one of the
    bucket before.  Fetches are thus reduced before the join, which is on (key,
    bucket), so a busy key is spread over time; no request meets a list of fetches.
    ``requests`` may be a stream.  Times without a zone are UTC.
    """
    ttl = ttl_seconds * 1_000_000

    def placed(df: DataFrame) -> DataFrame:
        return df.withColumn("_at", utc_micros(df, ts)).withColumn(
            "_bucket", F.floor(F.col("_at") / F.lit(ttl)).cast("long")
        )

    seen = (
        placed(fetches)
        .groupBy(*keys, "_bucket")
        .agg(F.min("_at").alias("_first"), F.max("_at").alias("_last"))
    )
    # each reduced row answers for its own bucket and for the next one
    answers = (
        seen.withColumn("_later", F.explode(F.array(F.lit(0), F.lit(1))))
        .groupBy(*keys, (F.col("_bucket") + F.col("_later")).alias("_bucket"))
        .agg(
            F.min(F.when(F.col("_later") == 0, F.col("_first"))).alias("_first"),
            F.max(F.when(F.col("_later") == 1, F.col("_last"))).alias("_before"),
        )
    )
    fresh = (F.col("_first") <= F.col("_at")) | (F.col("_before") >= F.col("_at") - F.lit(ttl))
    return (
        placed(requests)
        .join(answers, [*keys, "_bucket"], "left")
        .withColumn("stale", ~F.coalesce(fresh, F.lit(False)))
        .select(*requests.columns, "stale")
    )


def failure_rollup(events: DataFrame, bucket: str = "1 hour") -> DataFrame:
    """Reads and failures per time bucket, source and reason ('' for successes).

    Also a streaming aggregation once the input carries a watermark on
    ``event_time``.
    """
    return (
        events.groupBy(
            F.window("event_time", bucket).alias("_w"),
            F.coalesce("source", F.lit("")).alias("source"),
            F.coalesce("reason", F.lit("")).alias("reason"),
        )
        .agg(F.count("*").alias("n"), F.sum("duration_ms").alias("total_ms"))
        .select(F.col("_w.start").alias("bucket_start"), "source", "reason", "n", "total_ms")
    )
