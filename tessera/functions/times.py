"""Times as numbers that no session time zone changes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def utc_micros(df: DataFrame, at: Column | str) -> Column:
    """Microseconds since 1970 of a time of ``df``; times without a zone, dates and texts are UTC."""
    at = F.col(at) if isinstance(at, str) else at
    kind = df.select(at.alias("at")).schema["at"].dataType
    if isinstance(kind, T.TimestampType):
        return F.unix_micros(at)
    local = at.cast("timestamp_ntz")
    seconds = F.unix_date(local.cast("date")).cast("long") * 86_400 + F.hour(local) * 3_600 + F.minute(local) * 60
    return seconds * 1_000_000 + (F.date_part(F.lit("SECOND"), local) * 1_000_000).cast("long")
