"""Profiles as sketches: made per part of a table, stored, merged, and read with their bounds."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Logarithm of an HLL sketch's cells, and the size parameter of a quantile sketch.
LG_CELLS, K = 12, 400
#: Bounds are so many standard deviations wide.
DEVIATIONS = 4
#: Relative standard error of an HLL sketch that was merged.
DISTINCT_ERROR = 1.04 / (1 << LG_CELLS) ** 0.5
#: Standard error of a rank in a quantile sketch; the published bound is for 99 %, 2.576 deviations.
RANK_ERROR = 2.296 / K**0.9723 / 2.576


def numeric(df: DataFrame, columns: Sequence[str]) -> list[str]:
    return [c for c in columns if isinstance(df.schema[c].dataType, T.NumericType)]


def sketch_profile(df: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """One row per part (the columns ``by``) and column: rows, nulls and two sketches of fixed size.

    ``distinct`` takes the values' text form, as the exact profile does; ``quantiles`` is null for columns
    that are no numbers and leaves out nulls and NaN.  A table without rows has no parts, and one
    row per column where there is no ``by``.
    """
    numbers = numeric(df, columns)
    parts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count(F.lit(1)).alias("n_rows"),
            F.count_if(F.col(c).isNull()).alias("n_null"),
            F.hll_sketch_agg(F.col(c).cast("string"), LG_CELLS).alias("distinct"),
            (F.kll_sketch_agg_double(F.col(c).cast("double"), K) if c in numbers else F.lit(None).cast("binary")).alias(
                "quantiles"
            ),
        )
        for c in columns
    ]
    return df.groupBy(*by).agg(F.array(*parts).alias("_p")).select(*by, F.inline("_p"))


def merge_profiles(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Parts added up per column and ``by``: sketches again, which may be merged further."""
    return parts.groupBy(*by, "column_name").agg(
        F.sum("n_rows").alias("n_rows"),
        F.sum("n_null").alias("n_null"),
        F.hll_union_agg("distinct").alias("distinct"),
        F.kll_merge_agg_double("quantiles", K).alias("quantiles"),
    )


def _quantile(q: float) -> Column:
    some = F.kll_sketch_get_n_double("quantiles") > 0
    return F.when(some, F.kll_sketch_get_quantile_double("quantiles", F.lit(q)))


def estimates(merged: DataFrame) -> DataFrame:
    """Sketches read: distinct values between two bounds, quartiles and how far their ranks may be off.

    Bounds are four standard deviations wide; a few values are counted exactly.  Quartiles and ``rank_error``
    are null for columns that are no numbers or hold none.
    """
    found = F.hll_sketch_estimate("distinct")
    wide = DEVIATIONS * DISTINCT_ERROR
    quartiles = {"q25": _quantile(0.25), "q50": _quantile(0.5), "q75": _quantile(0.75)}
    return (
        merged.withColumn("n_distinct", found)
        .withColumn("n_distinct_low", F.floor(F.col("n_distinct") / (1 + wide)))
        .withColumn("n_distinct_high", F.least(F.ceil(F.col("n_distinct") / (1 - wide)), F.col("n_rows") - F.col("n_null")))
        .withColumns(quartiles)
        .withColumn("rank_error", F.when(F.col("q50").isNotNull(), F.lit(DEVIATIONS * RANK_ERROR)))
        .drop("distinct", "quantiles")
    )


def ranks(df: DataFrame, read: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact shares of a column's values below and up to each estimated quartile, to hold estimates to their bound.

    ``read`` has one row per column, so it goes to all tasks; values are counted where they are.
    """
    values = F.explode(
        F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(c).cast("double").alias("value")) for c in columns])
    )
    marks = F.explode(
        F.array(*[F.struct(F.lit(q).alias("wanted"), F.col(f"q{int(q * 100)}").alias("mark")) for q in (0.25, 0.5, 0.75)])
    )
    marked = read.where(F.col("q50").isNotNull()).select("column_name", "rank_error", marks.alias("_m"))
    rows = df.select(values.alias("_v")).select("_v.*").where(F.col("value").isNotNull() & ~F.isnan("value"))
    return (
        rows.join(F.broadcast(marked.select("column_name", "rank_error", "_m.*")), "column_name")
        .groupBy("column_name", "wanted", "rank_error")
        .agg(
            (F.count_if(F.col("value") < F.col("mark")) / F.count(F.lit(1))).alias("share_below"),
            (F.count_if(F.col("value") <= F.col("mark")) / F.count(F.lit(1))).alias("share_up_to"),
        )
        .withColumn(
            "within",
            (F.col("share_below") <= F.col("wanted") + F.col("rank_error"))
            & (F.col("share_up_to") >= F.col("wanted") - F.col("rank_error")),
        )
    )
