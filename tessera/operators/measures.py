"""Declared formulas evaluated over data: measures and computed columns."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.declared import ColumnHint, Measure

_WHERE = re.compile(r"^(?P<what>.+\))\s+where\s+(?P<which>.+)$", re.IGNORECASE | re.DOTALL)


def formula_expression(formula: str) -> Column:
    """Formula text as an aggregate; a trailing ``where`` becomes its filter."""
    found = _WHERE.match(formula.strip())
    if found:
        return F.expr(f"{found['what']} FILTER (WHERE {found['which']})")
    return F.expr(formula)


def evaluate_measures(
    df: DataFrame, measures: Sequence[Measure], by: Sequence[str] = (), grouping: str = "group"
) -> DataFrame:
    """Measures per group; ``grouping`` is group, rollup or cube.

    Under rollup and cube ``grouping_level`` tells which columns are totals.
    """
    aggregates = [formula_expression(m.formula).alias(m.name) for m in measures]
    if grouping == "group":
        return df.groupBy(*by).agg(*aggregates)
    grouped = df.rollup(*by) if grouping == "rollup" else df.cube(*by)
    return grouped.agg(F.grouping_id().cast("long").alias("grouping_level"), *aggregates)


def add_computed(df: DataFrame, hints: Sequence[ColumnHint]) -> DataFrame:
    """Columns that are a formula of others, as expressions of one projection."""
    return df.withColumns({h.name: F.expr(h.expression) for h in hints if h.expression})
