"""First-wins and last-wins rules without windows.

A window over a key sorts the whole key in one task.  ``min_by`` / ``max_by`` are
combined on the map side instead: a key that owns a third of all rows arrives at
the reducer as one row per map task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _pick(df: DataFrame, keys: Sequence[str], order: Column, how) -> DataFrame:
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(how(F.struct(*rest), order).alias("_row")).select(*keys, "_row.*")


def first_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return _pick(df, keys, F.struct(*order), F.min_by)


def latest_per_key(df: DataFrame, keys: Sequence[str], *order: str) -> DataFrame:
    return _pick(df, keys, F.struct(*order), F.max_by)


def replicate(df: DataFrame, salts: int) -> DataFrame:
    """Each row once per salt: the small side of a salted join."""
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))


def salt(df: DataFrame, salts: int, *spread_by: str) -> DataFrame:
    """Rows of a hot key spread over ``salts`` buckets by a hash of other columns."""
    return df.withColumn("_salt", F.pmod(F.xxhash64(*spread_by), F.lit(salts)).cast("int"))


def salted_join(
    many: DataFrame, one: DataFrame, keys: Sequence[str], how: str, salts: int, spread_by: Sequence[str]
) -> DataFrame:
    """Join where a key of ``many`` may own a large share of its rows.

    ``how`` may be inner, left, left_semi or left_anti: each row of ``many`` meets
    the copy of ``one`` that carries its own salt, so results are those of the
    plain join.
    """
    joined = salt(many, salts, *spread_by).join(replicate(one, salts), [*keys, "_salt"], how)
    return joined.drop("_salt")
