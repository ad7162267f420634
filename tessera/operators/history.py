"""Slowly changing tables: current rows, a point in time, and as-of joins.

Validity is half open, ``[valid_from, valid_to)``; a null end is open.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tessera.functions.times import utc_micros
from tessera.operators.declared import Scd


def scd_current(df: DataFrame, scd: Scd) -> DataFrame:
    """Rows flagged current, or without an end when there is no flag column."""
    if scd.is_current_flag:
        return df.where(F.col(scd.is_current_flag))
    return df.where(F.col(scd.valid_to).isNull())


def scd_as_of(df: DataFrame, scd: Scd, at: Column) -> DataFrame:
    """Versions valid at a time; all of them where several are."""
    here, start, until = (utc_micros(df, c) for c in (at, scd.valid_from, scd.valid_to))
    return df.where((start <= here) & (until.isNull() | (here < until)))


#: Open ends; far behind any time, and so that lengths do not overflow.
_NEVER = 2**61
#: A level's time nodes are so many times as wide as those of the level below; a node of the last holds all time.
_WIDER, _LAST = 16, 12


def scd_as_of_join(
    facts: DataFrame, dim: DataFrame, scd: Scd, keys: Sequence[str], at: str,
    how: str = "inner", bucket_seconds: int = 86_400,
) -> DataFrame:
    """Each fact with every version of its key that was valid at ``at``; inner or left.

    Where no version of a key is valid, a gap is; so all of a key's time is covered, whether its versions
    follow each other, overlap or leave gaps, and one equality join answers all.  A version or gap stands
    at the one or two time nodes of its length; a fact meets the node of its time on each level that its
    key has.  Work grows with facts, versions and results, and a hot key is split by time.
    """
    keys = list(keys)
    width = bucket_seconds * 1_000_000
    payload = [c for c in dim.columns if c not in keys]
    stood = _at_nodes(_covering(dim, scd, keys, payload, gaps=how != "inner"), width)
    levels = stood.groupBy(*keys).agg(F.collect_set("_level").alias("_levels"))
    asked = facts.select(
        *[F.when(_complete(keys, at), F.col(k)).alias(k) for k in keys],
        utc_micros(facts, at).alias("_t"),
        F.struct(*facts.columns).alias("_fact"),
    )
    if how == "inner":
        met = asked.join(levels, keys).withColumn("_level", F.explode("_levels"))
    else:
        met = asked.join(levels, keys, "left").withColumn("_level", F.explode_outer("_levels"))
    met = met.withColumn("_node", _node(F.col("_t"), F.col("_level"), width)).drop("_levels")
    meets = [*keys, "_level", "_node"]
    here = stood.select(*meets, "_s", "_e", "_row")
    hit = (F.col("_s") <= F.col("_t")) & (F.col("_t") < F.col("_e"))
    if how == "inner":
        matched = met.join(here, meets).where(hit)
    else:
        # a fact of an unknown key, or without a time, meets no node and has no version
        matched = met.join(here, meets, "left").where(F.col("_level").isNull() | hit)
    return matched.select("_fact.*", *[F.col(f"_row.{c}").alias(c) for c in payload])


def _covering(dim: DataFrame, scd: Scd, keys: list[str], payload: list[str], gaps: bool) -> DataFrame:
    """Versions as (_s, _e, _row), and for each key the gaps between them with _row null."""
    start, until = utc_micros(dim, scd.valid_from), utc_micros(dim, scd.valid_to)
    versions = (
        dim.where(_complete(keys, scd.valid_from))
        .select(*keys, start.alias("_s"), F.coalesce(until, F.lit(_NEVER)).alias("_e"), F.struct(*payload).alias("_row"))
        .where("_s < _e")
    )
    if not gaps:
        return versions
    by_start = Window.partitionBy(*keys).orderBy("_s", "_e")
    reached = F.max("_e").over(by_start.rowsBetween(Window.unboundedPreceding, Window.currentRow))
    follows = F.coalesce(F.lead("_s").over(by_start), F.lit(_NEVER))
    first = F.lag("_s").over(by_start).isNull()
    kind = versions.schema["_row"].dataType
    none = F.lit(None).cast(kind)
    span = lambda s, e, row: F.struct(s.alias("_s"), e.alias("_e"), row.alias("_row"))
    lined = versions.select(*keys, "_s", "_e", "_row", reached.alias("_reached"), follows.alias("_next"), first.alias("_first"))
    spans = F.array(
        span(F.col("_s"), F.col("_e"), F.col("_row")),
        F.when(F.col("_reached") < F.col("_next"), span(F.col("_reached"), F.col("_next"), none)),
        F.when(F.col("_first"), span(F.lit(-_NEVER), F.col("_s"), none)),
    )
    return lined.select(*keys, F.explode(F.array_compact(spans)).alias("_span")).select(*keys, "_span.*")


def _node(time: Column, level: Column, width: int) -> Column:
    """The time node of a level; those of the last level are one."""
    wide = F.floor(time / (width * F.pow(F.lit(float(_WIDER)), level))).cast("long")
    return F.when(level < _LAST, wide).otherwise(F.lit(0).cast("long"))


def _at_nodes(versions: DataFrame, width: int) -> DataFrame:
    """Versions at the one or two nodes that hold them, on the level of their length."""
    first = F.floor(F.col("_s") / width).cast("long")
    length = F.floor((F.col("_e") - 1) / width).cast("long") - first + 1
    unbounded = (F.col("_s") <= -_NEVER) | (F.col("_e") >= _NEVER)
    level = F.least(F.ceil(F.log(float(_WIDER), length.cast("double"))), F.lit(_LAST)).cast("int")
    placed = versions.withColumn("_level", F.when(unbounded, F.lit(_LAST)).otherwise(level))
    ends = [_node(t, F.col("_level"), width) for t in (F.col("_s"), F.col("_e") - 1)]
    return placed.withColumn("_node", F.explode(F.array_distinct(F.array(*ends))))


def _complete(keys: Sequence[str], ts: str) -> Column:
    test = F.col(ts).isNotNull()
    for k in keys:
        test = test & F.col(k).isNotNull()
    return test
