"""Declared keys and edges checked against the data."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.operators.declared import Relationship
from tessera.operators.keyed import salted_join


def _any_null(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a | b, [F.col(c).isNull() for c in columns])


def key_counts(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows per key; combined on the map side, so hot keys cost nothing."""
    return df.groupBy(*keys).agg(F.count("*").alias("n"))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Complete keys that occur more than once."""
    return key_counts(df.where(~_any_null(keys)), keys).where(F.col("n") > 1)


def check_primary_key(df: DataFrame, keys: Sequence[str], table: str = "") -> DataFrame:
    """One row: rows, distinct complete keys, repeated keys and their rows, null keys."""
    null = _any_null(keys)
    return (
        key_counts(df, keys)
        .agg(
            F.coalesce(F.sum("n"), F.lit(0)).alias("n_rows"),
            F.count(F.when(~null, 1)).alias("n_keys"),
            F.count(F.when(~null & (F.col("n") > 1), 1)).alias("duplicate_keys"),
            F.coalesce(F.sum(F.when(~null & (F.col("n") > 1), F.col("n"))), F.lit(0)).alias(
                "duplicate_rows"
            ),
            F.coalesce(F.sum(F.when(null, F.col("n"))), F.lit(0)).alias("null_key_rows"),
        )
        .select(
            F.lit(table).alias("table_name"),
            F.lit(",".join(keys)).alias("key_columns"),
            "*",
            ((F.col("duplicate_keys") == 0) & (F.col("null_key_rows") == 0)).alias("ok"),
        )
    )


def propose_primary_key(columns: DataFrame, keys: Sequence[str] = ("table_name",)) -> DataFrame:
    """Key candidates by name, best rule per table, one row per key column.

    1 ``id`` in a table with a singular name, 2 ``<table>_id``, 3 all ``<other>_id``
    columns of a link table (two or more, no own id).  Singular means: no final s.
    Input: the keys (last one the table name), ``name`` and ``pos``.
    """
    table, name = F.lower(F.col(keys[-1])), F.lower("name")
    own_id = (name == "id") & ~F.endswith(table, F.lit("s"))
    named_id = name == F.concat(table, F.lit("_id"))
    other_id = F.endswith(name, F.lit("_id")) & ~named_id
    tagged = columns.select(
        *keys,
        "pos",
        "name",
        own_id.alias("_own"),
        named_id.alias("_named"),
        other_id.alias("_other"),
        (name == "id").alias("_id"),
    )
    rules = (
        tagged.groupBy(*keys)
        .agg(
            F.max("_own").alias("_has_own"),
            F.max("_named").alias("_has_named"),
            F.max("_id").alias("_has_id"),
            F.sum(F.col("_other").cast("int")).alias("_others"),
        )
        .select(
            *keys,
            F.when(F.col("_has_own"), 1)
            .when(F.col("_has_named"), 2)
            .when((F.col("_others") >= 2) & ~F.col("_has_id"), 3)
            .alias("rule"),
        )
        .where(F.col("rule").isNotNull())
    )
    belongs = (
        ((F.col("rule") == 1) & F.col("_own"))
        | ((F.col("rule") == 2) & F.col("_named"))
        | ((F.col("rule") == 3) & F.col("_other"))
    )
    return tagged.join(rules, list(keys)).where(belongs).select(*keys, "rule", "pos", "name")


def confirm_primary_keys(proposed: DataFrame, frames: Mapping[str, DataFrame]) -> DataFrame:
    """``check_primary_key`` of every proposed key whose table is in ``frames``.

    Proposals, a row per key column of the given tables, come to the driver; data does not.
    """
    rows = proposed.where(F.col("table_name").isin(*frames)).orderBy("table_name", "pos").collect()
    columns: dict[str, list[str]] = {}
    for r in rows:
        columns.setdefault(r["table_name"], []).append(r["name"])
    checks = [check_primary_key(frames[t], names, t) for t, names in columns.items()]
    if not checks:
        return check_primary_key(proposed.limit(0), ["name"]).where(F.lit(False))
    return reduce(DataFrame.unionByName, checks)


def orphans(from_df: DataFrame, to_df: DataFrame, rel: Relationship) -> DataFrame:
    """Foreign-key values without a target, with their row counts.

    A key with a null part is no orphan.  Values are counted before the join.
    """
    wanted = key_counts(from_df.where(~_any_null(rel.from_columns)), rel.from_columns)
    there = to_df.select(
        *[F.col(t).alias(f) for f, t in zip(rel.from_columns, rel.to_columns)]
    ).distinct()
    return wanted.join(there, list(rel.from_columns), "left_anti")


def check_foreign_key(from_df: DataFrame, to_df: DataFrame, rel: Relationship) -> DataFrame:
    """One row: orphaned values and rows of the edge."""
    return orphans(from_df, to_df, rel).agg(
        F.lit(f"{rel.from_table}->{rel.to_table}").alias("edge"),
        F.count("*").alias("orphan_keys"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("orphan_rows"),
    )


def check_cardinality(from_df: DataFrame, to_df: DataFrame, rel: Relationship) -> DataFrame:
    """One row: most rows per key on either side, observed and declared cardinality."""

    def side(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
        return key_counts(df.where(~_any_null(columns)), columns).select(
            F.when(F.lit(name == "from"), F.col("n")).alias("from_n"),
            F.when(F.lit(name == "to"), F.col("n")).alias("to_n"),
        )

    both = side(from_df, rel.from_columns, "from").unionByName(side(to_df, rel.to_columns, "to"))
    observed = (
        F.when(F.col("max_to") > 1, "many_to_many")
        .when(F.col("max_from") > 1, "one_to_many")
        .otherwise("one_to_one")
    )
    return (
        both.agg(
            F.coalesce(F.max("from_n"), F.lit(0)).alias("max_from"),
            F.coalesce(F.max("to_n"), F.lit(0)).alias("max_to"),
        )
        .withColumn("observed", observed)
        .select(
            F.lit(f"{rel.from_table}->{rel.to_table}").alias("edge"),
            "max_from",
            "max_to",
            "observed",
            F.lit(rel.cardinality).alias("declared"),
            (F.col("observed") == rel.cardinality).alias("as_declared"),
        )
    )


def join_along(
    from_df: DataFrame, to_df: DataFrame, rel: Relationship, how: str = "inner",
    salts: int | None = None, spread_by: Sequence[str] = (),
) -> DataFrame:
    """Join over all key columns of the edge.

    The from-side is the large one and stands left, where adaptive execution can
    split a hot key; with ``salts`` it is split explicitly by a hash of
    ``spread_by``.  Target key columns are dropped, they equal the source ones.
    """
    renamed = to_df.withColumnsRenamed(dict(zip(rel.to_columns, rel.from_columns)))
    keys = list(rel.from_columns)
    if salts:
        return salted_join(from_df, renamed, keys, how, salts, spread_by or from_df.columns)
    return from_df.join(renamed, keys, how)


def _located(edges: DataFrame, tables: Mapping[str, DataFrame]) -> list[dict]:
    """Edges about the given tables: id, and per end the table's key and its columns, first ones first.

    A qualified end needs its own ``schema.table``; one without schema takes the table of that name
    where there is only one.  Of further equalities those between the same two tables count.
    """
    by_name: dict[str, list[str]] = {}
    for full in tables:
        by_name.setdefault(full.lower().rpartition(".")[2], []).append(full)
    exact = {full.lower(): full for full in tables}

    def table_of(end) -> str | None:
        if end["table"] is None:
            return None
        name = end["table"].lower()
        if end["schema"]:
            return exact.get(f"{end['schema'].lower()}.{name}")
        candidates = by_name.get(name, [])
        return candidates[0] if len(candidates) == 1 else None

    def column_of(full: str, end) -> str | None:
        names = {c.lower(): c for c in tables[full].columns}
        return names.get(end["column"].lower())

    found = []
    extra = ["extra"] if "extra" in edges.columns else []
    # only edges between columns of the given tables leave Spark, however many the corpus has
    named = sorted({full.rpartition(".")[2].lower() for full in tables})
    known_columns = sorted({c.lower() for df in tables.values() for c in df.columns})
    about = reduce(
        lambda a, b: a & b,
        [
            F.lower(F.col(f"{end}.{part}")).isin(values)
            for end in ("left", "right")
            for part, values in (("table", named), ("column", known_columns))
        ],
    )
    for row in edges.where(about).select("id", "left", "right", *extra).toLocalIterator():
        ends = (table_of(row["left"]), table_of(row["right"]))
        if None in ends:
            continue
        pairs = []
        for pair in [(row["left"], row["right"]), *[(e["left"], e["right"]) for e in (row["extra"] if extra else None) or []]]:
            here = (table_of(pair[0]), table_of(pair[1]))
            if here == ends[::-1] != ends:
                pair = pair[::-1]
            elif here != ends:
                continue
            columns = (column_of(ends[0], pair[0]), column_of(ends[1], pair[1]))
            pairs.append(columns)
        if pairs and None not in pairs[0]:
            known = [p for p in pairs if None not in p]
            found.append({"id": row["id"], "ends": ends, "columns": tuple(zip(*known, strict=True))})
    return found


def _common_types(spark, left: DataFrame, right: DataFrame, columns) -> list[str]:
    """Per key column the type that Spark itself compares the two sides in; text where there is none."""
    out = []
    for a, b in zip(*columns, strict=True):
        types = (left.schema[a].dataType.simpleString(), right.schema[b].dataType.simpleString())
        if types[0] == types[1]:
            out.append(types[0])
            continue
        try:
            both = F.coalesce(*[F.lit(None).cast(t) for t in types]).alias("c")
            out.append(spark.range(0).select(both).schema["c"].dataType.simpleString())
        except AnalysisException:
            out.append("string")
    return out


def corroborate(
    edges: DataFrame, tables: Mapping[str, DataFrame], least_rate: float = 0.95
) -> DataFrame:
    """Discovered edges measured on data: rows and matched rows per end, rates, cardinality, verdict.

    ``edges`` has ``id, left, right`` and ``extra`` (see discovery); ``tables`` maps
    ``schema.table``, or ``table`` where no schema is known, to data.  A composite edge is measured
    on its whole key, both sides in their common type; keys with a null part do not count.  Each
    table is read once: its keys are counted by (edge, side, value), so that the values of one
    column are spread out, and the two sides meet as counts; no pair of rows is formed.  Edges about
    other tables give no row.

    cardinality is one_to_one, one_to_many (one end is unique) or many_to_many.  verdict is
    confirmed where an end is unique and at least ``least_rate`` of the other end's rows match,
    refuted where nothing matches, else weak.
    """
    spark = edges.sparkSession
    wanted: dict[str, list[Column]] = {}
    for edge in _located(edges, tables):
        left, right = edge["ends"]
        types = _common_types(spark, tables[left], tables[right], edge["columns"])
        for side, (full, columns) in enumerate(zip(edge["ends"], edge["columns"], strict=True)):
            parts = [F.col(c).cast(t).cast("string") for c, t in zip(columns, types, strict=True)]
            complete = reduce(lambda a, b: a & b, [p.isNotNull() for p in parts])
            tagged = F.struct(F.lit(edge["id"]).alias("id"), F.lit(side).alias("side"), F.array(*parts).alias("value"))
            wanted.setdefault(full, []).append(F.when(complete, tagged))
    counts = [
        tables[full]
        .select(F.explode(F.array_compact(F.array(*keys))).alias("_k"))
        .groupBy("_k.id", "_k.side", "_k.value")
        .agg(F.count("*").alias("n"))
        for full, keys in sorted(wanted.items())
    ]
    if not counts:
        counts = [spark.createDataFrame([], "id string, side int, value array<string>, n long")]
    left = F.col("side") == 0
    by_value = (
        reduce(DataFrame.unionByName, counts)
        .groupBy("id", "value")
        .agg(
            F.coalesce(F.sum(F.when(left, F.col("n"))), F.lit(0)).alias("l"),
            F.coalesce(F.sum(F.when(~left, F.col("n"))), F.lit(0)).alias("r"),
        )
    )
    both = (F.col("l") > 0) & (F.col("r") > 0)
    measured = by_value.groupBy("id").agg(
        F.sum("l").alias("left_rows"),
        F.sum("r").alias("right_rows"),
        F.coalesce(F.sum(F.when(both, F.col("l"))), F.lit(0)).alias("left_matched"),
        F.coalesce(F.sum(F.when(both, F.col("r"))), F.lit(0)).alias("right_matched"),
        F.max("l").alias("left_per_key"),
        F.max("r").alias("right_per_key"),
    )
    rate = lambda side: F.coalesce(F.try_divide(f"{side}_matched", f"{side}_rows"), F.lit(0.0))
    unique = lambda side: F.col(f"{side}_per_key") <= 1
    holds = (unique("right") & (rate("left") >= least_rate)) | (unique("left") & (rate("right") >= least_rate))
    return measured.withColumns(
        {
            "left_rate": rate("left"),
            "right_rate": rate("right"),
            "cardinality": F.when(unique("left") & unique("right"), "one_to_one")
            .when(unique("left") | unique("right"), "one_to_many")
            .otherwise("many_to_many"),
            "verdict": F.when(F.col("left_matched") == 0, "refuted").when(holds, "confirmed").otherwise("weak"),
        }
    )
