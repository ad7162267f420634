"""Sensitivity, profiles, freshness, counts and names."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessera.operators.declared import ColumnHint

# Classes whose raw values must not be shown.
SENSITIVE = ("pii", "phi", "restricted")


def _hidden(name: str, dtype: T.DataType, method: str) -> Column:
    text = F.col(name).cast("string")
    if method == "hash":
        return F.sha2(text, 256)
    if method == "mask" and isinstance(dtype, T.StringType):
        return F.mask(text)
    return F.lit(None).cast(dtype)


def redact(
    df: DataFrame,
    hints: Sequence[ColumnHint],
    allowed: Sequence[str] = (),
    methods: Mapping[str, str] | None = None,
) -> DataFrame:
    """Sensitive columns hidden, all others untouched.

    ``methods`` gives hash, mask or null per class (restricted is null by default,
    the others are hashed); classes in ``allowed`` pass.  Names are matched as the session
    matches them, in any case unless it is case-sensitive; of several hints for a column any
    that hides it does.  A sensitive hint that matches no column is an error, not a leak.
    """
    how = {"pii": "hash", "phi": "hash", "restricted": "null", **(methods or {})}
    exact = df.sparkSession.conf.get("spark.sql.caseSensitive") == "true"
    named = (lambda n: n) if exact else str.lower
    hides = lambda h: h.classification in SENSITIVE and h.classification not in allowed
    missing = [h.name for h in hints if hides(h) and named(h.name) not in map(named, df.columns)]
    if missing:
        raise ValueError(f"sensitive hints match no column: {', '.join(missing)}")
    # of several hints for a column the hiding one comes last
    classes = {named(h.name): h.classification for h in sorted(hints, key=hides)}
    out = []
    for f in df.schema.fields:
        cls = classes.get(named(f.name), "unspecified")
        if cls in SENSITIVE and cls not in allowed:
            out.append(_hidden(f.name, f.dataType, how[cls]).alias(f.name))
        else:
            out.append(F.col(f.name))
    return df.select(*out)


def value_counts(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """``(column_name, value, n)`` in text form; one pass, combined on the map side."""
    pairs = F.explode(
        F.array(
            *[
                F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                for c in columns
            ]
        )
    )
    return (
        df.select(pairs.alias("_p")).groupBy("_p.column_name", "_p.value").agg(F.count("*").alias("n"))
    )


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Exact rows, nulls, null ratio and distinct values per column."""
    counts = value_counts(df, columns)
    return (
        counts.groupBy("column_name")
        .agg(
            F.sum("n").alias("n_rows"),
            F.coalesce(F.sum(F.when(F.col("value").isNull(), F.col("n"))), F.lit(0)).alias("n_null"),
            F.count("value").alias("n_distinct"),
        )
        .withColumn("null_ratio", F.col("n_null") / F.col("n_rows"))
    )


def profile_approx(df: DataFrame, columns: Sequence[str], rsd: float = 0.02) -> DataFrame:
    """The same in one aggregation without a shuffle of values; distinct is estimated."""
    parts = [
        F.struct(
            F.lit(c).alias("column_name"),
            F.count("*").alias("n_rows"),
            F.count_if(F.col(c).isNull()).alias("n_null"),
            F.approx_count_distinct(c, rsd).alias("n_distinct"),
        )
        for c in columns
    ]
    row = df.agg(F.array(*parts).alias("_p"))
    return row.select(F.inline("_p")).withColumn("null_ratio", F.col("n_null") / F.col("n_rows"))


def top_values(df: DataFrame, columns: Sequence[str], k: int = 3) -> DataFrame:
    """Most frequent non-null values per column, ties by value: example values to propose.

    The rank limit is applied by each task before the shuffle, so a column with a
    billion values sends ``k`` rows per task.
    """
    by = Window.partitionBy("column_name").orderBy(F.col("n").desc(), "value")
    return (
        value_counts(df, columns)
        .where(F.col("value").isNotNull())
        .withColumn("rank", F.row_number().over(by))
        .where(F.col("rank") <= k)
    )


# Fixed values of our own: seconds a table may lag behind, by declared cadence.
ALLOWED_LAG = {
    "realtime": 5 * 60,
    "minutes": 3_600,
    "hourly": 2 * 3_600,
    "daily": 2 * 86_400,
    "weekly": 8 * 86_400,
    "monthly": 32 * 86_400,
}


def check_freshness(df: DataFrame, ts: str, cadence: str, now: Column, table: str = "") -> DataFrame:
    """One row: newest timestamp, lag and whether it exceeds what the cadence allows."""
    newest = F.max(ts)
    # both times with or both without a zone, or daylight saving would come in
    kind = "timestamp_ntz" if isinstance(df.schema[ts].dataType, T.TimestampNTZType) else "timestamp"
    lag = F.timestamp_diff("SECOND", F.col("newest").cast(kind), now.cast(kind))
    allowed = ALLOWED_LAG.get(cadence)
    stale = F.lit(False) if allowed is None else F.coalesce(F.col("lag_seconds") > allowed, F.lit(True))
    return (
        df.agg(newest.alias("newest"))
        .withColumn("lag_seconds", lag)
        .select(
            F.lit(table).alias("table_name"),
            F.lit(cadence).alias("cadence"),
            "newest",
            "lag_seconds",
            stale.alias("stale"),
        )
    )


def row_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``; parquet answers from footers."""
    counts = [
        df.agg(F.count("*").alias("row_count")).select(F.lit(name).alias("table_name"), "row_count")
        for name, df in frames.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def stamp_row_counts(tables: DataFrame, counts: DataFrame, now: Column) -> DataFrame:
    """``row_count_last_run`` and ``last_run_at`` where a count is known."""
    known = counts.select("table_name", F.col("row_count").alias("_n"))
    return (
        tables.join(known, "table_name", "left")
        .withColumns(
            {
                "row_count_last_run": F.coalesce("_n", "row_count_last_run"),
                "last_run_at": F.when(F.col("_n").isNotNull(), now).otherwise(F.col("last_run_at")),
            }
        )
        .drop("_n")
    )


def resolve_alias(names: DataFrame, tables: DataFrame) -> DataFrame:
    """``(project_id, name)`` -> the table meant, null when unknown.

    A table name beats an alias; among aliases the first table wins.
    """
    exact = tables.select(
        "project_id", F.col("table_name").alias("name"), F.lit(0).alias("_by"), "pos", "table_name"
    )
    other = tables.select(
        "project_id", F.explode("aliases").alias("name"), F.lit(1).alias("_by"), "pos", "table_name"
    )
    best = (
        exact.unionByName(other)
        .groupBy("project_id", "name")
        .agg(F.min_by(F.struct("table_name", "_by"), F.struct("_by", "pos")).alias("_t"))
        .select(
            "project_id",
            "name",
            F.col("_t.table_name").alias("table_name"),
            (F.col("_t._by") == 1).alias("by_alias"),
        )
    )
    return names.join(best, ["project_id", "name"], "left")


def words(text: Column) -> Column:
    """Lower-case words; anything but letters, digits and _ separates."""
    return F.filter(F.split(F.lower(text), r"[^\p{L}\p{N}_]+"), lambda w: w != "")


#: Words of a phrase that are looked up; longer phrases are then compared in the text itself.
_ANCHOR = 3
#: Bits of the map of anchors, kept in longs.
_BITS, _LONG = 1 << 20, 64


def _place(anchor: Sequence[Column]) -> Column:
    """The bit of a run of words, found without joining the words."""
    return F.pmod(F.xxhash64(*anchor), F.lit(_BITS))


def _anchor_map(wanted: DataFrame) -> DataFrame:
    """One row: the bit map of all anchors as longs; of fixed size, whatever the number of terms."""
    bit = F.lit(None).cast("long")
    for n in range(1, _ANCHOR + 1):
        bit = F.when(F.size("_first") == n, _place([F.get("_first", F.lit(j)) for j in range(n)])).otherwise(bit)
    one = F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("_bit", F.lit(_LONG)).cast("int"))
    filled = wanted.select(bit.alias("_bit")).groupBy(F.floor(F.col("_bit") / _LONG).alias("id")).agg(F.bit_or(one).alias("_bits"))
    every = wanted.sparkSession.range(0, _BITS // _LONG, numPartitions=1).join(filled, "id", "left")
    in_order = F.sort_array(F.collect_list(F.struct("id", F.coalesce("_bits", F.lit(0).cast("long")).alias("_bits"))))
    return every.agg(in_order["_bits"].alias("_map"))


def _marked(bits: Column, bit: Column) -> Column:
    cell = F.get(bits, F.floor(bit / _LONG).cast("int"))
    return F.call_function("shiftright", cell, F.pmod(bit, F.lit(_LONG)).cast("int")).bitwiseAND(F.lit(1).cast("long")) == 1


def _beginnings(docs: DataFrame, wanted: DataFrame, doc_key: str, text: str) -> DataFrame:
    """(doc, _anchor): the runs of words of each text that the bit map of anchors lets through."""
    bits = _anchor_map(wanted).scalar()
    names = [f"_word{n}" for n in range(1, _ANCHOR + 1)]
    cut = docs.select(doc_key, words(F.col(text)).alias("_word1"))
    # each word beside those that follow it, null behind the last
    following = [F.slice("_word1", n, F.greatest(F.size("_word1"), F.lit(1))).alias(f"_word{n}") for n in range(2, _ANCHOR + 1)]
    each = cut.select(doc_key, F.arrays_zip("_word1", *following).alias("_runs")).select(doc_key, F.inline("_runs").alias(*names))
    has = [F.col(name).isNotNull() & _marked(bits, _place(names[:n])) for n, name in enumerate(names, 1)]
    flags = [f"_has{n}" for n in range(1, _ANCHOR + 1)]
    # words that begin no anchor leave before a run is formed
    tested = each.select(doc_key, *names, *[h.alias(flag) for h, flag in zip(has, flags, strict=True)])
    tested = tested.where(reduce(lambda a, b: a | b, map(F.col, flags)))
    formed = F.array(*[F.when(F.col(flag), F.concat_ws(" ", *names[:n])) for n, flag in enumerate(flags, 1)])
    return tested.select(doc_key, F.explode(F.array_compact(formed)).alias("_anchor"))


def tag_terms(docs: DataFrame, terms: DataFrame, doc_key: str, text: str = "text") -> DataFrame:
    """``(doc, term)`` where the words of the term occur in the text one after another.

    The first words of every phrase, three at most, are its anchor.  A bit map of all anchors, of fixed
    size, is looked up inside each text's row; only runs of words that it lets through are formed, and
    joined with the anchors by equality.  Where a phrase is longer, the few texts that hold its first
    words are joined again by key and searched for all of it.  No text is compared with every term, and
    no text takes part in the first join.
    """
    phrases = terms.select("term", words(F.col("term")).alias("_w")).where(F.size("_w") > 0)
    wanted = phrases.select(
        "term",
        F.slice("_w", 1, _ANCHOR).alias("_first"),
        F.array_join("_w", " ").alias("_phrase"),
        (F.size("_w") > _ANCHOR).alias("_long"),
    ).distinct()
    # a document's runs are told apart before terms are looked up: a run has several terms, a term one run
    pieces = _beginnings(docs, wanted, doc_key, text).distinct()
    anchors = wanted.select("term", F.array_join("_first", " ").alias("_anchor"), "_phrase", "_long")
    # a run that is no phrase's beginning goes before its text is moved anywhere
    short = pieces.join(anchors.where(~F.col("_long")), "_anchor").select(doc_key, "term")
    begun = pieces.join(anchors.where("_long"), "_anchor").select(F.col(doc_key).alias("_doc"), "term", "_phrase")
    padded = F.concat(F.lit(" "), F.array_join(words(F.col(text)), " "), F.lit(" "))
    whole = (
        docs.select(doc_key, text)
        # null equals null: a plain join would test its keys in the runs, and they would be made a second time
        .join(begun, F.col(doc_key).eqNullSafe(F.col("_doc")))
        .where(F.contains(padded, F.concat(F.lit(" "), F.col("_phrase"), F.lit(" "))))
        .select(doc_key, "term")
        .distinct()
    )
    return short.unionByName(whole)
