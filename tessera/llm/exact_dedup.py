"""Exact duplicates by content-defined chunk recipes, in built-in expressions only.

Every normalised text is cut into chunks where its own bytes say so.  A chunk gets a 128-bit
identifier; chunks are reduced to distinct (identifier, content) pairs, combined on the map side, and
the identifiers are verified: no two contents may share one.  If two do, the next seed is taken.
Then texts are compared by their ordered identifier lists alone: after the one pass over distinct
chunks no long text moves again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import ascii_lower, text_of, written
from tessera.sources.checkpoints import checkpointed

#: Least and most bytes of a chunk.
LEAST, MOST = 512, 8192


def _bytes_with(residue: int, modulus: int) -> str:
    return "[" + "".join(f"\\x{b:02x}" for b in range(256) if b % modulus == residue) + "]"


def boundary_pattern(least: int = LEAST, most: int = MOST) -> str:
    """Chunks as a pattern over bytes: the shortest run of ``least`` to ``most`` bytes that ends
    behind three bytes of given residues or at the end; else up to ``most`` bytes."""
    window = _bytes_with(5, 8) + _bytes_with(4, 8) + _bytes_with(6, 8)
    return f"(?s).{{{least},{most}}}?(?:(?<={window})|\\z)|.{{1,{most}}}"


def chunks(text: Column) -> Column:
    """The chunks of a text in order, each byte shown as one Latin-1 character."""
    shown = F.decode(text.cast("binary"), "ISO-8859-1")
    return F.regexp_extract_all(shown, F.lit(boundary_pattern()), 0)


def identifier(chunk: Column, seed: int) -> Column:
    return F.struct(
        F.xxhash64(F.lit(seed), chunk).alias("a"), F.xxhash64(chunk, F.lit(seed), F.length(chunk)).alias("b")
    )


def verified_seed(cut: DataFrame, chunk: str, seeds: range = range(8)) -> int:
    """The first seed under which no two different chunks of ``cut`` share an identifier."""
    for seed in seeds:
        distinct = cut.select(identifier(F.col(chunk), seed).alias("id"), chunk).distinct()
        shared = distinct.groupBy("id").count().filter("count > 1")
        if shared.isEmpty():
            return seed
    raise ArithmeticError("no seed gives every chunk an identifier of its own")


def _named(rows: DataFrame, text: str) -> DataFrame:
    """``rows`` with their text's verified identifiers in order, as __recipe, and its text_sha256."""
    norm = ascii_lower(text_of(text))
    seed = verified_seed(rows.select(F.explode(chunks(norm)).alias("__chunk")), "__chunk")
    recipe = F.transform(chunks(norm), lambda c: identifier(c, seed))
    return rows.withColumns({"__recipe": recipe, "text_sha256": F.sha2(norm, 256)})


def _grouped(named: DataFrame, columns: list[str], key: str) -> DataFrame:
    groups = (
        named.groupBy("__recipe")
        .agg(F.max(key).alias("__keep"), F.count("*").alias("__size"))
        .filter("__size > 1")
        .withColumnRenamed("__recipe", "__group")
    )
    groups = checkpointed(groups)  # a plain scan below the join, so that a hot group can be split
    joined = named.join(groups, F.col("__recipe") == F.col("__group"), "left")
    alone = F.col("__size").isNull()
    return joined.select(
        *columns,
        F.when(alone, F.col(key)).otherwise(F.col("__keep")).alias("keep_id"),
        F.coalesce("__size", F.lit(1)).cast("long").alias("group_size"),
        F.when(alone, F.lit(True)).otherwise(F.col(key).eqNullSafe(F.col("__keep"))).alias("kept"),
        "text_sha256",
    )


def duplicates(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """All rows and columns of ``docs`` with keep_id, group_size, kept and text_sha256 of their text.

    Texts are equal when identical after lower-casing A-Z; null counts as ''.  Of equal texts the
    largest key stays.  A null key never wins over another; a group of null keys only has keep_id
    null and keeps every row.  Rows that repeat key and text are all kept or all dropped.  Columns
    of these four names are replaced; an empty table gives an empty one.
    """
    rows = docs.drop("keep_id", "group_size", "kept", "text_sha256")
    return _grouped(_named(rows, text), rows.columns, key)


def marks(docs: DataFrame, text: str = "text", key: str = "doc_id") -> DataFrame:
    """The key and the four columns of ``duplicates``, a row for every row of ``docs``.

    Without texts to return, keys, recipes and digests are written once; groups and join read those.
    """
    named = written(_named(docs.select(key, text), text).drop(text), "recipes")
    return _grouped(named, [key], key)
