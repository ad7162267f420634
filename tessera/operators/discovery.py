"""Join discovery over a corpus of SQL text.

Cutting and reading SQL is by far the costliest step, and corpora repeat themselves.
So each distinct text of a corpus with repeats is cut once, and each distinct statement
is read once; what was found is looked up again by text and by statement.  Edges,
occurrences and the index by table are relational tables with one row per fact; no
operator gathers the occurrences of an edge into a list, because a popular edge may own
a large share of the whole corpus.  A corpus has one row per file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.functions import sqltext as sx
from tessera.sources.checkpoints import stored

#: order in which joins count as "seen first"
SEEN = ["file", "stmt_no", "scope_no", "join_no"]


def split_statements(corpus: DataFrame) -> DataFrame:
    """``(file, sql)`` -> one row per statement: ``(file, stmt_no, statement)``."""
    shielded = corpus.select("file", sx.fill_templates(F.col("sql")).alias("_sql")).select(
        "file", sx.shield(F.col("_sql")).alias("_sql")
    )
    return shielded.select(
        "file", F.posexplode(sx.statements(sx.tidy(F.col("_sql")))).alias("stmt_no", "statement")
    )


def _with_join(df: DataFrame, column: str) -> DataFrame:
    """Rows that mention a join at all: a cheap test ahead of the costly steps."""
    return df.where(F.contains(F.lower(column), F.lit("join")))


def _scopes(statements: DataFrame) -> DataFrame:
    """One row per SELECT, with the sources it can see."""
    peeled = (
        statements.withColumn("_depth", sx.nesting_depth(F.col("statement")))
        .withColumn("_peeled", sx.peel(F.col("statement"), F.col("_depth")))
        .select(
            "file",
            "stmt_no",
            F.col("_peeled.text").alias("_rest"),
            # outermost first, then in reading order
            F.array_sort(
                F.transform(
                    F.concat(
                        F.array(
                            F.struct(
                                (F.col("_depth") + 1).alias("level"),
                                F.lit(-1).alias("id"),
                                F.col("_peeled.text").alias("text"),
                            )
                        ),
                        F.col("_peeled.scopes"),
                    ),
                    lambda s: F.struct(
                        (-s["level"]).alias("order"), s["id"].alias("id"), s["text"].alias("text")
                    ),
                )
            ).alias("_scopes"),
        )
    )
    cut = peeled.withColumn(
        "_scopes",
        F.transform(
            "_scopes",
            lambda s: F.struct(
                s["id"].alias("id"),
                F.transform(
                    sx.branches(s["text"]),
                    lambda b: F.struct(
                        sx.items(sx.from_body(b)).alias("items"),
                        b.rlike(r"(?i)\bselect\b").alias("selects"),
                    ),
                ).alias("branches"),
                sx.references(s["text"]).alias("refs"),
            ),
        ),
    )
    # Tables a scope mentions anywhere below itself: own ones, then those of the
    # scopes it refers to.  References point to later entries (lower level), so one
    # pass from the back settles all of them.
    tables_below = F.aggregate(
        F.reverse("_scopes"),
        F.array().cast(
            "array<struct<id:int,tables:array<struct<alias:string,schema:string,table:string>>>>"
        ),
        lambda acc, s: F.concat(
            acc,
            F.array(
                F.struct(
                    s["id"].alias("id"),
                    F.concat(
                        F.flatten(
                            F.transform(
                                s["branches"], lambda b: sx.plain_sources(b["items"])
                            )
                        ),
                        F.flatten(
                            F.filter(acc, lambda e: F.array_contains(s["refs"], e["id"]))["tables"]
                        ),
                    ).alias("tables"),
                )
            ),
        ),
    )
    # Only statements with derived tables in a FROM need that list.
    below = F.when(F.size("_scopes") > 1, tables_below)
    rows = (
        cut.withColumn("_below", below)
        .select(
            "file",
            "stmt_no",
            "_rest",
            "_below",
            F.posexplode(
                F.flatten(
                    F.transform(
                        "_scopes", lambda s: F.filter(s["branches"], lambda b: b["selects"])
                    )
                )
            ).alias("scope_no", "_branch"),
        )
        .select("file", "stmt_no", "scope_no", "_below", F.col("_branch.items").alias("_items"))
    )
    first = F.get(F.col("_items"), F.lit(0))["text"]
    nested = F.flatten(
        F.filter(
            F.coalesce(F.col("_below"), F.array()),
            lambda e: F.array_contains(sx.references(first), e["id"]),
        )["tables"]
    )
    rest = F.slice(F.col("_items"), F.lit(2), F.greatest(F.size("_items") - 1, F.lit(0)))
    return rows.where(F.size("_items") > 1).select(
        "file",
        "stmt_no",
        "scope_no",
        "_items",
        sx.names(
            F.concat(
                sx.plain_sources(F.slice(F.col("_items"), F.lit(1), F.lit(1))),
                F.when(F.contains(first, F.lit(sx.REF_OPEN)), nested).otherwise(
                    F.array().cast("array<struct<alias:string,schema:string,table:string>>")
                ),
                sx.plain_sources(rest),
            )
        ).alias("_names"),
    )


def _spread(rows: DataFrame, key: str) -> DataFrame:
    """Few small rows with much work in each, dealt to all cores whatever their size."""
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def _texts(corpus: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """``(file, sql)`` of the texts to cut, and ``(file, text)`` of the files that they stand for.

    Where texts repeat, ``file`` of the first is a number of the text; else texts are
    files, and the second is None.  The estimate only decides on the way taken.  The corpus
    itself is read, or made, once.
    """
    joined = _with_join(stored(corpus.select("file", "sql"), "corpus"), "sql")
    n, distinct = joined.agg(F.count("*"), F.approx_count_distinct(F.xxhash64("sql"))).first()
    if 2 * distinct > n:
        return joined, None
    numbered = joined.select("sql").distinct().withColumn("file", F.monotonically_increasing_id())
    texts = stored(numbered.select("file", "sql"), "distinct-texts")
    files = joined.join(texts.withColumnRenamed("file", "text"), "sql").select("file", "text")
    return _spread(texts, "file"), files


def _joins_of(texts: DataFrame) -> DataFrame:
    """Joins of ``(file, sql)``, each distinct statement read once."""
    cut = stored(_with_join(split_statements(texts), "statement"), "statements")
    distinct = _spread(cut.select("statement").distinct(), "statement")
    read = _read(distinct.select(F.col("statement").alias("file"), F.lit(0).alias("stmt_no"), "statement"))
    read = stored(read.drop("stmt_no").withColumnRenamed("file", "statement"), "statement-joins")
    rest = [c for c in read.columns if c != "statement"]
    return cut.join(read, "statement").select("file", "stmt_no", *rest)


def extract_joins(corpus: DataFrame) -> DataFrame:
    """``(file, sql)`` -> one row per JOIN with a column equality in its ON.

    Columns: ``file, stmt_no, scope_no, join_no, kind, right_schema, right_table,
    right_alias, on_text, equalities, clause_text``; an equality is
    ``struct(left, right)`` of ``struct(schema, table, column)``.
    """
    texts, files = _texts(corpus)
    joins = _joins_of(texts)
    if files is None:
        return joins
    joins = stored(joins, "text-joins").withColumnRenamed("file", "text")
    return files.join(joins, "text").drop("text")


def _read(statements: DataFrame) -> DataFrame:
    """Joins of ``(file, stmt_no, statement)``, row by row."""

    def join_of(names: Column, item: Column, i: Column, on: Column) -> Column:
        def described(on: Column) -> Column:
            both = F.transform(
                sx.equalities(on),
                lambda e: F.struct(
                    sx.resolve(e["left"], names).alias("left"),
                    sx.resolve(e["right"], names).alias("right"),
                ),
            )
            return F.struct(
                i.alias("join_no"),
                sx.join_kind(item["word"]).alias("kind"),
                item["schema"].alias("right_schema"),
                item["table"].alias("right_table"),
                item["alias"].alias("right_alias"),
                sx.readable(on).alias("on_text"),
                both.alias("equalities"),
            )

        plain = F.endswith(F.lower(item["word"]), F.lit("join")) & (item["table"] != "")
        return F.when(plain, described(on))

    # The test for equalities stays inside the array: as a filter on a column it would
    # be pushed below the projection and evaluate all of this a second time.
    joins = F.filter(
        F.transform(
            F.arrays_zip(F.col("_items").alias("item"), sx.conditions(F.col("_items")).alias("on")),
            lambda j, i: join_of(F.col("_names"), j["item"], i, j["on"]),
        ),
        lambda j: F.size(j["equalities"]) > 0,
    )
    named = (
        _scopes(statements)
        .select("file", "stmt_no", "scope_no", F.explode(joins).alias("_j"))
        .select("file", "stmt_no", "scope_no", "_j.*")
    )
    shown = F.concat(
        F.concat_ws(".", "right_schema", "right_table"),
        F.when(
            F.col("right_alias") != F.col("right_table"), F.concat(F.lit(" "), "right_alias")
        ).otherwise(""),
    )
    return named.withColumn(
        "clause_text", F.concat(F.col("kind"), F.lit(" JOIN "), shown, F.lit(" ON "), F.col("on_text"))
    )


def equality_rows(joins: DataFrame) -> DataFrame:
    """One row per equality, unresolved sides included."""
    return joins.select(
        *SEEN, "kind", "on_text", "clause_text", F.posexplode("equalities").alias("eq_no", "_eq")
    ).select(*SEEN, "eq_no", "kind", "on_text", "clause_text", "_eq.left", "_eq.right")


def _side(end: Column) -> Column:
    return F.concat_ws(
        ".",
        F.lower(F.coalesce(end["schema"], F.lit(""))),
        F.lower(end["table"]),
        F.lower(end["column"]),
    )


def edge_id(left: Column, right: Column) -> Column:
    """The same text for a = b and b = a; no schema differs from a named one."""
    a, b = _side(left), _side(right)
    return F.concat_ws("|", F.least(a, b), F.greatest(a, b))


def usable_joins(joins: DataFrame) -> DataFrame:
    """Joins with at least one fully named equality: primary one, extras and edge id."""
    full = F.filter(
        "equalities", lambda e: e["left"]["table"].isNotNull() & e["right"]["table"].isNotNull()
    )
    return (
        joins.withColumn("_full", full)
        .where(F.size("_full") > 0)
        .select(
            *SEEN,
            "kind",
            "on_text",
            "clause_text",
            F.col("_full")[0]["left"].alias("left"),
            F.col("_full")[0]["right"].alias("right"),
            F.slice(F.col("_full"), F.lit(2), F.size("_full")).alias("extra"),
        )
        .withColumn("id", edge_id(F.col("left"), F.col("right")))
    )


def occurrences(usable: DataFrame) -> DataFrame:
    """One row per ``(id, file, on_text)``; the first join seen stands for repeats.

    A file sits in one task, so the map-side combine removes nearly all repeats
    and a popular edge is spread by file.
    """
    seen = F.struct("stmt_no", "scope_no", "join_no")
    payload = F.struct("kind", "clause_text", "left", "right", "extra", *SEEN[1:])
    return (
        usable.groupBy("id", "file", "on_text")
        .agg(F.min_by(payload, seen).alias("_p"))
        .select("id", "file", "on_text", "_p.*")
    )


def _edges(found: DataFrame, times: Column) -> DataFrame:
    first = F.struct("left", "right", "extra")
    return (
        found.groupBy("id")
        .agg(
            F.min_by(first, F.struct(*SEEN)).alias("_first"),
            F.sum(times).alias("n_occurrences"),
            F.min("file").alias("first_file"),
        )
        .select("id", "_first.*", "n_occurrences", "first_file")
    )


def edges(found: DataFrame) -> DataFrame:
    """One row per edge from occurrences: orientation and extras of the first join seen."""
    return _edges(found, F.lit(1))


def discover(corpus: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``(edges, occurrences)`` of a corpus."""
    texts, files = _texts(corpus)
    found = occurrences(usable_joins(_joins_of(texts)))
    if files is None:
        return edges(found), found
    # a text holds the same occurrences in each of its files, and the first file has the first one
    per_text = stored(found, "text-occurrences").withColumnRenamed("file", "text")
    held = files.groupBy("text").agg(F.count("*").alias("_files"), F.min("file").alias("file"))
    everywhere = files.join(per_text, "text").select(*found.columns)
    return _edges(per_text.join(held, "text"), F.col("_files")), everywhere


def table_key(end: Column) -> Column:
    return F.concat_ws(".", F.lower(F.coalesce(end["schema"], F.lit(""))), F.lower(end["table"]))


def edges_by_table(found_edges: DataFrame) -> DataFrame:
    """One row per (table, edge): both ends, once when they are the same table."""
    keys = F.array_distinct(F.array(table_key(F.col("left")), table_key(F.col("right"))))
    return found_edges.select(F.explode(keys).alias("table_key"), *found_edges.columns)


def scan_errors(corpus: DataFrame) -> DataFrame:
    """One row per file with a statement whose brackets do not pair up."""
    flat = split_statements(corpus).withColumn("_depth", sx.nesting_depth(F.col("statement")))
    left_over = (
        flat.withColumn("_rest", sx.peel(F.col("statement"), F.col("_depth"))["text"])
        .where(F.col("_rest").rlike("[()]"))
        .select("file", F.concat(F.lit("unbalanced brackets in statement "), "stmt_no").alias("m"))
    )
    # statements of one file stay in one task up to here; a file is a bounded row
    return left_over.groupBy("file").agg(
        F.array_join(F.array_sort(F.collect_set("m")), "; ").alias("message")
    )


def scan_statistics(corpus: DataFrame) -> DataFrame:
    """One row: files read, statements, joins with an equality, usable ones."""
    joins = extract_joins(corpus)
    per_file = corpus.select(F.lit(1).alias("files"), F.lit(0).alias("joins"), F.lit(0).alias("usable"))
    per_join = joins.select(
        F.lit(0).alias("files"),
        F.lit(1).alias("joins"),
        F.exists(
            "equalities", lambda e: e["left"]["table"].isNotNull() & e["right"]["table"].isNotNull()
        )
        .cast("int")
        .alias("usable"),
    )
    return per_file.unionByName(per_join).agg(
        F.sum("files").alias("files_scanned"),
        F.sum("joins").alias("joins_found"),
        F.sum("usable").alias("joins_usable"),
    )
