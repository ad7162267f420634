"""The mined occurrences of a corpus that changes, in buckets of its files.

The state has one row per file with its length, time and digest, and one per occurrence of an edge in it
(``found``).  A new version lists the corpus, reads files whose length or time differs, and replaces what
they held; edges are aggregated from the occurrences that are left, so an edge goes with its last one.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timedelta, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.operators import discovery
from tessera.sources.buckets import Buckets
from tessera.sources.checkpoints import checkpointed
from tessera.sources.corpus import list_sql_corpus, read_sql_corpus

_FILE = ("file", "length", "modified", "digest")


def mined_buckets(root: str, count: int = 64) -> Buckets:
    """The state's folder; files are dealt to ``count`` buckets by their path."""
    return Buckets(root, [F.col("file")], count)


def _file_rows(texts: DataFrame) -> DataFrame:
    return texts.select("file", "length", "modified", F.sha2("sql", 256).alias("digest"))


def _state_rows(texts: DataFrame) -> DataFrame:
    """State rows of ``(file, length, modified, sql)``: each file's own, and its occurrences."""
    _, seen = discovery.discover(texts.select("file", "sql"))
    found = F.struct(*[c for c in seen.columns if c != "file"]).alias("found")
    return _file_rows(texts).unionByName(seen.select("file", found), allowMissingColumns=True)


def begin(spark: SparkSession, store: Buckets) -> None:
    """A state without files, as version -1."""
    store.begin(_state_rows(spark.createDataFrame([], "file string, length long, modified long, sql string")))


def files_of(state: DataFrame) -> DataFrame:
    return state.where(F.col("found").isNull()).select(*_FILE)


def occurrences_of(state: DataFrame) -> DataFrame:
    return state.where(F.col("found").isNotNull()).select("file", "found.*")


def edges_of(spark: SparkSession, store: Buckets, version: int) -> DataFrame:
    """The edges of a version, as ``discovery.edges`` gives them for the corpus at that time."""
    return discovery.edges(occurrences_of(store.read(spark, version)))


def changed_files(listed: DataFrame, known: DataFrame) -> DataFrame:
    """``(file, length, modified, gone, old_digest)`` of files that came, went or differ in length or time."""
    new = listed.select("file", "length", "modified")
    old = known.select("file", F.col("length").alias("_l"), F.col("modified").alias("_m"), F.col("digest").alias("old_digest"))
    same = F.col("length").eqNullSafe(F.col("_l")) & F.col("modified").eqNullSafe(F.col("_m"))
    return (
        new.join(old, "file", "full_outer")
        .where(~same)
        .select("file", "length", "modified", F.col("length").isNull().alias("gone"), "old_digest")
    )


def update(
    spark: SparkSession, store: Buckets, corpus: str, version: int, also_ignored: Sequence[str] = ()
) -> DataFrame:
    """Store ``corpus`` as it is now as ``version``, which follows the one before; ``(file, outcome)`` of changes.

    Outcomes are added, changed, touched (another time, the same text) and removed.  Files no newer than the
    oldest changed one are not read; nor are buckets without a changed file.  A file rewritten with its old
    length and time counts as unchanged.  A file that goes or changes between listing and reading is
    found by the next version.  An update that is run again replaces its own version.
    """
    known = files_of(store.read(spark, version - 1))
    changes = checkpointed(changed_files(list_sql_corpus(spark, corpus, also_ignored), known))
    touched = store.touched(changes)
    oldest = changes.agg(F.min("modified").alias("t")).first()["t"]
    came = changes.where(~F.col("gone"))
    if oldest is None:
        # nothing came: an empty corpus of the same columns
        texts = spark.createDataFrame([], "file string, sql string")
    else:
        # the reader's times are whole seconds
        since = datetime.fromtimestamp(oldest // 1_000_000, timezone.utc) - timedelta(seconds=1)
        texts = read_sql_corpus(spark, corpus, also_ignored, since)
    fresh = came.select("file", "length", "modified").join(texts, "file").persist()
    new = _state_rows(fresh)
    kept = store.read(spark, version - 1, touched).join(changes.select("file"), "file", "left_anti")
    store.write(kept.unionByName(new), version, touched)
    digests = _file_rows(fresh).select("file", "digest")
    outcome = (
        F.when(F.col("gone"), "removed")
        .when(F.col("old_digest").isNull(), "added")
        .when(F.col("old_digest") == F.col("digest"), "touched")
        .otherwise("changed")
    )
    outcomes = checkpointed(changes.join(digests, "file", "left").select("file", outcome.alias("outcome")))
    fresh.unpersist()
    return outcomes
