"""Mixing sources to target weights by capped water-filling, in built-in expressions only.

Targets: every source gets its weighted share of the wanted total; sources above their cap are
clamped and the excess goes to the others by weight until none is above.  With sources in order of
cap / weight this has a closed form: behind the clamped ones, what is left over the weight that is
left is the water level.

Sampling: a source is repeated whole as often as its target allows.  Of the rest, documents are taken
once more in rounds: a round goes through those that are no larger than what is still open, in a seeded
order, up to the first that does not fit.  A very long document thus ends a round, not the source.  At last
the one document whose size is nearest to what is still open closes the gap.  The place where a round stops
is found by two histograms of 4,096 cells over the order's hash, so no source is sorted as a whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.llm.common import WORD, text_of
from tessera.sources.checkpoints import checkpointed

#: Sources of at most this number go to every task; more are joined by key.
BROADCAST_SOURCES = 20_000
#: Rounds at most; each leaves less open than the size of the document that stopped it.
ROUNDS = 5


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def water_fill(sources: DataFrame, weights: list[int], share: float, epochs: int) -> DataFrame:
    """(source, source_size) with weight and target.

    Weights go round by the source's code points, null last.  ``share`` of all sizes is wanted; a
    target stops at ``epochs`` times its size, and so does the total.  One row per source is
    ordered here, never documents.
    """
    by_name = W.orderBy(F.col("source").asc_nulls_last())
    turn = (F.row_number().over(by_name) - 1) % len(weights)
    weight = F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int"))
    rows = sources.withColumn("weight", weight).withColumn("cap", F.col("source_size") * epochs)
    everything = W.partitionBy()
    wanted = F.least(F.sum("source_size").over(everything) * F.lit(share), F.sum("cap").over(everything) * F.lit(1.0))
    rising = W.orderBy(F.col("cap") / F.col("weight"), F.col("source").asc_nulls_last())
    before = rising.rowsBetween(W.unboundedPreceding, -1)
    rows = rows.withColumns(
        {
            "level": (wanted - F.coalesce(F.sum("cap").over(before), F.lit(0)))
            / (F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0)))
        }
    )
    rows = rows.withColumn(
        "water", F.max(F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.col("level"))).over(everything)
    )
    # where even the last source is above the level, all are full
    target = F.least(F.col("cap").cast("double"), F.coalesce(F.col("water") * F.col("weight"), F.col("cap").cast("double")))
    return rows.select("source", "source_size", "weight", target.alias("target"))


def _near(sources: DataFrame, n_sources: int) -> DataFrame:
    return F.broadcast(sources) if n_sources <= BROADCAST_SOURCES else sources


def place_of(seed: str, key: Column, size: Column) -> Column:
    """Where a key's document stands in the seeded order, as text; a null key counts as ''."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), size.cast("string"))
    return F.md5(named.cast("binary"))


def plan(
    docs: DataFrame,
    weights: list[int],
    share: float = 1.5,
    epochs: int = 2,
    seed: str = "mix",
    text: str = "text",
    key: str = "doc_id",
    source: str = "source",
) -> tuple[DataFrame, DataFrame]:
    """What to take: per source its size, target, whole repetitions, the rounds (what was open, and the
    place where the order stopped) and the place that closes the gap; and the documents it was made of, as
    (key, source, size, place).

    Size is the number of words, 0 for null or blank texts.  Null is a source like any other.  Rows
    that repeat a key with the same size stand at one place of the order and are taken alike.
    """
    slim = docs.select(
        F.col(key).alias("key"), F.col(source).cast("string").alias("source"), word_count(text_of(text)).alias("size")
    )
    # texts are read once; all that follows needs four narrow columns
    slim = checkpointed(slim.withColumn("place", place_of(seed, F.col("key"), F.col("size"))))
    sources = slim.groupBy("source").agg(F.sum("size").alias("source_size"))
    targets = water_fill(sources, weights, share, epochs)
    ratio = F.col("target") / F.col("source_size")
    whole = F.when(F.col("source_size") > 0, F.floor(ratio)).otherwise(F.lit(0)).cast("long")
    targets = targets.withColumn("whole", whole).withColumn("gap", F.col("target") - F.col("whole") * F.col("source_size"))
    none = F.array().cast("array<struct<gap: double, stop: string>>")
    state = checkpointed(targets.withColumnRenamed("source", "t").withColumn("rounds", none))
    n_sources = state.count()
    of = F.col("source").eqNullSafe(F.col("t"))
    for _ in range(ROUNDS):
        fits = (F.col("gap") > 0) & (F.col("size") <= F.col("gap")) & (F.col("size") > 0)
        open_ = slim.join(_near(state, n_sources), of).filter(fits & ~_taken(F.col("size"), F.col("place"), F.col("rounds")))
        stops = _stops(open_.select("source", "size", "place", "gap"), n_sources)
        went = state.join(stops, F.col("t").eqNullSafe(F.col("s")), "left")
        one = F.struct(F.col("gap"), F.col("stop"))
        went = went.withColumn("rounds", F.when(F.col("got").isNotNull(), F.concat("rounds", F.array(one))).otherwise(F.col("rounds")))
        went = checkpointed(went.withColumn("gap", F.col("gap") - F.coalesce("got", F.lit(0))).drop("s", "stop"))
        state = went.drop("got")
        if went.filter("got > 0").isEmpty():
            break
    off = F.abs(F.col("size") - F.col("gap"))
    closing = (
        slim.join(_near(state, n_sources), of)
        .filter((off < F.col("gap")) & ~_taken(F.col("size"), F.col("place"), F.col("rounds")))
        .groupBy("source", "place")
        .agg(F.sum("size").alias("size"), F.max("gap").alias("gap"))
        .filter(off < F.col("gap"))
        .groupBy("source")
        .agg(F.min(F.struct(off.alias("off"), "place")).alias("best"))
        .select(F.col("source").alias("c"), F.col("best.place").alias("closing"))
    )
    full = state.join(closing, F.col("t").eqNullSafe(F.col("c")), "left").drop("c")
    return checkpointed(full), slim


def _taken(size: Column, place: Column, rounds: Column) -> Column:
    """Whether any round took a document."""
    return F.exists(rounds, lambda r: (size <= r["gap"]) & (r["stop"].isNull() | (place < r["stop"])))


def _stops(rows: DataFrame, n_sources: int) -> DataFrame:
    """(s, stop, got) of a round over ``rows`` (source, size, place, gap): the first place whose documents
    no longer fit, null where all fit, and the size of those before it."""
    here = ["source", "gap"]
    cells = checkpointed(rows.groupBy(*here, F.substring("place", 1, 3).alias("cell")).agg(F.sum("size").alias("n")))
    first = checkpointed(_cut(cells.withColumn("below", F.lit(0))))
    # the cell of 4,096, and in it the cell of 4,096, in which the running size passes what is open
    inner = rows.join(_near(first, n_sources), F.col("source").eqNullSafe(F.col("t")) & (F.substring("place", 1, 3) == F.col("cut")))
    fine = inner.groupBy(*here, F.col("upto").alias("below"), F.substring("place", 1, 6).alias("cell"))
    second = checkpointed(_cut(fine.agg(F.sum("size").alias("n"))))
    last = rows.join(_near(second, n_sources), F.col("source").eqNullSafe(F.col("t")) & (F.substring("place", 1, 6) == F.col("cut")))
    last = last.groupBy(*here, F.col("upto").alias("below"), F.col("place").alias("cell")).agg(F.sum("size").alias("n"))
    cut = _cut(last).select("t", "cut", "upto")
    sums = cells.groupBy(F.col("source").alias("s")).agg(F.sum("n").alias("all"))
    met = sums.join(cut, F.col("s").eqNullSafe(F.col("t")), "left")
    return met.select("s", F.col("cut").alias("stop"), F.when(F.col("cut").isNull(), F.col("all")).otherwise(F.col("upto")).alias("got"))


def copies(rows: DataFrame, planned: DataFrame, place: Column, size: Column, source: str = "source") -> DataFrame:
    """Rows with source_size, target and copies, the repetitions that the plan takes of each.

    ``place`` and ``size`` are those that the plan was made of.  Rows of sources that the plan does not know
    are not taken.  Columns of these names are replaced.
    """
    rows = rows.drop("source_size", "target", "copies")
    names = rows.columns
    plan_ = planned.select(F.struct("*").alias("__plan"))
    here = rows.withColumns({"__place": place, "__size": size})
    near = F.broadcast(plan_) if planned.count() <= BROADCAST_SOURCES else plan_
    met = here.join(near, F.col(source).cast("string").eqNullSafe(F.col("__plan.t")), "left")
    p = lambda name: F.col(f"__plan.{name}")
    once = _taken(F.col("__size"), F.col("__place"), p("rounds")) | F.coalesce(F.col("__place") == p("closing"), F.lit(False))
    taken = p("whole") + F.coalesce(once, F.lit(False)).cast("long")
    return met.select(
        *names,
        p("source_size").alias("source_size"),
        p("target").alias("target"),
        F.coalesce(taken, F.lit(0)).cast("long").alias("copies"),
    )


def mix(docs: DataFrame, weights: list[int], share: float = 1.5, epochs: int = 2, seed: str = "mix", **names: str) -> DataFrame:
    """Per row of ``docs``: key, source, size, place, source_size, target and copies.

    Equal runs give equal results; an empty table gives an empty one.  ``names`` may rename text, key
    and source; see ``plan``.
    """
    planned, slim = plan(docs, weights, share, epochs, seed, **names)
    return copies(slim, planned, F.col("place"), F.col("size"))


def _cut(cells: DataFrame) -> DataFrame:
    """Per source (t) the first cell (cut) in which the running size passes ``gap``, and the running size
    up to it; ``below`` is what lies before all cells."""
    before = W.partitionBy("source").orderBy("cell").rowsBetween(W.unboundedPreceding, -1)
    rows = cells.withColumn("upto", F.coalesce(F.sum("n").over(before), F.lit(0)) + F.col("below"))
    passing = (F.col("upto") <= F.col("gap")) & (F.col("upto") + F.col("n") > F.col("gap"))
    return rows.filter(passing).select(F.col("source").alias("t"), F.col("cell").alias("cut"), "upto")
