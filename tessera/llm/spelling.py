"""Grouping of spelling variants by asymmetric chunks and grams.

Of two words that differ by one edit, one contributes two disjoint chunks, its halves, at their places;
the other contributes positional grams.  One edit leaves one of the chunks whole, and the gram that
equals it lies at the chunk's place or one before, as the words' lengths tell; only such grams are
formed, since no other could survive the shift filter.  Words meet by equality of chunk and gram and are
verified by their edit distance.

Many words share a chunk.  Such a hot chunk is not joined: of its words the segment beside the chunk,
where the edit must be, is halved again, and the half that the edit spares joins the chunk.  At last a
segment is one letter, and a group cannot hold more words than there are letters.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import LOWER, SLICE, UPPER, texts_of
from tessera.sources.checkpoints import checkpointed

#: Runs of letters that are words.
LETTERS = "[A-Za-zÀ-ÿ]+"
#: Words that may share a chunk before it is refined.
HOT = 256
#: Different words a task counts before it hands the counts on.
HELD = 200_000

_LOWER = str.maketrans(UPPER, LOWER)


def _counting(least: int, noise: int | None):
    """The function of one task: texts to words with counts, in parts."""
    letters = re.compile(LETTERS)

    def batch_of(counts: dict[str, int]) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], names=["word", "n"]
        )

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                for key, text in zip(batch.column("key").to_pylist(), texts_of(batch), strict=True):
                    base = zlib.crc32(b"%s:" % (b"" if key is None else str(key).encode()))
                    own = [w for w in letters.findall(text.translate(_LOWER)) if len(w) >= least]
                    for word in own:
                        if noise and not (h := zlib.crc32(word.encode(), base)) % noise:
                            at = h % len(word)
                            word = word[:at] + word[at + 1 :]
                            if len(word) < least:
                                continue
                        counts[word] = counts.get(word, 0) + 1
                    if len(counts) >= HELD:
                        yield batch_of(counts)
                        counts = {}
        yield batch_of(counts)

    return over


def words(
    docs: DataFrame,
    least_length: int = 7,
    least_count: int = 2,
    noise: int | None = None,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """(word, n): runs of letters of all texts, A-Z lower-cased, of at least so many code points and occurrences.

    With ``noise``, a run loses the code point h % length where that number divides h, the crc32 of
    ``<key>:<run>``; length and count hold for what is left.  A null text has no words, a null key is ''.
    """
    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    counted = slim.mapInArrow(_counting(least_length, noise), "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= least_count)


def _halves(lo: Column, hi: Column) -> Column:
    """The segments that may hold the edit if it is in lo..hi: its halves."""
    mid = F.floor((lo + hi) / 2).cast("int")
    parts = F.array(F.struct(lo.alias("lo"), mid.alias("hi")), F.struct(mid.alias("lo"), hi.alias("hi")))
    return F.filter(parts, lambda p: p["hi"] > p["lo"])


def _spared(word: Column, lo: Column, hi: Column, shift: Column) -> Column:
    """What lies outside the segment: the chunk of the longer word, or the gram of one shorter by ``shift``."""
    before, after = F.substring(word, F.lit(1), lo), F.substring(word, hi - shift + 1, F.char_length(word))
    return F.concat(before, F.lit(" "), after)


def _refined(rows: DataFrame) -> DataFrame:
    """Rows (word, size, lo, hi, shift) once per half of the segment, with what the edit then spares."""
    parts = rows.select("word", "size", "shift", F.explode(_halves(F.col("lo"), F.col("hi"))).alias("p"))
    parts = parts.select("word", "size", "shift", "p.lo", "p.hi")
    return parts.withColumn("spared", _spared(F.col("word"), F.col("lo"), F.col("hi"), F.col("shift")))


def near(words_: DataFrame, hot: int = HOT) -> DataFrame:
    """Pairs (a, b) of ``words_`` (word, ...) that differ by exactly one inserted, deleted or replaced
    code point, each pair once: a is longer, or before b where they are of one length.

    Words are distinct, not null and of two code points at least.
    """
    length = F.char_length("word").cast("int")
    whole = {"lo": F.lit(0), "hi": F.col("size")}
    long_ = words_.select("word", length.alias("size"), F.lit(0).alias("shift")).withColumns(whole)
    short = words_.select("word", length.alias("len"), F.explode(F.array(F.lit(0), F.lit(1))).alias("shift"))
    short = short.withColumn("size", F.col("len") + F.col("shift")).drop("len").withColumns(whole)
    at = ["size", "lo", "hi", "spared"]
    pairs = None
    while True:
        chunks, grams = checkpointed(_refined(long_)), checkpointed(_refined(short))
        crowded = chunks.groupBy(*at).count().filter((F.col("count") > hot) & (F.col("hi") - F.col("lo") > 1))
        crowded = checkpointed(crowded.select(*at, F.lit(True).alias("crowded")))
        more = not crowded.isEmpty()
        if more:
            chunks = chunks.join(crowded, at, "left")
            grams = grams.join(crowded, at, "left")
            long_, short = chunks.filter("crowded"), grams.filter("crowded")
            chunks, grams = chunks.filter("crowded IS NULL"), grams.filter("crowded IS NULL")
        a, b = chunks.select(*at, F.col("word").alias("a")), grams.select(*at, "shift", F.col("word").alias("b"))
        one_way = (F.col("shift") == 1) | (F.col("a") < F.col("b"))
        met = a.join(b, at).filter(one_way & (F.levenshtein("a", "b", 1) == 1)).select("a", "b")
        pairs = met if pairs is None else pairs.union(met)
        if not more:
            # an edit between the chunks spares both
            return pairs.distinct()


def variants(words_: DataFrame, factor: int = 10, hot: int = HOT) -> DataFrame:
    """Per row of ``words_`` (word, n): word, form, root, n, n_near and form_n.

    n_near is the number of near words; form the near word of largest n, of equal ones the first in
    code-point order, if that n is ``factor`` times the word's n at least; root the last form reached from
    form to form, the word itself without one.  form and form_n are null without a form.  An empty table
    gives an empty one.
    """
    counted = checkpointed(words_.select("word", "n"))
    pairs = checkpointed(near(counted, hot))
    both = pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b")))
    n_of = counted.select(F.col("word").alias("b"), F.col("n").alias("near_n"))
    around = both.join(n_of, "b").groupBy(F.col("a").alias("word")).agg(
        F.count("*").alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("order"), "b")).alias("best")
    )
    is_form = -F.col("best.order") >= factor * F.col("n")
    named = checkpointed(
        counted.join(around, "word", "left").select(
            "word",
            F.when(is_form, F.col("best.b")).alias("form"),
            "n",
            F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
            F.when(is_form, -F.col("best.order")).alias("form_n"),
        )
    )
    roots = checkpointed(named.filter("form IS NOT NULL").select("word", F.col("form").alias("root")))
    while True:  # n grows with every form, so there is no circle; paths shorten by half
        onward = roots.select(F.col("word").alias("root"), F.col("root").alias("further"))
        stepped = checkpointed(roots.join(onward, "root", "left").select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
        roots = stepped.select("word", "root")
        if stepped.filter("moved").isEmpty():
            break
    out = named.join(roots, "word", "left").withColumn("root", F.coalesce("root", "word"))
    return out.select("word", "form", "root", "n", "n_near", "form_n")
