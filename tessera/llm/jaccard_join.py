"""Jaccard join of word n-gram sets under several global token orders.

Two sets that are alike enough share a token in their prefixes, whatever global order sorts them.
The first order puts tokens that are rare in the corpus first, by counts in a table of fixed size.
Prefixes are longer by two tokens than one shared token would need, and three must be shared: chance
meets in a single token go before any set is moved.  Under two further orders, by two hashes, the
prefixes must meet as well; only then are the sets compared.

Components, not pairs, are wanted, so links within what is linked already are never looked for: equal
sets are one class; in every token's group all are first compared with one leader, and then only
members of different components with each other.  That finds every link between components, and a
group of a million near copies costs a million comparisons instead of their square.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import (
    LOWER,
    PART,
    SLICE,
    UPPER,
    bitmap,
    bitmap_bits,
    bounded,
    map_arrow,
    place_in,
    texts_of,
    written,
)
from tessera.llm.graph import components
from tessera.sources.checkpoints import checkpointed

#: Cells of the table of token counts, and cells moved together.  More cells tell rare tokens from
#: those of passages that many texts share; a task's counts stop at 255, which keeps blocks small.
CELLS, BLOCK = 1 << 24, 1 << 18
#: Tokens that prefixes under the first order must share, or all that are needed where that is fewer.
SHARED = 3
#: Salts of the further orders.
ORDERS = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))

_LOWER = bytes.maketrans(UPPER.encode(), LOWER.encode())


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def shingles(text: str, words: int) -> np.ndarray:
    """Sorted distinct 64-bit tokens of the text's word n-grams; all of a shorter text is one n-gram.

    Words are split at ASCII blanks after lower-casing A-Z.
    """
    parts = text.encode().translate(_LOWER).split()
    if not parts:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, parts), np.uint64, len(parts))
    size = min(words, len(h))
    runs = np.full(len(h) - size + 1, size, np.uint64)
    for k in range(size):
        runs = _mix(runs * np.uint64(0x9E3779B97F4A7C15) + h[k : k + len(runs)])
    return np.unique(runs)


def _counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds up the blocks of counts that a task sees; memory is that of one table."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        for block, data in zip(batch.column("block").to_pylist(), batch.column("counts").to_pylist(), strict=True):
            raw = zlib.decompress(data)
            more = np.frombuffer(raw, np.uint8 if len(raw) == BLOCK else np.uint32)
            if block not in total:
                total[block] = np.zeros(BLOCK, np.uint32)
            own = total[block]
            # four billion is the most that is told apart
            own += np.minimum(more, np.uint32(2**32 - 1) - own)
    blocks = sorted(total)
    packed = [zlib.compress(total[b].tobytes(), 1) for b in blocks]
    yield pa.RecordBatch.from_arrays([pa.array(blocks, pa.int32()), pa.array(packed, pa.binary())], names=["block", "counts"])


def _level(counts: np.ndarray) -> np.ndarray:
    """Counts in 16 bits: themselves up to 32,767, from there on 1,900 steps for each power of two."""
    steps = np.floor((np.log2(np.maximum(counts, 1 << 15)) - 15) * 1900) + (1 << 15)
    return np.where(counts < 1 << 15, counts, steps).astype(np.uint16)


def _scan(docs: DataFrame, words: int) -> DataFrame:
    """One row per document (key, n, set identity) and, per task, the blocks of its token counts."""

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["key", "n", "sa", "sb", "block", "counts"]
        table = np.zeros(CELLS, np.uint8)
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                sets = [shingles(t, words) for t in texts_of(batch)]
                at, more = np.unique((np.concatenate(sets) % np.uint64(CELLS)).astype(np.uint32), return_counts=True)
                table[at] = np.minimum(table[at] + np.minimum(more, 255), 255)
                digests = [xxhash.xxh3_128_digest(s.tobytes()) for s in sets]
                halves = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
                none = pa.nulls(len(sets))
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("key"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(halves[:, 0]),
                        pa.array(halves[:, 1]),
                        none.cast(pa.int32()),
                        none.cast(pa.binary()),
                    ],
                    names=names,
                )
        small = table.reshape(-1, BLOCK)
        blocks = np.flatnonzero(small.any(axis=1)).tolist()
        packed = [zlib.compress(small[b].tobytes(), 1) for b in blocks]
        none = pa.nulls(len(blocks), pa.int64())
        yield pa.RecordBatch.from_arrays(
            [none, none, none, none, pa.array(blocks, pa.int32()), pa.array(packed, pa.binary())], names=names
        )

    return bounded(docs).mapInArrow(over, "key long, n long, sa long, sb long, block int, counts binary")


def _count_table(blocks: DataFrame) -> np.ndarray:
    """The corpus's counts, of fixed size; added up per group of tasks first, then per block."""
    kind = "block int, counts binary"
    parts = max(1, blocks.rdd.getNumPartitions() // 16)
    some = blocks.coalesce(parts).mapInArrow(_counts, kind)
    table = np.zeros(CELLS, np.uint16)
    for row in some.repartition("block").mapInArrow(_counts, kind).collect():
        counts = np.frombuffer(zlib.decompress(row["counts"]), np.uint32)
        table[row["block"] * BLOCK : (row["block"] + 1) * BLOCK] = _level(counts)
    return table


def _prefix_length(n, percent: int):
    return n - -(-percent * n // 100) + 1


def _prefixes(docs: DataFrame, words: int, percent: int, shared) -> DataFrame:
    """(key, n, prefix): the tokens that the rare-first order puts first, in that order."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        table, flat, sizes, keys, lengths = shared.value, [], [0], [], []
        for key, text in zip(batch.column("key").to_pylist(), texts_of(batch), strict=True):
            tokens = shingles(text, words)
            if len(tokens) and key is not None:
                count = table[(tokens % np.uint64(CELLS)).astype(np.int64)]
                length = _prefix_length(len(tokens), percent) + SHARED - 1
                first = tokens[np.lexsort((tokens, count))[:length]]
                flat.append(first)
                keys.append(key)
                lengths.append(len(tokens))
                sizes.append(sizes[-1] + len(first))
        values = np.concatenate(flat).view(np.int64) if flat else np.empty(0, np.int64)
        lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), pa.array(values))
        return pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.int64()), pa.array(lengths, pa.int64()), lists], names=["key", "n", "prefix"]
        )

    return map_arrow(docs, "key long, n long, prefix array<long>", over)


def _sets(docs: DataFrame, words: int, bits: int, shared) -> DataFrame:
    """(key, tokens) of the texts whose key is in the filter, read again rather than kept."""

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        place = batch.column("place").to_numpy(zero_copy_only=False)
        filled = shared.value
        hit = np.flatnonzero((filled[place >> 3] >> (place & 7).astype(np.uint8)) & 1)
        part = batch.take(pa.array(hit))
        sets = [shingles(t, words).tobytes() for t in texts_of(part)]
        return pa.RecordBatch.from_arrays([part.column("key"), pa.array(sets, pa.binary())], names=["key", "tokens"])

    placed = docs.filter("key IS NOT NULL").withColumn("place", place_in(bits, F.col("key")))
    return map_arrow(placed, "key long, tokens binary", over)


def _filter_of(keys: DataFrame, bits: int) -> np.ndarray:
    """The bitmap of the keys as one array of bytes, 32 MB at most."""
    filled = np.zeros(bits // 8, np.uint8)
    for row in bitmap(keys, "key", bits).collect():
        filled[row["part"] * PART // 8 : (row["part"] + 1) * PART // 8] = np.frombuffer(row["map"], np.uint8)
    return filled


def _meets(a: np.ndarray, b: np.ndarray) -> int:
    return int(np.isin(a, b, assume_unique=True, kind="sort").sum())


def alike(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether the prefixes meet under every further order, and then whether the sets are alike enough."""
    for salt in ORDERS:
        x, y = _mix(a ^ salt), _mix(b ^ salt)
        p, q = _prefix_length(len(x), percent) - 1, _prefix_length(len(y), percent) - 1
        # a shared prefix token exists exactly where the first common token lies in both prefixes
        if not _meets(np.partition(x, p)[: p + 1], np.partition(y, q)[: q + 1]):
            return False
    both = _meets(a, b)
    return 100 * both >= percent * (len(a) + len(b) - both)


def _verified(pairs: DataFrame, docs: DataFrame, words: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose sets are alike enough."""
    ends = pairs.select(F.col("a").alias("key")).union(pairs.select(F.col("b").alias("key"))).distinct()
    ends = checkpointed(ends)
    bits = bitmap_bits(ends.count())
    shared = docs.sparkSession.sparkContext.broadcast(_filter_of(ends, bits))
    # a text that the filter lets through by chance meets no pair
    sets = checkpointed(_sets(docs, words, bits, shared))

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        left, right = batch.column("ta").to_pylist(), batch.column("tb").to_pylist()
        good = [
            alike(np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64), percent)
            for x, y in zip(left, right, strict=True)
        ]
        return batch.select(["a", "b"]).filter(pa.array(good, pa.bool_()))

    with_a = pairs.join(sets.select(F.col("key").alias("a"), F.col("tokens").alias("ta")), "a")
    with_both = with_a.join(sets.select(F.col("key").alias("b"), F.col("tokens").alias("tb")), "b")
    return map_arrow(with_both.select("a", "b", "ta", "tb"), "a long, b long", over)


def _possible(n1: Column, p1: Column, n2: Column, p2: Column, percent: int) -> Column:
    """Length filter, and room behind the shared token for as many common ones as are needed.

    It holds for the first common token of sets that are alike enough.
    """
    length = F.least(n1, n2) * 100 >= F.greatest(n1, n2) * percent
    room = F.least(n1 - p1, n2 - p2) * (100 + percent) >= (n1 + n2) * percent
    return length & room


def _sharing(meets: DataFrame, lists: DataFrame, percent: int) -> DataFrame:
    """Pairs (a, b) out of ``meets`` (k1, n1, k2, n2) whose prefixes share enough tokens.

    ``lists`` has (key, tokens), of each prefix the tokens that any other has too: few numbers a text.
    """
    needed = F.ceil((F.col("n1") + F.col("n2")) * percent / (100 + percent))
    pairs = meets.select(
        F.least("k1", "k2").alias("a"), F.greatest("k1", "k2").alias("b"), F.least(needed, F.lit(SHARED)).alias("least")
    ).distinct()
    of = lambda end: lists.select(F.col("key").alias(end), F.col("tokens").alias(f"of_{end}"))
    both = pairs.join(of("a"), "a").join(of("b"), "b")
    return both.filter(F.size(F.array_intersect("of_a", "of_b")) >= F.col("least")).select("a", "b")


def join(docs: DataFrame, words: int = 5, percent: int = 80, text: str = "text", key: str = "doc_id") -> DataFrame:
    """Per row of ``docs``: key, n_shingles and component_id.

    Rows link when the Jaccard similarity of their sets is at least ``percent``; component_id is the
    smallest key that links reach, itself included.  Keys are integers.  A text without words, or null,
    has the empty set and links with nothing.  A row without key links with nothing and has component_id
    null; rows that repeat a key count as one document with each of their texts.  An empty table gives
    an empty one; other columns do not matter.
    """
    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    scanned = checkpointed(_scan(slim, words))
    spark = docs.sparkSession
    shared = spark.sparkContext.broadcast(_count_table(scanned.filter("block IS NOT NULL").select("block", "counts")))
    rows = scanned.filter("block IS NULL").select("key", "n", "sa", "sb")
    # equal sets are one class, known by its smallest key
    classes = checkpointed(
        rows.filter("n > 0 AND key IS NOT NULL").groupBy("sa", "sb").agg(F.min("key").alias("rep"), F.count("*").alias("size"))
    )
    prefixes = _prefixes(slim, words, percent, shared).join(
        classes.select(F.col("rep").alias("key")).distinct(), "key", "left_semi"
    )
    tokens = written(prefixes, "jaccard-prefixes").select("key", "n", F.posexplode("prefix").alias("pos", "token"))
    several = tokens.groupBy("token").count().filter("count > 1").select("token")
    tokens = checkpointed(tokens.join(several, "token", "left_semi"))
    lists = checkpointed(tokens.groupBy("key").agg(F.collect_list("token").alias("tokens")))
    leaders = checkpointed(
        tokens.groupBy("token")
        .agg(F.min(F.struct("pos", "key", "n")).alias("l"))
        .select("token", F.col("l.key").alias("lead"), F.col("l.n").alias("ln"), F.col("l.pos").alias("lp"))
    )
    star = (
        tokens.join(leaders, "token")
        .filter(F.col("key") != F.col("lead"))
        .filter(_possible(F.col("n"), F.col("pos"), F.col("ln"), F.col("lp"), percent))
        .select(F.col("key").alias("k1"), F.col("n").alias("n1"), F.col("lead").alias("k2"), F.col("ln").alias("n2"))
    )
    star = checkpointed(_sharing(star, lists, percent))
    edges = checkpointed(_verified(star, slim, words, percent))
    found = checkpointed(components(edges))

    # what may still link: members of one token's group that are in different components
    known = found.select(F.col("node").alias("key"), "component")
    labelled = checkpointed(
        tokens.join(known, "key", "left").withColumn("component", F.coalesce("component", "key"))
    )
    split = labelled.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).filter("lo < hi")
    lead = leaders.join(split.select("token"), "token", "left_semi").select("token", "lead")
    mains = lead.join(known.withColumnRenamed("key", "lead"), "lead", "left").select(
        "token", F.coalesce("component", "lead").alias("main")
    )
    open_rows = checkpointed(labelled.join(checkpointed(mains), "token"))
    left = open_rows.filter("component <> main").select(
        "token", F.col("key").alias("k1"), F.col("n").alias("n1"), F.col("pos").alias("p1"), F.col("component").alias("c1")
    )
    right = open_rows.select("token", "key", "n", "pos", "component", "main")
    rest = (
        left.join(
            right,
            (left["token"] == right["token"])
            & (F.col("c1") != F.col("component"))
            & ((F.col("component") == F.col("main")) | (F.col("k1") < F.col("key")))
            & _possible(F.col("n1"), F.col("p1"), F.col("n"), F.col("pos"), percent),
        )
        .select("k1", "n1", F.col("key").alias("k2"), F.col("n").alias("n2"))
    )
    rest = _sharing(rest, lists, percent).join(star, ["a", "b"], "left_anti")
    more = checkpointed(_verified(checkpointed(rest), slim, words, percent))
    if not more.isEmpty():
        found = checkpointed(components(more.union(found.select(F.col("node").alias("a"), F.col("component").alias("b")))))
    named = classes.join(found.select(F.col("node").alias("rep"), "component"), "rep", "left")
    named = checkpointed(
        named.filter("size > 1 OR component IS NOT NULL").select(
            "sa", "sb", F.coalesce("component", "rep").alias("component")
        )
    )
    done = rows.join(named, (F.col("n") > 0) & (rows["sa"] == named["sa"]) & (rows["sb"] == named["sb"]), "left")
    reached = F.when(F.col("key").isNotNull(), F.coalesce("component", "key"))
    return done.select(F.col("key").alias(key), F.col("n").alias("n_shingles"), reached.alias("component_id"))
