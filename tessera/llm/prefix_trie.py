"""Prefix tries of conversations as double arrays.

A turn is known by a digest of its role and text, a conversation by the list of its turns.  Equal lists
become one path with its conversations' number and smallest id.  Paths are sharded by their first turn;
where more paths share a prefix than a shard should hold, these are sharded by a prefix twice as long, and
so on.  A shard numbers its turns densely and packs its trie into two arrays: a node's child over turn t
lies in slot BASE[node] + t, where CHECK names the node.  Each path is walked through the arrays, and the
nodes' aggregates are summed from the leaves up.

Nodes above the prefix that a shard is known by are shared with other shards.  These upper nodes leave the
shards as partial aggregates, are merged by a digest of their path, and summed along their paths globally.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import WORD
from tessera.sources.checkpoints import checkpointed

#: Paths that a shard holds, about, and paths of one prefix that are not sharded further.
SHARD = 5_000
#: Upper nodes of at most this number go to every task; more are joined by key.
BROADCAST_UPPER = 20_000
#: Conversation ids that are listed together.
LISTED = 4_096

_NONE = hashlib.sha256(b"").hexdigest()
_ROOT = hashlib.md5(b"").hexdigest()  # noqa: S324  a name, no secret


class DoubleArray:
    """BASE and CHECK over dense turn numbers; the root is slot 0."""

    def __init__(self) -> None:
        self.base = array("q", [0])
        self.check = array("q", [-2])  # -1: free; the root is nobody's child
        self.free = 1

    def _room(self, size: int) -> None:
        more = size - len(self.check)
        if more > 0:
            self.base.extend([0] * more)
            self.check.extend([-1] * more)

    def put(self, node: int, turns: list[int]) -> None:
        """Place the children of a node, given by ascending turn numbers."""
        low, high, tries = turns[0], turns[-1], 0
        while self.free < len(self.check) and self.check[self.free] != -1:
            self.free += 1
        at = self.free
        while True:
            self._room(at + high - low + 1)
            if all(self.check[at + t - low] == -1 for t in turns):
                break
            tries += 1
            # behind the last slot there always is room
            at = len(self.check) if tries > 64 else at + 1
        self.base[node] = at - low
        for t in turns:
            self.check[at - low + t] = node

    def child(self, node: int, turn: int) -> int:
        slot = self.base[node] + turn
        return slot if 0 <= slot < len(self.check) and self.check[slot] == node else -1


def _built(paths: list[list[int]]) -> DoubleArray:
    """The trie of sorted distinct paths, a level at a time."""
    trie, level, depth = DoubleArray(), [(0, 0, len(paths))], 0
    while level:
        below = []
        for node, start, stop in level:
            groups: list[tuple[int, int, int]] = []
            for k in range(start, stop):
                if len(paths[k]) > depth:
                    turn = paths[k][depth]
                    if groups and groups[-1][0] == turn:
                        groups[-1] = (turn, groups[-1][1], k + 1)
                    else:
                        groups.append((turn, k, k + 1))
            if groups:
                trie.put(node, [g[0] for g in groups])
                below += [(trie.base[node] + turn, a, b) for turn, a, b in groups]
        level, depth = below, depth + 1
    return trie


_NODES = pa.schema(
    [
        ("node", pa.string()),
        ("parent", pa.string()),
        ("trail", pa.list_(pa.string())),
        ("depth", pa.int64()),
        ("words", pa.int64()),
        ("conv_id", pa.int64()),
        ("parent_conv_id", pa.int64()),
        ("n_convs", pa.int64()),
        ("n_children", pa.int64()),
        ("n_leaves", pa.int64()),
        ("saved_tokens", pa.int64()),
        ("ends_sha256", pa.string()),
    ]
)
_NODES_DDL = (
    "node string, parent string, trail array<string>, depth long, words long, conv_id long, parent_conv_id long, "
    "n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string"
)


def _nodes(table: pa.Table) -> pa.Table:
    """All nodes of a shard's paths; upper nodes have a trail and only what lies below them in this shard."""
    rows = table.to_pylist()
    number: dict[str, int] = {}
    paths = []
    for row in rows:
        paths.append([number.setdefault(turn, len(number)) for turn in row["turns"]])
    order = sorted(range(len(rows)), key=paths.__getitem__)
    trie = _built([paths[k] for k in order])
    n = len(trie.check)
    least: list = [None] * n
    convs, words, depths, upper = array("q", [0]) * n, array("q", [0]) * n, array("q", [0]) * n, bytearray(n)
    names: list = [None] * n
    ends: list = [_NONE] * n
    seen = []
    for row, path in zip(rows, paths, strict=True):
        node, digest = 0, hashlib.md5()  # noqa: S324
        for depth in range(len(path) + 1):
            if depth:
                node = trie.child(node, path[depth - 1])
                digest.update(("," if depth > 1 else "").encode() + row["turns"][depth - 1].encode())
            if names[node] is None:
                names[node], depths[node], upper[node] = digest.hexdigest(), depth, depth < row["sharded"]
                words[node] = row["words"][depth - 1] if depth else 0
                seen.append(node)
            convs[node] += row["n"]
            if least[node] is None or row["conv_id"] < least[node]:
                least[node] = row["conv_id"]
        ends[node] = row["ends_sha256"]
    children, leaves, saved = array("q", [0]) * n, array("q", [0]) * n, array("q", [0]) * n
    seen.sort(key=lambda node: -depths[node])
    for node in seen:
        if not upper[node]:
            leaves[node] += children[node] == 0
            saved[node] += (convs[node] - 1) * words[node]
        parent = trie.check[node]
        # what upper nodes add is known only when all shards are merged
        if parent >= 0 and not upper[node]:
            children[parent] += 1
            leaves[parent] += leaves[node]
            saved[parent] += saved[node]
    trails: dict[int, list[str]] = {}
    for node in reversed(seen):  # from the root down
        if upper[node]:
            parent = trie.check[node]
            trails[node] = [*(trails[parent] if parent >= 0 else []), names[node]]
    out = []
    for node in seen:
        parent = trie.check[node]
        own = parent >= 0 and not upper[parent]
        out.append(
            {
                "node": names[node],
                "parent": names[parent] if parent >= 0 else None,
                "trail": trails.get(node),
                "depth": depths[node],
                "words": words[node],
                "conv_id": least[node],
                "parent_conv_id": least[parent] if own else None,
                "n_convs": convs[node],
                "n_children": children[node],
                "n_leaves": leaves[node],
                "saved_tokens": saved[node],
                "ends_sha256": ends[node],
            }
        )
    return pa.Table.from_pylist(out, schema=_NODES)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lists of ids in order, one path behind the other, to one digest a path; holds one list at a time."""
    name, digest, out = None, None, []
    for batch in batches:
        for path, listed in zip(batch.column("path").to_pylist(), batch.column("listed").to_pylist(), strict=True):
            if path != name:
                out += [(name, digest.hexdigest())] if digest else []
                name, digest = path, hashlib.sha256(listed.encode())
            else:
                digest.update(b"," + listed.encode())
        if out:
            yield pa.RecordBatch.from_pylist([{"path": p, "sha": d} for p, d in out])
            out = []
    if digest:
        yield pa.RecordBatch.from_pylist([{"path": name, "sha": digest.hexdigest()}])


def turns_of(conversations: DataFrame) -> DataFrame:
    """(conv_id, turns, words) of every conversation: digests of its turns in order, and their words.

    Order is by turn, null first, then role and digest; null roles and texts are ''.  Rows without a
    conv_id belong to no conversation and are left out.
    """
    role, said = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    digest = F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, said).cast("binary"))
    slim = conversations.filter("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.struct(
            F.col("turn"), role.alias("role"), digest.alias("id"), F.regexp_count(said, F.lit(WORD)).cast("long").alias("n")
        ).alias("t"),
    )
    listed = slim.groupBy("conv_id").agg(F.sort_array(F.collect_list("t")).alias("ts"))
    return listed.select("conv_id", F.col("ts.id").alias("turns"), F.col("ts.n").alias("words"))


def rebuilt(listed: DataFrame, group: int = 20, most: int = 4) -> DataFrame:
    """Conversations (conv_id, turns, words) that begin like the first of their group.

    The first h turns come from conversation conv_id - conv_id % group (remainder with the sign of conv_id),
    fewer where it is shorter, none where it is absent; then follow the own turns behind the first h.
    h = crc32(conv_id) % most.
    """
    h = F.pmod(F.crc32(F.col("conv_id").cast("string").cast("binary")), F.lit(most)).cast("int")
    group_of = F.col("conv_id") - F.col("conv_id") % group
    heads = listed.filter(F.col("conv_id") % group == 0).select(
        F.col("conv_id").alias("g"), F.slice("turns", 1, most - 1).alias("ht"), F.slice("words", 1, most - 1).alias("hw")
    )
    met = listed.withColumns({"h": h, "g": group_of}).join(heads, "g", "left")

    def both(head: str, own: str, empty: str) -> Column:
        first = F.slice(F.coalesce(F.col(head), F.array().cast(empty)), F.lit(1), F.col("h"))
        return F.concat(first, F.slice(F.col(own), F.col("h") + 1, F.greatest(F.size(own), F.lit(0))))

    return met.select("conv_id", both("ht", "turns", "array<string>").alias("turns"), both("hw", "words", "array<long>").alias("words"))


def _name(turns: Column) -> Column:
    return F.md5(F.array_join(turns, ",").cast("binary"))


def _paths(listed: DataFrame) -> DataFrame:
    """Distinct paths with their number of conversations, smallest conversation and digest of all their ids."""
    named = checkpointed(listed.withColumn("path", _name(F.col("turns"))))
    paths = checkpointed(
        named.groupBy("path").agg(
            F.min("conv_id").alias("conv_id"), F.count("*").alias("n"), F.first("turns").alias("turns"), F.first("words").alias("words")
        )
    )
    shared = paths.filter("n > 1").select("path")
    ids = named.select("path", "conv_id").join(shared, "path", "left_semi")
    block = ids.groupBy("path", F.floor(F.col("conv_id") / LISTED).alias("block"))
    in_order = F.transform(F.sort_array(F.collect_list("conv_id")), lambda c: c.cast("string"))
    blocks = block.agg(F.array_join(in_order, ",").alias("listed"))
    n = int(blocks.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    in_turn = blocks.repartition(n, "path").sortWithinPartitions("path", "block").select("path", "listed")
    digests = in_turn.mapInArrow(_digests, "path string, sha string")
    alone = F.sha2(F.col("conv_id").cast("string").cast("binary"), 256)
    return paths.join(digests, "path", "left").withColumn("ends_sha256", F.coalesce("sha", alone)).drop("sha")


def _sharded(paths: DataFrame, shard: int) -> DataFrame:
    """Paths with ``sharded``, the length of the prefix that their shard is known by, and ``prefix``."""
    open_, done, length = paths, None, 1
    while True:
        prefix = _name(F.slice("turns", 1, length))
        open_ = open_.withColumn("prefix", prefix).withColumn("sharded", F.lit(length))
        reach = open_.filter(F.size("turns") >= length)
        crowded = checkpointed(reach.groupBy("prefix").count().filter(F.col("count") > shard).select("prefix", F.lit(True).alias("crowded")))
        if crowded.isEmpty():
            return open_ if done is None else done.unionByName(open_)
        marked = open_.join(crowded, "prefix", "left")
        rest = marked.filter("crowded IS NULL").drop("crowded")
        done = rest if done is None else done.unionByName(rest)
        open_ = marked.filter("crowded").drop("crowded")
        length *= 2


def _beside(rows: DataFrame, upper: DataFrame, n_upper: int) -> DataFrame:
    """Rows with the conv_id of their parent, which is an upper node."""
    parents = upper.select(F.col("node").alias("parent"), F.col("conv_id").alias("of_parent"))
    met = rows.join(F.broadcast(parents) if n_upper <= BROADCAST_UPPER else parents, "parent", "left")
    return met.withColumn("parent_conv_id", F.coalesce("parent_conv_id", "of_parent")).drop("of_parent")


def trie(listed: DataFrame, shard: int = SHARD) -> DataFrame:
    """Per node of the prefix trie of ``listed`` (conv_id, turns, words): conv_id, depth, parent_conv_id,
    n_convs, n_children, n_leaves, saved_tokens, ends_sha256 and node, a digest of its path.

    conv_ids are distinct.  ``turns`` are texts without commas that stand for turns, ``words`` their numbers
    of words.  The root has depth 0 and stands for the empty path; conversations without turns end there.
    Without any conversation there is no node.  A task holds the paths of a shard, texts never.
    """
    paths = _sharded(checkpointed(_paths(listed)), shard)
    buckets = max(1, -(-paths.count() // shard))
    placed = paths.withColumn("bucket", F.pmod(F.xxhash64("prefix"), F.lit(buckets)))
    of_shards = placed.select("bucket", "turns", "words", "conv_id", "n", "sharded", "ends_sha256")
    made = checkpointed(of_shards.groupBy("bucket").applyInArrow(_nodes, _NODES_DDL))
    owned, partial = made.filter("trail IS NULL"), made.filter("trail IS NOT NULL")
    merged = checkpointed(
        partial.groupBy("node").agg(
            F.first("parent").alias("parent"),
            F.first("trail").alias("trail"),
            F.first("depth").alias("depth"),
            F.first("words").alias("words"),
            F.min("conv_id").alias("conv_id"),
            F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("n_children"),
            F.sum("n_leaves").alias("n_leaves"),
            F.sum("saved_tokens").alias("saved_tokens"),
            F.max(F.when(F.col("ends_sha256") != _NONE, F.col("ends_sha256"))).alias("ends_sha256"),
        )
    )
    more = merged.filter("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("more"))
    merged = merged.join(more, "node", "left").withColumn("n_children", F.col("n_children") + F.coalesce("more", F.lit(0)))
    merged = merged.withColumns(
        {
            "n_leaves": F.col("n_leaves") + (F.col("n_children") == 0).cast("long"),
            "saved_tokens": F.col("saved_tokens") + (F.col("n_convs") - 1) * F.col("words"),
        }
    )
    merged = checkpointed(merged)
    sums = merged.select(F.explode("trail").alias("node"), "n_leaves", "saved_tokens").groupBy("node")
    sums = sums.agg(F.sum("n_leaves").alias("n_leaves"), F.sum("saved_tokens").alias("saved_tokens"))
    upper = checkpointed(merged.drop("n_leaves", "saved_tokens").join(sums, "node"))
    upper = upper.withColumn("parent_conv_id", F.lit(None).cast("long"))
    n_upper = upper.count()
    names = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256", "node"]
    under = owned.filter("parent_conv_id IS NULL").drop("trail")
    out = owned.filter("parent_conv_id IS NOT NULL").select(*names)
    for rows in (under, upper):
        out = out.unionByName(_beside(rows, upper, n_upper).select(*names))
    return out.withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(_NONE)))
