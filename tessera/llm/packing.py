"""Packing of tokenized documents into sequences by bounded-space online best fit.

Every task packs its own documents as they come, the longest of each slice first: a fixed number of bins is open, a bitset has a bit
for each free space that an open bin has, and a piece goes to the bin whose free space exceeds it
least.  Where none has room, a new bin is opened and, if as many are open as may be, the fullest is
closed.  What is still open at the end of the tasks is packed again, bins as items, sixteen tasks
together, then sixteen of these, up to one; each such step sees sixteen times the open bins at most,
whatever the size of the input.
"""

from __future__ import annotations

import re
from array import array
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tessera.llm.common import SLICE, worker_state, written
from tessera.sources.checkpoints import checkpointed

#: Bins open at a time, and tasks whose open bins are packed again together.
OPEN_BINS, TOGETHER = 256, 16
#: Chunks of text whose ids a worker keeps, in each of two generations.
REMEMBERED = 250_000

_UPPER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
#: Letters that normalisation only lower-cases, and ASCII marks behind them.
_PLAIN = re.compile("([a-zÀ-ÖØ-öø-ÿ]+)([!-/:-@\\[-`{-~]*)")


def _byte_letters() -> dict[int, int]:
    """The letters that stand for bytes in byte-level vocabularies: printable ones for themselves."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in shown]
    return {b: b for b in shown} | {b: 256 + k for k, b in enumerate(hidden)}


class WordTokenizer:
    """Ids of texts under a vocabulary file of the tokenizers library that drops white space.

    No token reaches over white space, so a text's ids are those of its chunks between ASCII blanks in
    turn; chunks are remembered.  A chunk of plain letters goes to the model at once, since the split
    leaves it whole, and marks behind it are a run of their own; all others go through the whole tokenizer.
    Strings of special tokens are ordinary text.
    """

    def __init__(self, vocabulary: str):
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_str(vocabulary)
        self.whole.encode_special_tokens = True
        self.model = self.whole.model
        self.letters = _byte_letters()
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def _fresh(self, chunk: bytes) -> bytes:
        word = chunk.decode()
        plain = _PLAIN.fullmatch(word)
        if not plain:
            return array("I", self.whole.encode(word, add_special_tokens=False).ids).tobytes()
        if plain[2]:
            return self.chunk_ids(plain[1].encode()) + self.chunk_ids(plain[2].encode())
        shown = word.lower().encode().decode("latin1").translate(self.letters)
        return array("I", [t.id for t in self.model.tokenize(shown)]).tobytes()

    def chunk_ids(self, chunk: bytes) -> bytes:
        ids = self.young.get(chunk)
        if ids is None:
            ids = self.old.get(chunk)
            if ids is None:
                ids = self._fresh(chunk)
            if len(chunk) <= 64:
                if len(self.young) >= REMEMBERED:
                    self.young, self.old = {}, self.young
                self.young[chunk] = ids
        return ids

    def encode_batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, null as '', one behind the other, and where each text's begin and end."""
        # A-Z may be lower-cased at once: the tokenizer does it, and no composition is lost by it
        split = [(t or "").encode().translate(_UPPER).split() for t in texts.to_pylist()]
        chunks = pa.array(chain.from_iterable(split), pa.binary()).dictionary_encode()
        get, slow = self.young.get, self.chunk_ids
        found = [get(c) or slow(c) for c in chunks.dictionary.to_pylist()]
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        ids, starts, which = np.frombuffer(b"".join(found), "<u4"), np.cumsum(sizes) - sizes, chunks.indices.to_numpy()
        lengths = sizes[which]
        ends = np.concatenate([[0], np.cumsum(lengths)])
        flat = ids[np.repeat(starts[which] - ends[:-1], lengths) + np.arange(ends[-1])]
        return flat, ends[np.cumsum([0, *map(len, split)])]

    def encode(self, text: str) -> bytes:
        """The ids of one text as little-endian unsigned 32-bit integers."""
        return self.encode_batch(pa.array([text], pa.string()))[0].tobytes()


class OpenBins:
    """Best fit among at most ``count`` open bins of ``most`` places."""

    def __init__(self, most: int, count: int):
        self.most, self.count = most, count
        self.bits, self.n_open, self.made = 0, 0, 0
        self.at: list[list[int]] = [[] for _ in range(most + 1)]

    def _take(self, free: int) -> int:
        own = self.at[free]
        found = own.pop()
        if not own:
            self.bits ^= 1 << free
        self.n_open -= 1
        return found

    def place(self, length: int) -> tuple[int, int, int | None, bool]:
        """The bin of a piece, its offset there, the bin closed for want of room, whether the own is full."""
        fit, closed = self.bits >> length, None
        if fit:
            free = length + (fit & -fit).bit_length() - 1
            own = self._take(free)
        else:
            if self.n_open == self.count:
                closed = self._take((self.bits & -self.bits).bit_length() - 1)
            own, free = self.made, self.most
            self.made += 1
        left = free - length
        if left:
            self.at[left].append(own)
            self.bits |= 1 << left
            self.n_open += 1
        return own, self.most - free, closed, not left


_SCHEMA = "key long, piece int, start long, length long, token_ids binary, bin long, offset long, open boolean"
def _rows(rows: list[tuple], is_open: bool) -> pa.RecordBatch:
    kinds = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64()]
    columns = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    flags = pa.array([is_open] * len(rows), pa.bool_())
    names = ["key", "piece", "start", "length", "token_ids", "bin", "offset", "open"]
    return pa.RecordBatch.from_arrays([*columns, flags], names=names)


def _packing(shared, path: str, most: int, end: int, count: int):
    """The function of one task: documents to pieces, pieces to bins."""
    last = np.array([end], "<u4").tobytes()

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokenizer = worker_state(path, lambda: WordTokenizer(shared.value))
        bins = OpenBins(most, count)
        base = TaskContext.get().partitionId() << 32
        held: dict[int, list[tuple]] = {}
        for whole in batches:
            for at in range(0, whole.num_rows, SLICE):
                batch, done, pieces = whole.slice(at, SLICE), [], []
                flat, bounds = tokenizer.encode_batch(batch.column("text"))
                for k, key in enumerate(batch.column("key").to_pylist()):
                    ids = flat[bounds[k] : bounds[k + 1]].tobytes() + last
                    for piece, start in enumerate(range(0, len(ids) // 4, most)):
                        part = ids[4 * start : 4 * (start + most)]
                        pieces.append((key, piece, start, len(part) // 4, part))
                pieces.sort(key=lambda p: -p[3])  # the longest of a slice come first
                for p in pieces:
                    own, offset, closed, full = bins.place(p[3])
                    held.setdefault(own, []).append((*p, base | own, offset))
                    if full:
                        done += held.pop(own)
                    if closed is not None:
                        done += held.pop(closed)
                if done:
                    yield _rows(done, False)
        for rows in held.values():
            yield _rows(rows, True)

    return over


def _again(most: int, count: int):
    """Open bins of some tasks as items of new bins; ``members`` has the first bins and their places."""

    def over(table: pa.Table) -> pa.Table:
        rows = sorted(table.to_pylist(), key=lambda r: (-r["used"], r["root"]))
        bins, made = OpenBins(most, count), {}
        shut = set()
        for row in rows:
            own, offset, closed, full = bins.place(row["used"])
            new = made.setdefault(own, {"part": row["part"], "root": row["root"], "used": 0, "members": []})
            new["used"] += row["used"]
            new["members"] += [{"bin": m["bin"], "base": m["base"] + offset} for m in row["members"]]
            shut |= {own} if full else set()
            shut |= {closed} if closed is not None else set()
        out = [new | {"open": own not in shut} for own, new in made.items()]
        return pa.Table.from_pylist(out, schema=_MEMBERS)

    return over


_MEMBERS = pa.schema(
    [
        ("part", pa.int64()),
        ("root", pa.int64()),
        ("used", pa.int64()),
        ("members", pa.list_(pa.struct([("bin", pa.int64()), ("base", pa.int64())]))),
        ("open", pa.bool_()),
    ]
)
_MEMBERS_DDL = "part long, root long, used long, members array<struct<bin: long, base: long>>, open boolean"


def pack(
    docs: DataFrame,
    path: str,
    most: int = 2048,
    end: int = 0,
    bins: int = OPEN_BINS,
    text: str = "text",
    key: str = "doc_id",
) -> DataFrame:
    """Per piece of each row of ``docs``: key, piece, start, length, token_ids, sequence_id and offset.

    ``path`` is a vocabulary file of the tokenizers library on the driver.  A row's ids are those of its
    text, null as '', and then ``end``; more than ``most`` ids are cut into pieces of ``most``, of which
    the last may be shorter.  token_ids holds them as little-endian unsigned 32-bit integers.  A sequence
    takes ``most`` ids at most, from offset 0 on without gaps.  Rows that repeat a key, or have none, are
    packed each for itself.  An empty table gives an empty one; other columns do not matter.

    ``bins`` times ``most`` ids are held by a task.
    """
    spark = docs.sparkSession
    with open(path, encoding="utf-8") as vocabulary:
        shared = spark.sparkContext.broadcast(vocabulary.read())
    slim = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    packed = written(slim.mapInArrow(_packing(shared, path, most, end, bins), _SCHEMA), "packed")
    loose = packed.filter("open")
    level = loose.groupBy("bin").agg(F.sum("length").alias("used")).select(
        F.shiftright("bin", 32).alias("part"),
        F.col("bin").alias("root"),
        "used",
        F.array(F.struct("bin", F.lit(0).cast("long").alias("base"))).alias("members"),
        F.lit(True).alias("open"),
    )
    parts = (level.agg(F.max("part")).first()[0] or 0) + 1
    placed = None
    while True:
        parts = -(-parts // TOGETHER)
        grouped = level.withColumn("part", F.floor(F.col("part") / TOGETHER)).groupBy("part")
        level = checkpointed(grouped.applyInArrow(_again(most, bins), _MEMBERS_DDL))
        done = level if parts <= 1 else level.filter("not open")
        placed = done if placed is None else placed.union(done)
        if parts <= 1:
            break
        level = level.filter("open")
    moves = placed.select("root", F.explode("members").alias("m")).select("root", "m.bin", "m.base")
    names = [F.col("key").alias(key), "piece", "start", "length", "token_ids"]
    settled = packed.filter("not open").select(*names, F.col("bin").alias("sequence_id"), "offset")
    moved = loose.join(moves, "bin").select(*names, F.col("root").alias("sequence_id"), (F.col("offset") + F.col("base")).alias("offset"))
    return settled.unionByName(moved)


def sequences(packed: DataFrame) -> DataFrame:
    """(sequence_id, n_pieces, token_ids): the ids of each sequence in order; a group has one sequence's ids."""
    pieces = F.sort_array(F.collect_list(F.struct("offset", "token_ids")))
    joined = F.aggregate("pieces", F.lit(b"").cast("binary"), lambda made, p: F.concat(made, p["token_ids"]))
    return packed.groupBy("sequence_id").agg(pieces.alias("pieces")).select(
        "sequence_id", F.size("pieces").alias("n_pieces"), joined.alias("token_ids")
    )
