"""Byte-level BPE encoding and decoding with a two-tier lookup.

A text is split into pre-tokens by the tokenizer's pattern.  A pre-token that is itself in the
vocabulary is found in a minimal perfect hash: one table of the vocabulary's size, one displacement
per bucket, the slot's bytes compared with the token's.  The others are merged by rank: pairs wait in
a heap, bytes are linked to their neighbours, so a token of n bytes costs n log n.
"""

from __future__ import annotations

import base64
from array import array
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql.types import StructType

from tessera.llm.common import map_arrow, texts_of, worker_state

#: Pre-tokens whose ids a worker remembers, in each of two generations; each takes some 200 bytes.
REMEMBERED = 150_000
#: Bits of an id in a pair, and of a place in the heap: of short pieces, whose numbers stay small, and others.
SHIFT, SHORT, PLACES = 20, 12, 40


def read_ranks(path: str) -> list[bytes]:
    """The vocabulary of a rank file: token i has rank and id i."""
    with open(path, "rb") as lines:
        pairs = [line.split() for line in lines if line.strip()]
    tokens = {int(rank): base64.b64decode(token) for token, rank in pairs}
    return [tokens[i] for i in range(len(tokens))]


def _slot(h: np.ndarray, d: np.ndarray, n: int) -> np.ndarray:
    x = h ^ (d.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return ((x ^ (x >> np.uint64(32))) % np.uint64(n)).astype(np.int64)


class PerfectHash:
    """A minimal perfect hash over distinct byte strings: as many slots as keys."""

    def __init__(self, keys: list[bytes]):
        self.n = n = len(keys)
        h = self.hashes(keys)
        if len(np.unique(h)) != n:
            raise ValueError("keys are not distinct")
        bucket = (h % np.uint64(n)).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        starts = np.flatnonzero(np.r_[True, np.diff(bucket[order]) != 0])
        groups = sorted(np.split(order, starts[1:]), key=len, reverse=True)
        free = np.ones(n, bool)
        self.displace = np.zeros(n, np.int64)
        self.key_at = np.zeros(n, np.int64)
        for k, members in enumerate(groups):
            if len(members) == 1:
                break
            d = 1
            while True:
                slots = _slot(h[members], np.full(len(members), d), n)
                if free[slots].all() and len(set(slots.tolist())) == len(slots):
                    break
                d += 1
            free[slots] = False
            self.key_at[slots] = members
            self.displace[bucket[members[0]]] = d
        else:
            k = len(groups)
        # buckets of one key take what is left: their slot itself, as a negative displacement
        left = np.flatnonzero(free)
        single = np.array([g[0] for g in groups[k:]], np.int64)
        self.key_at[left] = single
        self.displace[bucket[single]] = -1 - left

    @staticmethod
    def hashes(keys: list[bytes]) -> np.ndarray:
        return np.fromiter(map(xxhash.xxh3_64_intdigest, keys), np.uint64, len(keys))

    def candidates(self, keys: list[bytes]) -> list[int]:
        """For each key the only index it can have; whether it has it, its bytes must tell."""
        h = self.hashes(keys)
        d = self.displace[(h % np.uint64(self.n)).astype(np.int64)]
        return self.key_at[np.where(d < 0, -1 - d, _slot(h, np.maximum(d, 0), self.n))].tolist()


class Tokenizer:
    def __init__(self, tokens: list[bytes], pattern: str, table: PerfectHash | None = None):
        self.tokens, self.table = tokens, table or PerfectHash(tokens)
        self.pattern = regex.compile(pattern)
        place = {t: i for i, t in enumerate(tokens)}
        self.single = [place.get(bytes([b]), -1) for b in range(256)]
        #: Rank, which is the merged token's id, by the ids of two neighbours.
        self.pairs = {
            place[t[:k]] << SHIFT | place[t[k:]]: i
            for i, t in enumerate(tokens)
            for k in range(1, len(t))
            if t[:k] in place and t[k:] in place
        }
        #: The same by two bytes.
        self.first = [-1] * (1 << 16)
        for a, x in enumerate(self.single):
            for b, y in enumerate(self.single):
                if x >= 0 and y >= 0:
                    self.first[a << 8 | b] = self.pairs.get(x << SHIFT | y, -1)
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def merge(self, piece: bytes) -> list[int]:
        """Ids of a piece: always the pair of lowest rank first, the leftmost of equal ones.

        The heap holds rank and place of pairs; ``rank`` tells which of them still stand.
        """
        single, first = self.single, self.first
        ids = [single[b] for b in piece]
        n, get = len(ids), self.pairs.get
        after, before = list(range(1, n + 1)), list(range(-1, n - 1))
        rank = [first[a << 8 | b] for a, b in zip(piece, piece[1:], strict=False)]
        rank.append(-1)
        bits = SHORT if n <= 1 << SHORT else PLACES
        places = (1 << bits) - 1
        heap = [r << bits | i for i, r in enumerate(rank) if r >= 0]
        heapify(heap)
        while heap:
            top = heappop(heap)
            r, i = top >> bits, top & places
            if rank[i] != r:
                continue  # one of the two has been merged since
            j = after[i]
            k = after[i] = after[j]
            ids[i], ids[j], rank[j] = r, -1, -1
            q = -1
            if k < n:
                before[k] = i
                q = get(r << SHIFT | ids[k], -1)
                if q >= 0:
                    heappush(heap, q << bits | i)
            rank[i] = q
            p = before[i]
            if p >= 0:
                q = rank[p] = get(ids[p] << SHIFT | r, -1)
                if q >= 0:
                    heappush(heap, q << bits | p)
        return [x for x in ids if x >= 0]

    def encode_batch(self, texts: list[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        split = [self.pattern.findall(t) for t in texts]
        young, old, found, missing = self.young, self.old, {}, []
        for piece in set().union(*split):
            ids = young.get(piece)
            if ids is None:
                ids = old.get(piece)
                if ids is None:
                    missing.append(piece)
                    continue
                young[piece] = ids
            found[piece] = ids
        raw = [p.encode() for p in missing]
        for piece, data, i in zip(missing, raw, self.table.candidates(raw), strict=True):
            ids = (i,) if self.tokens[i] == data else self.merge(data)
            found[piece] = young[piece] = array("I", ids).tobytes()
        if len(young) >= REMEMBERED:
            self.young, self.old = {}, young
        return [b"".join(map(found.__getitem__, own)) for own in split]

    def decode(self, ids: bytes) -> bytes:
        return _bytes_of(self.tokens, ids)


def _bytes_of(tokens: list[bytes], ids: bytes) -> bytes:
    return b"".join(map(tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


def _shared_tokenizer(key: str, shared) -> Tokenizer:
    """One tokenizer per worker and vocabulary; its memory of pre-tokens lasts over tasks."""
    return worker_state(key, lambda: Tokenizer(*shared.value))


def _shared(df: DataFrame, path: str, pattern: str):
    """The vocabulary, some megabytes of fixed size, sent to every worker once, and its name."""
    tokens = read_ranks(path)
    return df.sparkSession.sparkContext.broadcast((tokens, pattern, PerfectHash(tokens))), f"{path} {pattern}"


def _with(rows: DataFrame, **types: str) -> StructType:
    schema = StructType(list(rows.schema.fields))
    for name, kind in types.items():
        schema.add(name, kind, True)
    return schema


def encode(docs: DataFrame, path: str, pattern: str, text: str = "text", decoded: bool = False) -> DataFrame:
    """All rows and columns of ``docs`` with token_ids and n_tokens.

    ``path`` is a rank file on the driver.  token_ids holds the ids as little-endian unsigned 32-bit
    integers.  Null counts as '' and has no tokens.  With ``decoded``, a column of that name has the bytes
    that the ids stand for, in the same pass.  Columns of these names are replaced.
    """
    rows = docs.drop("token_ids", "n_tokens", *["decoded"] * decoded)
    shared, name = _shared(rows, path, pattern)
    columns = rows.columns
    made = {"token_ids": "binary", "n_tokens": "long"} | ({"decoded": "binary"} if decoded else {})

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokenizer = _shared_tokenizer(name, shared)
        ids = tokenizer.encode_batch(texts_of(batch, text))
        new = [pa.array(ids, pa.binary()), pa.array([len(i) // 4 for i in ids], pa.int64())]
        if decoded:
            new.append(pa.array(list(map(tokenizer.decode, ids)), pa.binary()))
        return pa.RecordBatch.from_arrays([*batch.columns, *new], names=[*columns, *made])

    return map_arrow(rows, _with(rows, **made), over)


def decode(encoded: DataFrame, path: str, pattern: str, ids: str = "token_ids") -> DataFrame:
    """All rows and columns with ``decoded``, the bytes that the ids stand for; null ids count as none."""
    rows = encoded.drop("decoded")
    shared, _ = _shared(rows, path, pattern)
    columns = rows.columns

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        tokens = shared.value[0]
        data = pa.array([_bytes_of(tokens, i or b"") for i in batch.column(ids).to_pylist()], pa.binary())
        return pa.RecordBatch.from_arrays([*batch.columns, data], names=[*columns, "decoded"])

    return map_arrow(rows, _with(rows, decoded="binary"), over)
