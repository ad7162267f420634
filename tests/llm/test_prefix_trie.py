"""The prefix trie against plain prefixes."""

import hashlib
import random
import zlib

import pytest

from tessera.llm import prefix_trie, queries

NAMES = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def plain(rows):
    """rows of (conv_id, turn, role, text) to sorted node rows."""
    own = {}
    for c, turn, role, text in rows:
        if c is not None:
            own.setdefault(c, []).append((turn is not None, turn or 0, role or "", text or ""))
    convs = {c: [t[2:] for t in sorted(ts, key=lambda t: t[:3])] for c, ts in own.items()}
    built = {}
    for c, turns in convs.items():
        h = zlib.crc32(str(c).encode()) % 4
        built[c] = tuple(convs.get(c - c % 20, [])[:h] + turns[h:])
    members = {}
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members.setdefault(turns[:d], []).append(c)
    children = {}
    for p in members:
        if p:
            children.setdefault(p[:-1], []).append(p)

    def below(p):
        kids = [below(k) for k in children.get(p, [])]
        saved = (len(members[p]) - 1) * (len(p[-1][1].split()) if p else 0)
        return sum(k[0] for k in kids) or 1, saved + sum(k[1] for k in kids)

    out = []
    for p, own_ in members.items():
        ends = ",".join(str(c) for c in sorted(own_) if len(built[c]) == len(p))
        leaves, saved = below(p)
        parent = min(members[p[:-1]]) if p else None
        sha = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(own_), len(p), parent, len(own_), len(children.get(p, [])), leaves, saved, sha))
    return sorted(out, key=str)


def got(spark, rows, shard):
    frame = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")
    listed = prefix_trie.rebuilt(prefix_trie.turns_of(frame))
    return sorted([tuple(r[n] for n in NAMES) for r in prefix_trie.trie(listed, shard).collect()], key=str)


def made(rng, n):
    rows = []
    for c in range(n):
        for turn in range(rng.choice([1, 1, 2, 3, 5, 8])):
            text = rng.choice(["hi", "hi there", "a, b", "", None, f"only {c}"]) if turn < 3 else rng.choice(["x y z", f"late {c % 7}"])
            rows.append((c * rng.choice([1, 1, 3]), turn if rng.random() < 0.95 else None, rng.choice(["user", "user", None]), text))
    # roles decide between rows of one turn
    seen, out = set(), []
    for r in rows:
        if (r[0], r[1], r[2] or "") not in seen:
            seen.add((r[0], r[1], r[2] or ""))
            out.append(r)
    return out


@pytest.mark.parametrize("shard", [5000, 12, 2])
def test_nodes(spark, shard):
    rows = made(random.Random(shard), 240)
    assert got(spark, rows, shard) == plain(rows)


def test_many_copies_and_a_common_beginning(spark):
    rows = [(c, t, "user", f"step {t}") for c in range(0, 4000, 20) for t in range(6)]
    rows += [(c, 0, "user", "step 0") for c in range(1, 400, 20)] + [(c, 1, "bot", f"own {c}") for c in range(1, 400, 20)]
    assert got(spark, rows, 3) == plain(rows)


def test_a_long_conversation(spark):
    rows = [(0, t, "user", f"turn {t}") for t in range(600)] + [(20, t, "user", f"turn {t}") for t in range(500)]
    assert got(spark, rows, 1) == plain(rows)


def test_odd_rows(spark):
    rows = [(None, 0, "user", "lost"), (7, None, None, None), (7, 0, "user", "x"), (7, 0, "user", "x"), (-3, 0, "a", "b" * 9000)]
    frame = spark.createDataFrame([(*r, 1) for r in rows], "conv_id long, turn long, role string, text string, node int")
    listed = prefix_trie.turns_of(frame)
    assert {r.conv_id: len(r.turns) for r in listed.collect()} == {7: 3, -3: 1}
    assert prefix_trie.trie(listed).filter("depth = 0").first().n_convs == 2
    assert prefix_trie.trie(prefix_trie.rebuilt(prefix_trie.turns_of(frame.limit(0)))).count() == 0


def test_double_array():
    rng = random.Random(1)
    paths = sorted({tuple(rng.randrange(40) for _ in range(rng.randrange(7))) for _ in range(3000)})
    trie = prefix_trie._built([list(p) for p in paths])
    prefixes = {p[:d] for p in paths for d in range(len(p) + 1)}
    slots = {}
    for p in prefixes:
        node = 0
        for turn in p:
            node = trie.child(node, turn)
            assert node > 0
        assert slots.setdefault(node, p) == p
        for turn in range(40):
            assert (trie.child(node, turn) >= 0) == ((*p, turn) in prefixes)
    assert len(slots) == len(prefixes)


def test_query(spark):
    sf_dir = "/root/testdata/sf0.001"
    rows = [tuple(r) for r in spark.read.parquet(f"{sf_dir}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()]
    out = queries.op13_conversation_trie(spark, sf_dir)
    assert tuple(out.columns[:8]) == NAMES
    assert sorted([tuple(r[n] for n in NAMES) for r in out.collect()], key=str) == plain(rows)
