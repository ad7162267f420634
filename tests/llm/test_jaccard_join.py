"""The Jaccard join against all pairs in plain Python."""

import random
import re

import numpy as np

from tessera.llm import graph, jaccard_join
from tessera.llm.common import LOWER, UPPER

TABLE = str.maketrans(UPPER, LOWER)


def plain(rows, words, percent):
    sets = []
    for _, text in rows:
        w = re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(TABLE))
        sets.append({tuple(w[i : i + words]) for i in range(max(1, len(w) - words + 1))} if w else set())
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            a, b = sets[i], sets[j]
            if rows[i][0] is None or rows[j][0] is None or not a or not b:
                continue
            both = len(a & b)
            if 100 * both >= percent * (len(a) + len(b) - both):
                parent[root(i)] = root(j)
    least = {}
    for i, (key, _) in enumerate(rows):
        if key is not None:
            least[root(i)] = min(least.get(root(i), key), key)
    out = [(key, len(s), None if key is None else least[root(i)]) for i, ((key, _), s) in enumerate(zip(rows, sets))]
    return sorted(out, key=str)


def got(spark, rows, words, percent):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = jaccard_join.join(docs, words, percent).collect()
    return sorted([(r.doc_id, r.n_shingles, r.component_id) for r in out], key=str)


def made(seed):
    """Chains of edits, groups of near copies, texts that share long passages, copies, short texts."""
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdef") for _ in range(rng.randrange(1, 5)))
    texts = []
    for _ in range(5):
        base = [word() for _ in range(rng.randrange(20, 160))]
        chain = base
        for _ in range(14):
            near = list(base if rng.random() < 0.6 else chain)
            for _ in range(rng.randrange(1, 5)):
                near[rng.randrange(len(near))] = word()
            chain = near
            texts.append(" ".join(near))
    passage = [word() for _ in range(60)]
    texts += [" ".join([*passage, *[word() for _ in range(rng.randrange(2, 30))]]) for _ in range(25)]
    texts += ["a b", "A B", "a", "", None, " \n", "a b c d", "x " * 300, "x " * 400, texts[3].upper(), texts[3], texts[40]]
    rows = [(int(k), t) for k, t in zip(np.random.default_rng(seed).permutation(len(texts)), texts)]
    return [*rows, (None, texts[3]), (None, None)]


def test_against_all_pairs(spark):
    for seed, words, percent in ((1, 4, 85), (2, 5, 80), (3, 3, 60)):
        rows = made(seed)
        assert got(spark, rows, words, percent) == plain(rows, words, percent)


def test_borders_of_the_threshold(spark):
    # 17 of 20 shingles in common is exactly 85 %
    base = [f"w{i}" for i in range(21)]
    rows = [(1, " ".join(base)), (2, " ".join(base[:20])), (3, " ".join(base[2:])), (4, " ".join(base[3:]))]
    assert got(spark, rows, 4, 85) == plain(rows, 4, 85)


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(40)] + [(100, 101), (101, 102)], "a long, b long")
    got = {r.node: r.component for r in graph.components(edges).collect()}
    assert got == {**dict.fromkeys(range(41), 0), 100: 100, 101: 100, 102: 100}


def test_empty_table_and_other_columns(spark):
    docs = spark.createDataFrame([(1, "a b c d e f", 3)], "doc_id long, text string, component_id int")
    assert [tuple(r) for r in jaccard_join.join(docs).collect()] == [(1, 2, 1)]
    assert jaccard_join.join(docs.limit(0)).count() == 0


def test_levels_of_counts_keep_their_order():
    counts = np.unique(np.concatenate([np.arange(70_000), 2 ** np.arange(17, 32), [2**32 - 1]])).astype(np.uint32)
    levels = jaccard_join._level(counts).astype(int)
    assert (np.diff(levels) >= 0).all() and levels[-1] < 2**16
    assert (levels[:32_768] == np.arange(32_768)).all() and levels[-1] > jaccard_join._level(np.array([2**20]))[0]
