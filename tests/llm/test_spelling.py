"""Spelling variants against all pairs in plain Python."""

import random
import re
import zlib
from collections import Counter

import pytest

from tessera.llm import queries, spelling
from tessera.llm.common import LOWER, UPPER

TABLE = str.maketrans(UPPER, LOWER)


def plain_words(rows, least=7, least_count=2, noise=31):
    counts = Counter()
    for key, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(TABLE)
            h = zlib.crc32(f"{'' if key is None else key}:{run}".encode())
            if noise and h % noise == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            counts[run] += len(run) >= least
    return {w: n for w, n in counts.items() if n >= least_count and len(w) >= least}


def one_edit(a, b):
    if len(a) < len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    return len(a) == len(b) + 1 and any(a[:i] + a[i + 1 :] == b for i in range(len(a)))


def plain(counts, factor=10):
    close = {w: [v for v in counts if one_edit(w, v)] for w in counts}
    form = {}
    for w, own in close.items():
        best = min(own, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best is not None and counts[best] >= factor * counts[w] else None
    out = []
    for w in counts:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(close[w]), counts.get(form[w])))
    return sorted(out)


def rows_of(df):
    return sorted(tuple(r) for r in df.collect())


def vocabulary(rng, n, letters="abé", sizes=(7, 8, 9, 10)):
    counts = {}
    while len(counts) < n:
        word = "".join(rng.choice(letters) for _ in range(rng.choice(sizes)))
        counts[word] = rng.choice([2, 3, 20, 21, 200, 2000])
    return counts


@pytest.mark.parametrize("hot", [256, 8, 1])
def test_variants(spark, hot):
    counts = vocabulary(random.Random(hot), 700)
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variants(frame, hot=hot)) == plain(counts)


def test_a_chunk_that_all_words_share(spark):
    rng = random.Random(4)
    counts = {f"commonhead{w}": n for w, n in vocabulary(rng, 500, "abcd", (7, 8)).items()}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert rows_of(spelling.variants(frame, hot=20)) == plain(counts)


def test_each_pair_once(spark):
    frame = spark.createDataFrame([(w,) for w in ("aaaaaaa", "aaaaaaaa", "aaaabaaa", "aaaaaab", "bbbbbbb")], "word string")
    assert rows_of(spelling.near(frame)) == [
        ("aaaaaaa", "aaaaaab"), ("aaaaaaaa", "aaaaaaa"), ("aaaaaaaa", "aaaabaaa"), ("aaaabaaa", "aaaaaaa"),
    ]


def test_words(spark):
    rng = random.Random(8)
    pool = ["Variant", "VARIANT", "Éclairé", "éclairé", "naïveté×÷", "ab", "abcdefgh", "straße", "Straßen", "x" * 40]
    rows = [(k, " ".join(rng.choice(pool) + rng.choice(["", ".", "-", "1", "日"]) for _ in range(40))) for k in range(60)]
    rows += [(None, "Variant Variant"), (5, None), (6, ""), (7, "y" * 5000 + " " + "y" * 5000), (7, "variant"), (7, "variant")]
    docs = spark.createDataFrame([(k, t, 1) for k, t in rows], "doc_id long, text string, n int")
    assert dict(rows_of(spelling.words(docs, noise=31))) == plain_words(rows)
    assert dict(rows_of(spelling.words(docs, noise=None))) == plain_words(rows, noise=None)


def test_counts_are_handed_on(spark, monkeypatch):
    rows = [(k, f"wordnumber{chr(97 + k % 26)}{chr(97 + k % 7)} again again") for k in range(300)]
    monkeypatch.setattr(spelling, "HELD", 3)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    assert dict(rows_of(spelling.words(docs, noise=31))) == plain_words(rows)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert spelling.variants(spelling.words(docs)).count() == 0


def test_query(spark, tmp_path):
    rng = random.Random(3)
    pool = ["experience", "experiense", "experence", "separate", "seperate", "separates", "zzzzzzz", "Zzzzzzy", "langage", "language"]
    weights = [300, 5, 4, 200, 3, 15, 60, 3, 4, 100]
    rows = [(k, " ".join(rng.choices(pool, weights, k=50))) for k in range(80)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    got = rows_of(queries.op12_spelling_variants(spark, str(tmp_path)))
    assert got == plain(plain_words(rows))
    assert any(form for _, form, *_ in got)
