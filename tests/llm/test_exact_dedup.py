"""Exact duplicates against plain Python."""

import hashlib
import random
import re

from tessera.llm import exact_dedup, queries
from tessera.llm.common import LOWER, UPPER

TABLE = str.maketrans(UPPER, LOWER)


def plain(rows):
    """rows of (doc_id, text) to sorted (doc_id, keep_id, size, kept, digest)."""
    groups = {}
    for key, text in rows:
        groups.setdefault((text or "").translate(TABLE), []).append(key)
    out = []
    for key, text in rows:
        norm = (text or "").translate(TABLE)
        keys = [k for k in groups[norm] if k is not None]
        keep = max(keys) if keys else None
        out.append((key, keep, len(groups[norm]), key == keep, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


def got(spark, rows):
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = exact_dedup.duplicates(docs)
    names = ("doc_id", "keep_id", "group_size", "kept", "text_sha256")
    return sorted([tuple(r[n] for n in names) for r in out.collect()], key=str)


def test_groups(spark):
    rng = random.Random(1)
    long = "".join(rng.choice("aBcé \n日") for _ in range(60_000))
    rows = [
        (1, "Abc"), (2, "aBC"), (3, "abd"), (4, None), (5, ""), (6, "É"), (7, "é"), (8, long), (9, long.translate(TABLE)),
        (10, long + "x"), (11, "y" + long), (None, "abc"), (None, "z"), (None, "Z"), (12, " "), (13, "Abc"), (13, "Abc"),
    ]
    assert got(spark, rows) == plain(rows)


def test_many_copies(spark):
    rows = [(i, "The same text" if i % 3 else f"text {i // 6}") for i in range(3000)]
    assert got(spark, rows) == plain(rows)


def test_chunks_are_whole_and_content_defined(spark):
    rng = random.Random(2)
    text = "".join(rng.choice("etaoin shrdlu") for _ in range(50_000))
    docs = spark.createDataFrame([(text,), ("insert" + text,), ("",)], "text string")
    cut = [r[0] for r in docs.select(exact_dedup.chunks(docs["text"])).collect()]
    assert ["".join(c) for c in cut] == [text, "insert" + text, ""]
    assert len(set(cut[0]) & set(cut[1])) >= len(cut[0]) - 3
    assert all(len(c) <= exact_dedup.MOST for own in cut for c in own)


def test_a_seed_that_collides_is_not_taken(spark, monkeypatch):
    cut = spark.createDataFrame([("a",), ("b",), ("a",)], "c string")
    honest = exact_dedup.identifier
    weak = lambda chunk, seed: honest(chunk if seed else chunk.substr(2, 1), seed)
    monkeypatch.setattr(exact_dedup, "identifier", weak)
    assert exact_dedup.verified_seed(cut, "c") == 1


def test_boundaries_have_a_pattern_over_bytes():
    assert re.fullmatch(exact_dedup.boundary_pattern().replace("\\z", "\\Z"), "x" * 600)


def test_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x", "old", 7)], "doc_id long, text string, kept string, size int")
    out = exact_dedup.duplicates(docs)
    assert out.columns == ["doc_id", "text", "size", "keep_id", "group_size", "kept", "text_sha256"]
    assert exact_dedup.duplicates(docs.limit(0)).count() == 0


def test_marks_cut_no_text_again(spark):
    rows = [(1, "Abc"), (2, "aBC"), (3, None), (4, ""), (None, "abc"), (None, "z"), (5, "y" * 20_000), (5, "y" * 20_000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    out = exact_dedup.marks(docs)
    assert out.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]
    assert sorted([tuple(r) for r in out.collect()], key=str) == plain(rows)
    assert exact_dedup.marks(docs.limit(0)).count() == 0
    query = queries.op3_exact_dedup(spark, "/root/testdata/sf0.001")
    assert "regexp_extract_all" not in query._jdf.queryExecution().executedPlan().toString()
