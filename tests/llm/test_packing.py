"""Packing against the tokenizers library and a plain best fit."""

import random
import zlib

import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessera.llm import packing, queries

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(PATH)
    made.encode_special_tokens = True
    return made


def numbers(data):
    return [int.from_bytes(data[i : i + 4], "little") for i in range(0, len(data), 4)]


def test_ids_are_those_of_the_library(library):
    rng = random.Random(5)
    own = packing.WordTokenizer(open(PATH, encoding="utf-8").read())
    letters = "aabeethñßÉÀ×÷ÿŸ\n\t\x0b  ̸́=.,;:!?'sll12(*-_İΣς日本🙂K"
    texts = ["", " ", "It's here.", "a.́b", "≠ x≠", "<|endoftext|> a<|startoftext|>b", "x" * 5000, "don't!?", "ΑΣ ΑΣ.", "9.,"]
    texts += ["".join(rng.choice(letters) for _ in range(rng.randrange(120))) for _ in range(3000)]
    for text in texts:
        assert numbers(own.encode(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)
    flat, bounds = own.encode_batch(pa.array([None, *texts, ""]).slice(1))
    for k, text in enumerate(texts):
        assert flat[bounds[k] : bounds[k + 1]].tolist() == numbers(own.encode(text))


def test_every_letter(library):
    own = packing.WordTokenizer(open(PATH, encoding="utf-8").read())
    points = [c for c in range(0x3000) if not 0xD800 <= c < 0xE000]
    for text in (f"{chr(c)} a{chr(c)}b. {chr(c)}." for c in points):
        assert numbers(own.encode(text)) == library.encode(text, add_special_tokens=False).ids, repr(text)


def test_bins_take_the_least_room_and_close_the_fullest():
    rng = random.Random(2)
    bins, open_, made = packing.OpenBins(50, 4), {}, 0
    for _ in range(5000):
        length = rng.randrange(1, 51)
        own, offset, closed, full = bins.place(length)
        rooms = [50 - used for used in open_.values() if 50 - used >= length]
        if rooms:
            assert 50 - open_[own] == min(rooms) and closed is None
        else:
            assert own == made
            made += 1
            if len(open_) == 4:
                assert open_[closed] == max(open_.values())
                del open_[closed]
            else:
                assert closed is None
        assert offset == open_.get(own, 0)
        open_[own] = offset + length
        assert full == (open_[own] == 50)
        if full:
            del open_[own]
        assert len(open_) <= 4


def test_the_fullest_closes():
    bins = packing.OpenBins(10, 2)
    assert [bins.place(n) for n in (6, 7)] == [(0, 0, None, False), (1, 0, None, False)]
    assert bins.place(8) == (2, 0, 1, False)


def checked(rows, most):
    by = {}
    for r in rows:
        by.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for own in by.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= most
    return len(by)


def test_pieces_and_sequences(spark, library):
    rng = random.Random(9)
    words = ["the", "of", "packing", "Éclair", "x1", "...", "tokens,"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.choice([0, 1, 5, 30, 90]))) for _ in range(400)]
    rows = [(k, t, 7) for k, t in enumerate(texts)] + [(None, None, 1), (3, "twice", 1), (3, "twice", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, bin int").repartition(40)
    packed = packing.pack(docs, PATH, most=64, bins=4)
    assert packed.columns == ["doc_id", "piece", "start", "length", "token_ids", "sequence_id", "offset"]
    got = packed.collect()
    expected = {}
    for k, t, _ in rows:
        ids = library.encode(t or "", add_special_tokens=False).ids + [0]
        for piece, start in enumerate(range(0, len(ids), 64)):
            entry = (k, piece, start, tuple(ids[start : start + 64]))
            expected[entry] = expected.get(entry, 0) + 1
    seen = {}
    for r in got:
        entry = (r.doc_id, r.piece, r.start, tuple(numbers(bytes(r.token_ids))))
        assert r.length == len(entry[3])
        seen[entry] = seen.get(entry, 0) + 1
    assert seen == expected
    n = checked(got, 64)
    assert n <= 1.1 * -(-sum(r.length for r in got) // 64)
    whole = {r.sequence_id: numbers(bytes(r.token_ids)) for r in packing.sequences(packed).collect()}
    for r in got:
        assert whole[r.sequence_id][r.offset : r.offset + r.length] == numbers(bytes(r.token_ids))


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(docs, PATH).count() == 0


def test_query_is_nearly_full(spark):
    sf_dir = "/root/testdata/sf0.001"
    out = queries.op11_best_fit_packing(spark, sf_dir).collect()
    assert checked(out, 2048) <= 1.02 * -(-sum(r.length for r in out) // 2048) + 1
    packed = packing.pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), PATH)
    digests = {(r.doc_id, r.piece): zlib.crc32(bytes(r.token_ids)) for r in packed.filter(F.col("doc_id") < 40).collect()}
    assert digests == {(r.doc_id, r.piece): r.ids_crc32 for r in out if r.doc_id < 40}
