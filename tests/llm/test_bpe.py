"""Byte-level BPE against the tiktoken library."""

import random

import public_tokenizers
import pytest
import tiktoken

from tessera.llm import bpe
from tessera.llm.queries import RANKS

TOKENS = bpe.read_ranks(RANKS)


@pytest.fixture(scope="module")
def tokenizer():
    return bpe.Tokenizer(TOKENS, public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference():
    ranks = {t: i for i, t in enumerate(TOKENS)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def ids(data: bytes) -> list[int]:
    return [int.from_bytes(data[i : i + 4], "little") for i in range(0, len(data), 4)]


def same(tokenizer, reference, texts):
    for text, got in zip(texts, tokenizer.encode_batch(texts), strict=True):
        assert ids(got) == reference.encode_ordinary(text), repr(text[:80])
        assert tokenizer.decode(got) == text.encode()


def test_perfect_hash_holds_every_token_once(tokenizer):
    assert tokenizer.table.candidates(TOKENS) == list(range(len(TOKENS)))
    assert sorted(tokenizer.table.key_at.tolist()) == list(range(len(TOKENS)))


def test_every_character(tokenizer, reference):
    points = [c for c in range(0x110000) if not 0xD800 <= c < 0xE000]
    lines = ["".join(f"{chr(c)}a {chr(c)}1" for c in points[i : i + 200]) for i in range(0, len(points), 200)]
    same(tokenizer, reference, lines)


def test_texts(tokenizer, reference):
    rng = random.Random(7)
    letters = "aab eeth\n\t  'sll12.,!-_ßéñ日本🙂 　"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(300))) for _ in range(300)]
    same(tokenizer, reference, ["", " ", "\n\n  x", "<|endoftext|>", *texts])


def test_very_long_pretokens(tokenizer, reference):
    rng = random.Random(3)
    same(tokenizer, reference, ["a" * 20_000, "".join(rng.choice("thnedor") for _ in range(20_000)), " " * 5_000])


def test_operator_keeps_rows_and_columns(spark):
    rows = [(1, "Hello world", "x"), (1, "Hello world", "x"), (None, None, None), (2, "", "y")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN)
    out = bpe.decode(encoded, RANKS, public_tokenizers.PATTERN)
    assert out.columns == ["doc_id", "text", "token_ids", "n_tokens", "decoded"]
    got = [(r.doc_id, r.text, r.n_tokens, bytes(r.decoded)) for r in out.collect()]
    assert sorted(got, key=str) == sorted(
        [(1, "Hello world", 2, b"Hello world")] * 2 + [(None, None, 0, b""), (2, "", 0, b"")], key=str
    )
    assert bpe.encode(docs.limit(0), RANKS, public_tokenizers.PATTERN).count() == 0
