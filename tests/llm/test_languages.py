"""Language mixtures on made texts and on held-out documents."""

import random
import zlib

import numpy as np
import pytest

from tessera.llm import languages, queries

SYLLABLES = {
    "aa": ["the", "and", "ing", "wh", "ou"], "bb": ["sch", "ung", "ein", "öf", "tz"], "cc": ["ció", "llo", "ña", "rra", "que"],
}


def text(lang, n, seed):
    rng = random.Random(seed)
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randrange(1, 4))) for _ in range(n))


def model(spark):
    rows = [(text(lang, 200, i), lang) for lang in SYLLABLES for i in range(20)]
    return languages.learn(spark.createDataFrame([*rows, (None, "aa"), ("x", None)], "text string, lang string"))


def test_trigrams_of_a_batch_are_those_of_each_text():
    texts = ["Ab c", "", "é1日本語", "  ", "xyz" * 50]
    cells, begins, has = languages.trigrams(texts)
    assert has.tolist() == [True, False, True, False, True]
    for i, t in enumerate(texts):
        alone, ends, _ = languages.trigrams([t])
        assert np.array_equal(alone, cells[begins[i] : begins[i + 1]]) and ends[-1] == len(t)


def test_proportions(spark):
    names, log_p = model(spark)
    assert names == ["aa", "bb", "cc"]
    half = text("aa", 200, 91) + " " + text("bb", 200, 92)
    third = " ".join(text(lang, 150, 93) for lang in SYLLABLES)
    got = languages.mixtures([text("bb", 100, 90), half, third, "", "123"], log_p)
    assert got[0].tolist() == [0, 1, 0]
    assert got[1][2] == 0 and 0.35 < got[1][0] < 0.65 and abs(got[1].sum() - 1) < 1e-9
    assert got[2].min() > 0.2
    assert not got[3:].any()
    # a text alone has the proportions that it has in a batch
    assert np.allclose(languages.mixtures([half], log_p)[0], got[1])


def test_a_set_takes_any_number_of_languages():
    rng = np.random.default_rng(5)
    letters = [np.array(list("abcdefghijklmnopqrstuvwxyz"))[rng.permutation(26)[:6]] for _ in range(7)]
    texts = [" ".join("".join(rng.choice(own, 5)) for _ in range(300)) for own in letters]
    counts = np.array([np.bincount(languages.trigrams([t])[0], minlength=languages.CELLS) for t in texts]) + 0.5
    log_p = np.log(counts / counts.sum(axis=1, keepdims=True)).astype(np.float32)
    got = languages.mixtures([" ".join(texts), texts[3]], log_p)
    assert got[0].min() > 0.08 and abs(got[0].sum() - 1) < 1e-9
    assert got[1][3] == 1
    # beside a text that goes on, another one's result is its own
    assert np.allclose(languages.mixtures([texts[3]], log_p)[0], got[1])


def test_rare_languages_keep_their_rows(spark):
    rows = [(text("aa", 5, i), "aa") for i in range(400)] + [(text("bb", 60, i), "bb") for i in range(3)]
    rows += [("ción llaña que rra", "cc")] * 300
    docs = spark.createDataFrame(rows, "text string, lang string")
    names, log_p = languages.learn(docs, sample=20)
    assert names == ["aa", "bb", "cc"]
    # all rows of the rare one count, some of the frequent ones
    assert np.allclose(log_p[1], languages.learn(docs.filter("lang = 'bb'"))[1][0])
    assert not np.allclose(log_p[0], languages.learn(docs.filter("lang = 'aa'"))[1][0])
    assert languages.mixtures(["ción llaña que rra"], log_p)[0][2] == 1


def test_too_many_languages_are_refused_before_any_table(spark):
    many = spark.range(600).selectExpr("'the and' AS text", "cast(id AS string) AS lang")
    with pytest.raises(ValueError):
        languages.learn(many)


def test_rows_and_columns(spark):
    docs = spark.createDataFrame(
        [(1, text("cc", 50, 1), 0.1), (2, None, 0.1), (3, "42 !", 0.1), (None, "the and", 0.1), (1, text("cc", 50, 1), 0.1)],
        "doc_id long, text string, score double",
    )
    out = languages.identify(docs, model(spark))
    assert out.columns == ["doc_id", "text", "languages", "lang_pred", "score"]
    rows = out.collect()
    assert sorted(r.lang_pred for r in rows) == ["aa", "cc", "cc", "und", "und"]
    assert all((r.score == 0) == (r.lang_pred == "und") and not (r.score == 0 and r.languages) for r in rows)
    assert languages.identify(docs.limit(0), model(spark)).count() == 0
    nothing = languages.learn(spark.createDataFrame([], "text string, lang string"))
    assert {r.lang_pred for r in languages.identify(docs, nothing).collect()} == {"und"}


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    lang = {r.doc_id: r.lang for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op4_language_id(spark, sf_dir).collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert len(rows) == 1000 and sum(lang[r.doc_id] == r.lang_pred for r in held) / len(held) >= 0.98
