"""The secret scan against plain Python."""

import hashlib
import random
import re
import time

from pyspark.sql import functions as F

from tessera.llm import queries, secrets

KINDS = ("assign", "access", "hex")


def plain(text: str) -> dict[str, list[tuple[int, int]]]:
    text = text or ""
    form = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    return {
        "assign": [m.span() for m in re.finditer(form, text, re.I | re.A) if len(m[2]) >= 6],
        "access": [m.span() for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20],
        "hex": [m.span() for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24],
    }


def digest(found) -> str:
    spans = sorted((s, k, e) for k, kind in enumerate(KINDS) for s, e in found[kind])
    return hashlib.sha256(",".join(f"{KINDS[k]}:{s}:{e}" for s, k, e in spans).encode()).hexdigest()


def made(spark, texts):
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    return {r.doc_id: r for r in secrets.scan(docs).collect()}


def test_query_on_its_table(spark):
    sf_dir = "/root/testdata/sf0.001"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op10_secret_scan(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        found = plain(texts[r.doc_id])
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(len(found[k]) for k in KINDS)
        assert r.base_sha256 == digest(found)
        base = {f"{k}:{s}:{e}" for k in KINDS for s, e in found[k]}
        assert base <= set(r.spans.split(","))


def test_fixed_forms(spark):
    texts = [
        None, "", "token: a token: abcdefgh", "secret=token:abcdefgh", 'API_key" = "x.y=z/1', "PASSWORD=abcdef",
        "é🙂 token=abcdef", "AKIAAKIA" + "B" * 12, "AKIA" + "B" * 15, "a" * 24 + "g" + "0" * 23,
        "token=" + "a" * 40 + " passwd='123456'", "toKen=abcdef", "x" * 200_000 + "token=abcdef",
    ]
    got = made(spark, texts)
    for i, text in enumerate(texts):
        found = plain(text)
        for kind in KINDS:
            assert [(s.start, s.end) for s in got[i][kind]] == found[kind], (text or "")[:60]


def test_random_tokens_are_told_from_words(spark):
    rng = random.Random(5)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    words = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]
    long_words = ["".join(rng.choice(words) for _ in range(rng.randrange(10, 20))) for _ in range(2000)]
    keys = ["".join(rng.choice(b64) for _ in range(rng.randrange(32, 64))) for _ in range(40)]
    got = made(spark, [*long_words, *[f"see {k} there" for k in keys]])
    false = sum(len(got[i].random) for i in range(len(long_words)))
    hits = sum(
        [(s.start, s.end) for s in got[len(long_words) + i].random] == [(4, 4 + len(k))] for i, k in enumerate(keys)
    )
    assert false == 0 and hits >= 38


def test_columns_and_empty_table(spark):
    docs = spark.createDataFrame([(1, "x", 2)], "doc_id long, text string, hex int")
    assert secrets.scan(docs).columns == ["doc_id", "text", "assign", "access", "hex", "random"]
    assert secrets.scan(docs.limit(0)).count() == 0


def test_values_behind_names(spark):
    rng = random.Random(6)
    b64 = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/"
    words = ["th", "er", "on", "an", "re", "he", "in", "ed", "nd", "ha", "at", "en", "es", "of", "or"]
    long_words = ["".join(rng.choice(words) for _ in range(rng.randrange(10, 20))) for _ in range(2000)]
    forms = ["AWS_SECRET_ACCESS_KEY={}", "PRIVATE_KEY={}==", "auth={}", "https://a.example/p?v=1&sig={}&w=2", "Sig=={} {}"]
    keys = ["".join(rng.choice(b64) for _ in range(40)) for _ in range(50)]
    made_of = [(forms[i % len(forms)], k) for i, k in enumerate(keys)]
    got = made(spark, [*long_words, *[f.replace("{}", k) for f, k in made_of]])
    assert sum(len(got[i].random) for i in range(len(long_words))) == 0
    hits = 0
    for i, (form, k) in enumerate(made_of):
        text = form.replace("{}", k)
        pad = 2 if form.endswith("==") else 0
        want = [(m.start(), m.end() + pad) for m in re.finditer(re.escape(k), text)]
        hits += [(s.start, s.end) for s in got[len(long_words) + i].random] == want
    assert hits >= 46


def test_tokens_and_padding(spark):
    from pyspark.sql import functions as F

    a = "abcdefghij0123456789"
    want = {
        a: [(0, 20, a)],
        a + "=": [(0, 21, a)],
        a + "======": [(0, 26, a)],
        f"{a}={a}": [(0, 20, a), (21, 41, a)],
        f"{a}=={a}==": [(0, 20, a), (22, 44, a)],
        a[2:] + "==": [(0, 20, a[2:])],
        a[6:] + "======": [(0, 20, a[6:])],
        a[1:] + "=x": [],
        f"k={a}&l=": [(2, 22, a)],
        "=" * 40: [],
        "": [],
    }
    texts = spark.createDataFrame([(t,) for t in want], "text string")
    rows = texts.select("text", secrets.tokens(F.col("text")).alias("t")).collect()
    assert {r.text: [(t.start, t.end, t.body) for t in r.t] for r in rows} == want


def test_elements_apart_from_spans_equal_plain_loops(spark):
    rng = random.Random(8)
    rows = []
    for i in range(300):
        at, own = 0, []
        for _ in range(rng.randrange(12)):
            start = at + rng.randrange(6)
            at = start + 1 + rng.randrange(8)
            own.append((start, at))
        spans = [(a, 0, a + 1 + rng.randrange(9)) for a in (rng.randrange(70) for _ in range(rng.randrange(8)))]
        rows.append((i, own, spans))
    kind = "i int, own array<struct<start:int,end:int>>, spans array<struct<start:int,rank:int,end:int>>"
    df = spark.createDataFrame(rows, kind)
    got = {r.i: [tuple(x) for x in r.x] for r in df.select("i", secrets.apart(F.col("own"), F.col("spans")).alias("x")).collect()}
    assert got == {i: [c for c in own if not any(s[0] < c[1] and c[0] < s[2] for s in spans)] for i, own, spans in rows}


def test_time_grows_with_the_matches_of_a_text(spark):
    rng = random.Random(2)
    seconds = {}
    for n in (2_000, 16_000):
        text = " ".join(f"{rng.getrandbits(128):032x} token=abcdefgh" for _ in range(n))
        docs = spark.createDataFrame([(1, text)], "doc_id long, text string").cache()
        docs.count()
        start = time.monotonic()
        row = secrets.scan(docs).collect()[0]
        seconds[n] = time.monotonic() - start
        assert (len(row.hex), len(row.assign)) == (n, n)
        assert {k: [(s.start, s.end) for s in row[k]] for k in KINDS} == plain(text)
    assert seconds[16_000] < 12 * max(seconds[2_000], 2), seconds
