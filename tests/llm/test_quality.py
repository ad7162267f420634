"""Measures against plain Python, binomial bounds, and what certified cutoffs promise."""

import math
import random
import re
from collections import Counter

import pytest

from tessera.llm import quality, queries


def plain(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    lines = [x for x in text.split("\n") if re.search(r"[^\x20\x09-\x0D]", x)]
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    counts = Counter(windows)
    hit = {i + k for i, w in enumerate(windows) if counts[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for x in lines:
        dup += x in seen
        seen.add(x)
    return (len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(hit))


def test_measures():
    rng = random.Random(9)
    texts = ["", " \n\t", "a", "a b c d e a b c d e", "a a a a a a", "x\nx\n x\n\nx", "é# *日|<>$%&", "a\x0bb\x0cc\rd e f"]
    texts += [" ".join(rng.choice("abc") for _ in range(rng.randrange(80))).replace("a b", "a\nb") for _ in range(200)]
    for t in texts:
        assert quality.measures(t)[:5] == plain(t), repr(t)


@pytest.mark.parametrize("k,n,error", [(0, 100, 0.05), (3, 50, 0.01), (10, 1000, 0.001), (49, 50, 0.05)])
def test_binomial_bound(k, n, error):
    p = quality.binomial_upper(k, n, error)
    tail = sum(math.comb(n, i) * p**i * (1 - p) ** (n - i) for i in range(k + 1))
    assert tail == pytest.approx(error, rel=1e-6)


def test_bound_at_the_ends():
    assert quality.binomial_upper(0, 0, 0.05) == 1 == quality.binomial_upper(5, 5, 0.05)
    assert quality.binomial_upper(0, 10, 0.05) == pytest.approx(1 - 0.05**0.1)


def cells_of(rule, cells):
    return [cells.get(k, 0) for k in range(len(quality.RULES[rule][1]) + 1)]


def test_cutoffs_worth_their_price():
    def counts(good):
        return {(1, "symbols", 1): cells_of("symbols", good), (1, "symbols", 0): cells_of("symbols", {40: 200})}

    assert quality.wanted(counts({0: 2000})) == {(1, "symbols"): 20}
    assert quality.wanted(counts({0: 2000, 40: 100})) == {}
    assert quality.wanted({}) == {}


def test_paths_only_tighten():
    chosen = {(2, "symbols"): 7, (2, "upper"): 40, (1, "repeats"): 0}
    assert set(quality.path(chosen, 2)) == {"symbols", "upper"} and quality.path(chosen, 0) == {}
    for s in (1, 2):
        for rule, limits in quality.path(chosen, s).items():
            assert limits == sorted(limits, reverse=True)
            assert limits[0] == quality.RULES[rule][1][-1] and limits[-1] == quality.RULES[rule][1][chosen[s, rule]]


def test_only_certified_steps_stand():
    chosen = {(1, "symbols"): 3, (1, "upper"): 4}
    never = quality.STEPS + 1

    def rejected(cells):
        return {1: [cells.get(k, 0) for k in range(never + 1)]}

    whole = quality.certified(chosen, rejected({never: 2000}))
    assert whole == {(1, "symbols"): quality.RULES["symbols"][1][3], (1, "upper"): quality.RULES["upper"][1][4]}
    assert quality.certified(chosen, rejected({never: 100})) == {}  # too few labels for the bound
    assert quality.certified(chosen, rejected({0: 100, never: 2000})) == {}
    some = quality.certified(chosen, rejected({10: 100, never: 2000}))
    assert some == {(1, rule): limits[9] for rule, limits in quality.path(chosen, 1).items()}
    assert quality.certified(chosen, {}) == {} == quality.certified({}, rejected({never: 2000}))


def test_certified_risk_of_all_rules_together_holds_on_fresh_documents():
    """Six independent rules in one stratum; the risk is that of their union."""
    rng = random.Random(6)

    def cell(rule, shift):
        return max(0, min(len(quality.RULES[rule][1]), int(rng.gauss(shift, 5))))

    over = certificates = 0
    for _ in range(40):
        counts = {}
        for rule in quality.RULES:
            for label, shift in ((1, 8), (0, 22)):
                counts[0, rule, label] = [0] * (len(quality.RULES[rule][1]) + 1)
                for _ in range(600):
                    counts[0, rule, label][cell(rule, shift)] += 1
        chosen = quality.wanted(counts, price=1.0)
        paths = quality.path(chosen, 0)

        def first(cells, paths=paths):
            steps = [
                sum(quality.RULES[r][1].index(limit) >= cells[r] for limit in limits) for r, limits in paths.items()
            ]
            return min(steps)

        held = [0] * (quality.STEPS + 2)
        for _ in range(1500):
            held[first({r: cell(r, 8) for r in quality.RULES})] += 1
        found = quality.certified(chosen, {0: held})
        if found:
            certificates += 1
            places = {r: quality.RULES[r][1].index(limit) for (_, r), limit in found.items()}
            fresh = [{r: cell(r, 8) for r in places} for _ in range(2000)]
            over += sum(any(d[r] > k for r, k in places.items()) for d in fresh) / 2000 > 0.03
    assert certificates > 20 and over <= 2


def test_first_rejected_equals_plain_loops(spark):
    rng = random.Random(4)
    names = (*quality.BASE, *quality.MORE)
    rows = [
        (i, rng.randrange(2), *[rng.randrange(1, 1500 if n in ("n_words", "word_chars") else 300) for n in names])
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "doc_id long, label int, " + ", ".join(f"{n} long" for n in names))
    chosen = {(s, rule): (5 * s + k) % 40 for s in range(4) for k, rule in enumerate(quality.RULES) if (s + k) % 3}
    got = quality.first_rejected(df.withColumn("stratum", quality.stratum()), chosen, "label")
    expected = {}
    for _, label, *values in rows:
        if label == 1:
            d = dict(zip(names, values, strict=True))
            s = sum(d["n_words"] >= limit for limit in quality.STRATA)
            limits = quality.path(chosen, s)
            bad = (t for t in range(quality.STEPS + 1) if any(eval(quality.RULES[r][0], {}, d) > c[t] for r, c in limits.items()))
            expected.setdefault(s, [0] * (quality.STEPS + 2))[next(bad, quality.STEPS + 1)] += 1
    assert got == expected


def test_query_on_its_table(spark):
    sf_dir = "/root/testdata/sf0.01"
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf_dir}/documents.parquet").collect()}
    rows = queries.op7_quality_rules(spark, sf_dir).collect()
    assert len(rows) == len(texts)
    for r in rows:
        base = plain(texts[r.doc_id])
        assert tuple(r[n] for n in quality.BASE) == base
        assert r.base_failed == (base[0] < 10 or 100 * base[4] > 20 * base[0])
        assert not (r.base_failed and r.kept)


def test_odd_rows(spark):
    docs = spark.createDataFrame([(1, None, 5), (None, "w " * 30, 5), (2, "a b c d e f g h i j k", 5), (2, "x", 5)], "doc_id long, text string, kept int")
    labels = spark.createDataFrame([(1, 1), (1, 0), (2, None), (None, 1)], "doc_id long, quality int")
    out = quality.rated(docs, labels)
    assert out.columns == ["doc_id", *quality.BASE, *quality.MORE, "base_failed", "rules", "kept"]
    got = sorted(((r.doc_id, r.n_words, r.kept) for r in out.collect()), key=str)
    assert got == sorted([(1, 0, False), (None, 30, False), (2, 11, True), (2, 1, False)], key=str)
    assert quality.rated(docs.limit(0), labels.limit(0)).count() == 0
