"""The pattern grammar, what it learns, and accuracy on held-out labels."""

import random
import zlib

from tessera.llm import queries, toxicity


def contexts(text):
    return [(w, c) for w, c, _ in toxicity.Scorer(toxicity.Model()).matches(text)]


def test_clauses_decide():
    assert contexts("What an idiot.") == [("idiot", "bare")]
    assert contexts("You are an idiot") == [("idiot", "aimed")]
    assert contexts("You are not an idiot") == [("idiot", "negated")]
    assert contexts("He said, she is an idiot. What a moron") == [("idiot", "reported"), ("moron", "bare")]
    assert contexts("not here, an idiot") == [("idiot", "bare")]  # a negation ends with its clause
    assert contexts("you go, idiot") == [("idiot", "bare")]
    assert contexts("I will hurt you. You I will hurt") == [("hurt", "bare"), ("hurt", "aimed")]
    assert contexts("idiotic words only") == []


def test_contractions_negate():
    for text in ("You aren't stupid.", "you arent stupid", "You don’t look stupid", "YOU DIDN'T seem stupid", "you cannot be stupid"):
        assert contexts(text) == [("stupid", "negated")], text
    # an apostrophe elsewhere parts words, as in l'idiot
    assert contexts("You're stupid") == [("stupid", "aimed")]
    assert contexts("tu es l'idiot") == [("idiot", "aimed")]
    assert toxicity.TOKEN.findall("ain't n't don'ts t' 't") == ["ain't", "n", "t", "don", "ts", "t", "t"]
    # a contraction is never learned nor weighed as an insult
    assert toxicity._features("don't") == set()
    model = toxicity.Model(stems={"stup": 3.0})
    assert toxicity.Scorer(model).weight("stupn't") == 0 and toxicity.Scorer(model).weight("stupor") == 3


def test_negation_and_report_lower_the_score():
    scorer = toxicity.Scorer(toxicity.Model())
    score = lambda text: scorer.score(scorer.matches(text))
    assert score("you are not an idiot") < score("an idiot") < score("you are an idiot")
    assert score("they said idiot") < score("an idiot")
    assert 0 < score("") < 0.5 and score("you idiot, you idiot, you idiot") <= 1


def test_composition_runs_its_parts():
    machine = toxicity.grammar()
    assert len(machine.start) == 4
    assert machine.step(machine.start, "unheard of") == (machine.start, None)


def test_learns_words_and_stems_by_text(spark):
    rng = random.Random(4)
    syllables = ["ba", "ne", "lo", "tri", "mu", "sha", "ke", "do"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(2, 5)))
    rows = []
    for i in range(600):
        text = [word() for _ in range(40)]
        toxic = i % 5 == 0
        if toxic:
            text[10] = rng.choice(["grubber", "zzorp" + word(), "zzorp" + word()])
            text[30] = "zzorp" + word()
        rows.append((i, " ".join(text), int(toxic)))
    rows += [(1000, None, 1), (1001, "x", None), (1002, "", 0)]
    labelled = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = toxicity.learn(labelled)
    tests = [(1, "ba ne zzorpfresh lo zzorpnew"), (2, "ba ne lo tri"), (3, None), (4, ""), (4, "")]
    docs = spark.createDataFrame(tests, "doc_id long, text string").selectExpr("*", "'old' as score")
    out = toxicity.score(docs, model)
    assert out.columns == ["doc_id", "text", "score", "predicted", "clauses"]
    got = {r.doc_id: r for r in out.collect()}
    assert [got[k].predicted for k in (1, 2, 3, 4)] == [1, 0, 0, 0]
    assert [c.word for c in got[1].clauses] == ["zzorpfresh", "zzorpnew"]
    assert toxicity.score(docs.limit(0), model).count() == 0
    assert toxicity.learn(labelled.limit(0)) == toxicity.Model()


def test_held_out_accuracy(spark):
    sf_dir = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf_dir}/labels.parquet").collect()}
    rows = queries.op2_toxicity(spark, sf_dir).collect()
    assert len(rows) == 1000 and all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in rows)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) for r in rows)
    right = [labels[r.doc_id] == r.predicted for r in rows if r.held_out and r.doc_id in labels]
    assert sum(right) / len(right) >= 0.95
