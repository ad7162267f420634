"""Toxicity by a weighted finite-state pattern grammar over clauses.

Small transducers read a clause's symbols: insults and threats (with a weight each), words that
address somebody, negations and words of reported speech.  Composed, they are one machine whose state
remembers what the clause has shown so far and whose output scales the weight of every insult or
threat by its context: negated, reported, aimed at somebody, or bare.  A document's evidence is the sum
over its matched clauses, not over isolated words.

The insult lexicon, the weights of the contexts and the curve from evidence to score are learned from a
bounded sample of labelled documents.
"""

from __future__ import annotations

import math
import re
import uuid
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import SLICE, bounded, map_arrow, texts_of, worker_state, written

# Word lists of the grammar, in four languages: addressed persons, negations, reporting words, threats.
TARGET = frozenset("you your youre u thou du dich dir euch ihr dein tu te toi vous ton ti vosotros usted vuestro".split())
NEGATION = frozenset(
    "not no never cannot isnt arent wasnt werent dont doesnt didnt cant wont couldnt wouldnt shouldnt hasnt havent hadnt "
    "nicht kein keine nie pas jamais aucun nunca ningún tampoco".split()
)
REPORTED = frozenset(
    "said says told wrote claimed quoted quote reported sagte schrieb behauptete dit écrit déclaré dijo escribió afirmó".split()
)
THREAT = frozenset("kill hurt destroy beat punch stab shoot töte schlage tuer frapper matar golpear".split())
#: Insults the grammar knows before it has learned any, with their weight.
INSULTS = dict.fromkeys("idiot moron stupid scum loser trash worthless pathetic disgusting clown imbecile".split(), 2.0)

#: A word that ends in n't is one token, which negates.
TOKEN = re.compile(r"\w+n['’]t(?!\w)|\w+|[.!?;:,\n]")
APOSTROPHES = frozenset("'’")
#: Entries of a worker's tables before they are given on or forgotten.
HELD = 50_000
END = frozenset(".!?;:,\n")
STOP = frozenset(".!?\n")
STEMS = range(4, 7)
MOST_EVIDENCE = 30.0
CONTEXTS = ("bare", "aimed", "negated", "reported")
#: Where no data tell otherwise, the weight of a context.
PRIOR = {"bare": 1.0, "aimed": 1.5, "negated": 0.4, "reported": 0.5}


def _contracted(word: str) -> bool:
    return word[-2:-1] in APOSTROPHES


class Transducer:
    """A deterministic transducer: (state, symbol) to (state, output); unknown symbols keep the state."""

    def __init__(self, start, arcs: dict):
        self.start, self.arcs = start, arcs

    def step(self, state, symbol):
        return self.arcs.get((state, symbol), (state, None))


def compose(parts: dict[str, Transducer]) -> Transducer:
    """The machine that runs all parts on the same symbols; its output maps part names to outputs."""
    symbols = sorted({s for p in parts.values() for _, s in p.arcs})
    start = tuple(p.start for p in parts.values())
    arcs, todo, seen = {}, [start], {start}
    while todo:
        state = todo.pop()
        for symbol in symbols:
            steps = [p.step(own, symbol) for p, own in zip(parts.values(), state, strict=True)]
            then = tuple(s for s, _ in steps)
            arcs[state, symbol] = (then, {n: o for n, (_, o) in zip(parts, steps, strict=True) if o})
            if then not in seen:
                seen.add(then)
                todo.append(then)
    return Transducer(start, arcs)


def grammar() -> Transducer:
    """Symbols: insult, threat, target, negation, reported, other, clause, sentence."""
    hit = {("on", s): ("on", s) for s in ("insult", "threat")}
    negation = {(k, "negation"): (3, None) for k in range(4)}
    for k in range(1, 4):  # a negation reaches three words far and not beyond its clause
        negation[k, "other"] = negation[k, "target"] = (k - 1, None)
        negation[k, "clause"] = negation[k, "sentence"] = (0, None)
        negation[k, "insult"] = negation[k, "threat"] = (k, "negated")
    target = {(k, "target"): (1, None) for k in range(2)}
    target |= {(1, "clause"): (0, None), (1, "sentence"): (0, None)}
    target |= {(1, "insult"): (1, "aimed"), (1, "threat"): (1, "aimed")}
    reported = {(k, "reported"): (1, None) for k in range(2)} | {(1, "sentence"): (0, None)}
    reported |= {(1, "insult"): (1, "reported"), (1, "threat"): (1, "reported")}
    return compose(
        {
            "hit": Transducer("on", hit),
            "negation": Transducer(0, negation),
            "target": Transducer(0, target),
            "reported": Transducer(0, reported),
        }
    )


@dataclass
class Model:
    insults: dict[str, float] = field(default_factory=lambda: dict(INSULTS))
    stems: dict[str, float] = field(default_factory=dict)
    contexts: dict[str, float] = field(default_factory=lambda: dict(PRIOR))
    slope: float = 1.0
    bias: float = -3.0


class Scorer:
    """Scores texts under a model; words are looked up once per worker."""

    def __init__(self, model: Model):
        self.model, self.machine, self.known = model, grammar(), {}

    def weight(self, word: str) -> float:
        found = self.known.get(word)
        if found is None:
            m = self.model
            found = 0.0 if _contracted(word) else m.insults.get(word, 0.0) or max((m.stems.get(word[:k], 0.0) for k in STEMS if len(word) > k), default=0.0)
            if len(self.known) > HELD:
                self.known.clear()
            self.known[word] = found
        return found

    def matches(self, text: str) -> list[tuple[str, str, float]]:
        """(word, context, weight) of each matched insult or threat, in clauses read by the machine."""
        tokens = TOKEN.findall(text.lower())
        if not any(self.weight(w) or w in THREAT for w in set(tokens)):
            return []
        step, state, found = self.machine.step, self.machine.start, []
        for word in tokens:
            w = self.weight(word)
            symbol = (
                "insult" if w else "threat" if word in THREAT else
                ("sentence" if word in STOP else "clause") if word in END else
                "target" if word in TARGET else "negation" if word in NEGATION or _contracted(word) else
                "reported" if word in REPORTED else "other"
            )
            state, out = step(state, symbol)
            if out and "hit" in out:
                context = out.get("negation") or out.get("reported") or out.get("target") or "bare"
                # a threat counts where it is aimed at somebody
                found.append((word, context, w if symbol == "insult" else 1.0 if context == "aimed" else 0.0))
        return found

    def score(self, matches: list[tuple[str, str, float]]) -> float:
        evidence = sum(w * self.model.contexts[c] for _, c, w in matches)
        x = self.model.slope * min(evidence, MOST_EVIDENCE) + self.model.bias
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, x))))


def _features(text: str) -> set[str]:
    """Words as they are, stems with a leading '^'."""
    words = {w for w in TOKEN.findall(text.lower()) if len(w) > 2 and not _contracted(w)}
    return words | {"^" + w[:k] for w in words for k in STEMS if len(w) > k}


def _kin(text: str) -> str:
    """The least hash of the text's words: near copies mostly share it."""
    return min((xxhash.xxh3_64_hexdigest(w) for w in text.lower().split()), default="")


def _tally(batches: Iterator[pa.RecordBatch], wanted: frozenset[str] | None) -> Iterator[pa.RecordBatch]:
    """(feature, kin) of toxic texts, or counts of the wanted features in clean ones, added up in part.

    What a task holds is given on as soon as it has ``HELD`` entries.
    """
    counts: Counter = Counter()
    for whole in batches:
        for start in range(0, whole.num_rows, SLICE):
            batch = whole.slice(start, SLICE)
            for text in texts_of(batch):
                own = _features(text)
                if wanted is None:
                    kin = _kin(text)
                    counts.update((f, kin) for f in own)
                else:
                    counts.update((f, "") for f in own & wanted)
                if len(counts) >= HELD:
                    yield _entries(counts)
                    counts.clear()
    yield _entries(counts)


def _entries(counts: Counter) -> pa.RecordBatch:
    keys = list(counts)
    return pa.RecordBatch.from_arrays(
        [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
         pa.array([counts[k] for k in keys], pa.int64())],
        names=["feature", "kin", "n"],
    )


def learn(labelled: DataFrame, text: str = "text", label: str = "toxic", sample: int = 20_000, least: int = 5) -> Model:
    """A model from rows with a 0/1 label; about ``sample`` rows at most, chosen by a hash of the text.

    A word or stem enters the lexicon if at least ``least`` toxic texts that are no near copies of each
    other hold it and it is twenty times as frequent as in clean texts.  Terms are taken by how many toxic
    texts they explain, until each is explained three times over.  Rows with null label or text do not
    count; without toxic rows the model is the built-in one.
    """
    rows = labelled.filter(F.col(text).isNotNull() & F.col(label).isNotNull()).select(
        F.col(text).alias("text"), F.col(label).cast("int").alias("label")
    )
    n = rows.count()
    share = min(1.0, sample / max(1, n))
    # equal texts are chosen together
    rows = rows.filter(F.pmod(F.xxhash64("text"), F.lit(1 << 20)) < int(share * (1 << 20)))
    rows = written(rows, "toxicity-sample")
    kind = "feature string, kin string, n long"
    toxic, clean = rows.filter("label = 1"), rows.filter("label = 0")
    n_toxic, n_clean = toxic.count(), clean.count()
    if not n_toxic:
        return Model()
    seen = bounded(toxic).mapInArrow(lambda it: _tally(it, None), kind)
    support = seen.groupBy("feature").agg(F.countDistinct("kin").alias("kin"), F.sum("n").alias("n"))
    support = {r["feature"]: r["n"] for r in support.filter(F.col("kin") >= least).collect()}
    wanted = frozenset(support)
    in_clean = bounded(clean).mapInArrow(lambda it: _tally(it, wanted), kind).groupBy("feature").agg(F.sum("n").alias("n"))
    in_clean = {r["feature"]: r["n"] for r in in_clean.collect()}
    odds = {
        f: math.log((k + 0.5) / (n_toxic + 1)) - math.log((in_clean.get(f, 0) + 0.5) / (n_clean + 1))
        for f, k in support.items()
    }
    good = frozenset(f for f, o in odds.items() if o >= math.log(20))
    terms = _cover([r["f"] for r in bounded(toxic).mapInArrow(lambda it: _kept(it, good), "f array<string>").collect()], odds)
    model = Model()
    model.insults |= {f: min(odds[f], 6.0) for f in terms if f[0] != "^"}
    model.stems = {f[1:]: min(odds[f], 6.0) for f in terms if f[0] == "^"}
    return _calibrated(rows, model)


def _kept(batches: Iterator[pa.RecordBatch], good: frozenset[str]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        own = [sorted(_features(t) & good) for t in texts_of(batch)]
        yield pa.RecordBatch.from_arrays([pa.array(own, pa.list_(pa.string()))], names=["f"])


def _cover(texts: list[list[str]], odds: dict[str, float], times: int = 3, least: int = 3) -> list[str]:
    """Terms by how many texts they explain, each text up to ``times``; longer stems win ties."""
    holders: dict[str, list[int]] = {}
    for i, own in enumerate(texts):
        for f in own:
            holders.setdefault(f, []).append(i)
    need, chosen = [times] * len(texts), []
    while holders:
        open_ = {f: sum(need[i] > 0 for i in ids) for f, ids in holders.items()}
        best = max(open_, key=lambda f: (open_[f] * odds[f], len(f), f))
        if open_[best] < least:
            break
        chosen.append(best)
        for i in holders.pop(best):
            need[i] -= 1
        holders = {f: ids for f, ids in holders.items() if open_[f] >= least}
    return chosen


def _calibrated(rows: DataFrame, model: Model) -> Model:
    """Weights of contexts and the logistic curve, from the same sample."""
    scorer = Scorer(model)

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [scorer.matches(t) for t in texts_of(batch)]
        sums = [[sum(w for _, c, w in own if c == name) for name in CONTEXTS] for own in found]
        return pa.RecordBatch.from_arrays(
            [batch.column("label"), pa.array(sums, pa.list_(pa.float64()))], names=["label", "sums"]
        )

    got = map_arrow(rows, "label int, sums array<double>", over).collect()
    y = np.array([r["label"] for r in got], float)
    x = np.minimum(np.array([r["sums"] for r in got], float), MOST_EVIDENCE)
    prior = np.array([PRIOR[c] for c in CONTEXTS])
    weights = prior.copy()
    for k in range(1, len(CONTEXTS)):
        # how toxic texts are whose only matches stand in this context, against the same for bare ones
        only = (x[:, k] > 0) & (x.sum(axis=1) == x[:, k])
        if only.sum() >= 20:
            rate = (y[only].sum() + 1) / (only.sum() + 2)
            weights[k] = 1.0 if rate > 0.9 else max(0.1, rate) * prior[k]
    model.contexts = dict(zip(CONTEXTS, weights.tolist(), strict=True))
    evidence = np.minimum(x @ weights, MOST_EVIDENCE)
    # Newton steps for slope and bias with a slight pull to zero, which keeps separable samples finite
    beta = np.array([0.0, -2.0])
    design = np.c_[evidence, np.ones(len(y))]
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        gradient = design.T @ (y - p) - 0.01 * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + 0.01 * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        beta = beta + np.clip(step, -2, 2)
        if np.abs(step).max() < 1e-8:
            break
    if beta[0] > 0:
        model.slope, model.bias = float(beta[0]), float(beta[1])
    return model


def score(docs: DataFrame, model: Model, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with score (0 to 1), predicted (1 from 0.5 on) and clauses.

    clauses holds word and context of every match in text order.  Null and blank texts have no matches
    and the score of no evidence.  Columns of these names are replaced; repeated rows repeat their result.
    """
    rows = docs.drop("score", "predicted", "clauses")
    schema = StructType(list(rows.schema.fields))
    matched = rows.sparkSession.range(0).selectExpr("array(struct('' as word, '' as context)) as c").schema["c"].dataType
    schema = schema.add("score", "double").add("predicted", "integer").add("clauses", matched, True)
    columns = rows.columns
    name = f"toxicity {uuid.uuid4().hex}"
    clause = pa.list_(pa.struct([("word", pa.string()), ("context", pa.string())]))

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        scorer = worker_state(name, lambda: Scorer(model))
        matches = [scorer.matches(t) for t in texts_of(batch, text)]
        scores = [scorer.score(m) for m in matches]
        found = [[{"word": w, "context": c} for w, c, _ in m] for m in matches]
        made = [
            pa.array(scores, pa.float64()),
            pa.array([int(s >= 0.5) for s in scores], pa.int32()),
            pa.array(found, clause),
        ]
        return pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*columns, "score", "predicted", "clauses"])

    return map_arrow(rows, schema, over)
