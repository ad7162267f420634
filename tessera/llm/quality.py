"""Quality rules with risk-controlled cutoffs.

Each rule is a measure of a text and a cutoff above which the text is rejected.  Cutoffs are chosen
per length stratum on one part of the labelled documents and certified on the other: all rules of a
stratum tighten together, from their loosest cutoffs to the chosen ones, and a step stands only while
the exact binomial bound on the rate of good documents that any of the rules rejects stays below the
allowed risk.  The error probability is divided among the strata (Bonferroni); within one of them the
order of the tests is fixed, which needs no further correction.  What the base rules reject is given,
not chosen, and is not counted against the risk.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import map_arrow, remainder, texts_of
from tessera.sources.checkpoints import checkpointed

BASE = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
MORE = ("n_lines", "n_distinct_words", "n_upper")
SYMBOLS = "#*$%&|<>"
BLANKS = " \t\n\x0b\x0c\r"
#: Upper ends of the length strata, in words; the last is open.
STRATA = (100, 300, 1000)
#: Steps from the loosest cutoffs to the chosen ones.
STEPS = 40
_RATIOS = [round(0.01 * 1.12**k, 4) for k in range(41)]
#: Measure of a rule by name, and its cutoffs from strict to loose.
RULES: dict[str, tuple[str, list[float]]] = {
    "symbols": ("n_symbols / n_words", [round(0.01 * 1.15**k, 4) for k in range(44)]),
    "dup_lines": ("n_dup_lines / n_lines", _RATIOS),
    "repeats": ("n_repeat_words / n_words", _RATIOS),
    "few_words": ("1 - n_distinct_words / n_words", _RATIOS),
    "upper": ("n_upper / word_chars", _RATIOS),
    "long_words": ("word_chars / n_words", [round(4 * 1.05**k, 3) for k in range(60)]),
}


def repeated_words(words: list) -> int:
    """Words in 5-word windows that are found twice or more; windows are compared exactly."""
    n = len(words)
    if n < 6:
        return 0
    place: dict = {}
    ids = np.array([place.setdefault(w, len(place)) for w in words], np.int64)

    def ranked(pairs: np.ndarray) -> np.ndarray:
        return np.unique(pairs, return_inverse=True)[1].astype(np.int64)

    two = ranked(ids[:-1] * len(place) + ids[1:])
    four = ranked(two[:-2] * (two.max() + 1) + two[2:])
    five = four[:-1] * len(place) + ids[4:]
    _, inverse, counts = np.unique(five, return_inverse=True, return_counts=True)
    starts = np.flatnonzero(counts[inverse] > 1)
    if not len(starts):
        return 0
    steps = np.zeros(n + 1, np.int64)
    np.add.at(steps, starts, 1)
    np.add.at(steps, starts + 5, -1)
    return int((np.cumsum(steps[:-1]) > 0).sum())


def measures(text: str) -> tuple[int, ...]:
    """The values of ``BASE`` and ``MORE``; words are split at ASCII blanks."""
    words = text.encode().split()
    lines = [x for x in text.split("\n") if x.strip(BLANKS)]
    return (
        len(words),
        len(text) - sum(text.count(c) for c in BLANKS),
        sum(text.count(c) for c in SYMBOLS),
        len(lines) - len(set(lines)),
        repeated_words(words),
        len(lines),
        len(set(words)),
        sum(map(str.isupper, text)) if not text.islower() else 0,
    )


def measured(docs: DataFrame, text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with the measures as longs; null texts count as ''."""
    rows = docs.drop(*BASE, *MORE)
    schema = StructType(list(rows.schema.fields))
    for name in (*BASE, *MORE):
        schema = schema.add(name, "long")
    columns = rows.columns

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        values = np.array([measures(t) for t in texts_of(batch, text)], np.int64).reshape(-1, len(BASE) + len(MORE))
        return pa.RecordBatch.from_arrays(
            [*batch.columns, *[pa.array(v) for v in values.T]], names=[*columns, *BASE, *MORE]
        )

    return map_arrow(rows, schema, over)


def measure_of(formula: str) -> Column:
    """The value of a rule's quotient, 0 where nothing is divided by."""
    top, _, under = formula.partition(" / ")
    value = F.try_divide(F.col(top.removeprefix("1 - ")), F.col(under)).cast("double")
    return F.coalesce(1 - value if top.startswith("1 - ") else value, F.lit(0.0))


def base_failed() -> Column:
    return (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))


def stratum() -> Column:
    n = F.col("n_words")
    return sum(((n >= limit).cast("int") for limit in STRATA), F.lit(0))


def binomial_upper(failures: int, trials: int, error: float) -> float:
    """The exact upper confidence bound on a rate, by bisection of the binomial tail."""
    if trials == 0 or failures >= trials:
        return 1.0

    def tail(p: float) -> float:
        logs = [
            math.lgamma(trials + 1) - math.lgamma(k + 1) - math.lgamma(trials - k + 1)
            + k * math.log(p) + (trials - k) * math.log1p(-p)
            for k in range(failures + 1)
        ]
        top = max(logs)
        return math.exp(top) * sum(math.exp(x - top) for x in logs)

    low, high = failures / trials, 1.0
    for _ in range(60):
        middle = (low + high) / 2
        low, high = (middle, high) if 0 < middle < 1 and tail(middle) > error else (low, middle)
    return high


def halves(labelled: DataFrame, key: str) -> tuple[DataFrame, DataFrame]:
    """Two thirds of the labelled documents to choose cutoffs on, and the rest to certify them."""
    rows = labelled.withColumn("stratum", stratum())
    held = remainder(key, 3) == 0
    return rows.filter(~held), rows.filter(held)


def counted(chosen_on: DataFrame, label: str) -> dict[tuple, list[int]]:
    """Documents per (stratum, rule, label) and number of the rule's cutoffs exceeded; of fixed size."""
    cells = []
    for name, (formula, cutoffs) in RULES.items():
        value = measure_of(formula)
        cells.append(F.struct(F.lit(name).alias("rule"), passed(value, cutoffs).alias("cell")))
    flat = chosen_on.select("stratum", F.col(label).cast("int").alias("label"), F.explode(F.array(*cells)).alias("c"))
    out: dict[tuple, list[int]] = {}
    for r in flat.groupBy("stratum", "label", "c.rule", "c.cell").count().collect():
        row = out.setdefault((r["stratum"], r["rule"], r["label"]), [0] * (len(RULES[r["rule"]][1]) + 1))
        row[r["cell"]] += r["count"]
    return out


def passed(value: Column, cutoffs: list[float]) -> Column:
    return F.size(F.filter(F.array(*[F.lit(c) for c in cutoffs]), lambda c: value > c))


def wanted(counts: dict[tuple, list[int]], price: float = 50.0) -> dict[tuple[int, str], int]:
    """The place of the cutoff by (stratum, rule) that rejects most bad documents at ``price`` per good one.

    Of equal ones the middle; a rule that is not worth its price is left out.
    """
    found: dict[tuple[int, str], int] = {}
    for s in range(len(STRATA) + 1):
        for rule, (_, grid) in RULES.items():
            good, bad = (counts.get((s, rule, label), [0] * (len(grid) + 1)) for label in (1, 0))
            # beyond cutoff k are the documents of more than k cells
            value = [sum(bad[k + 1 :]) - price * sum(good[k + 1 :]) for k in range(len(grid))]
            if max(value) > 0:
                equal = [k for k, v in enumerate(value) if v == max(value)]
                found[s, rule] = equal[len(equal) // 2]
    return found


def path(chosen: dict[tuple[int, str], int], s: int) -> dict[str, list[float]]:
    """The cutoffs of a stratum's rules at each step, none of them ever looser than before."""
    own = {rule: k for (t, rule), k in chosen.items() if t == s}
    return {
        rule: [RULES[rule][1][last - (last - k) * step // STEPS] for step in range(STEPS + 1)]
        for rule, k in own.items()
        for last in [len(RULES[rule][1]) - 1]
    }


def first_rejected(held: DataFrame, chosen: dict[tuple[int, str], int], label: str) -> dict[int, list[int]]:
    """Good documents per stratum by the first step at which any rule rejects them; the last cell is never."""
    first = F.lit(STEPS + 1)
    for s in range(len(STRATA) + 1):
        steps = [STEPS + 1 - passed(measure_of(RULES[r][0]), limits) for r, limits in path(chosen, s).items()]
        if steps:
            first = F.when(F.col("stratum") == s, F.least(F.lit(STEPS + 1), *steps)).otherwise(first)
    out: dict[int, list[int]] = {}
    good = held.filter(F.col(label).cast("int") == 1).select("stratum", first.cast("int").alias("step"))
    for r in good.groupBy("stratum", "step").count().collect():
        out.setdefault(r["stratum"], [0] * (STEPS + 2))[r["step"]] += r["count"]
    return out


def certified(
    chosen: dict[tuple[int, str], int], rejected: dict[int, list[int]], risk: float = 0.02, error: float = 0.05
) -> dict[tuple[int, str], float]:
    """Cutoffs by (stratum, rule) at the last step that stands; without one a stratum's rules reject nothing.

    With probability 1 - ``error``, no stratum's rules together reject more than ``risk`` of its good documents.
    """
    found: dict[tuple[int, str], float] = {}
    for s in range(len(STRATA) + 1):
        cells = rejected.get(s, [0] * (STEPS + 2))
        for step in range(STEPS + 1):
            if binomial_upper(sum(cells[: step + 1]), sum(cells), error / (len(STRATA) + 1)) > risk:
                break
            found.update({(s, rule): limits[step] for rule, limits in path(chosen, s).items()})
    return found


def verdict(rows: DataFrame, found: dict[tuple[int, str], float]) -> DataFrame:
    """Measured rows with base_failed, rules (the names of those that reject) and kept."""
    fired = []
    for name, (formula, _) in RULES.items():
        value = measure_of(formula)
        limit = F.lit(None).cast("double")
        for (s, rule), cutoff in found.items():
            if rule == name:
                limit = F.when(stratum() == s, F.lit(cutoff)).otherwise(limit)
        fired.append(F.when(value > limit, F.lit(name)))
    rules = F.array_compact(F.array(*fired))
    return rows.withColumns({"base_failed": base_failed(), "rules": rules}).withColumn(
        "kept", ~F.col("base_failed") & (F.size("rules") == 0)
    )


def rated(
    docs: DataFrame, labels: DataFrame, key: str = "doc_id", text: str = "text", label: str = "quality", risk: float = 0.02
) -> DataFrame:
    """``docs`` without their text, with measures, base_failed, rules and kept.

    ``labels`` has the key and a 0/1 label; the least counts where a key has several, null does not count.
    Too few labels for a certificate mean that only the base rules reject.  Null texts count as '' and
    fail the base rules; an empty table gives an empty one.  Columns of the made names are replaced.
    """
    rows = checkpointed(measured(docs.drop("base_failed", "rules", "kept"), text).drop(text))
    good = labels.filter(F.col(label).isNotNull()).groupBy(key).agg(F.min(label).alias("__label"))
    labelled = rows.select(key, *BASE, *MORE).join(good, key)
    chosen_on, held = halves(labelled, key)
    chosen = wanted(counted(chosen_on, "__label"))
    return verdict(rows, certified(chosen, first_rejected(held, chosen, "__label"), risk))
