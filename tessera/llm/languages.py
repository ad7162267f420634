"""Language proportions of a document by expectation-maximisation over n-gram likelihoods.

Each language has a table of character-trigram log-probabilities.  A document is cut into short runs of
trigrams; a run's likelihood under a language is the product of its trigrams'.  EM over the runs
estimates the document's proportions; sets of one, two, ... languages are compared by penalised
likelihood, and the proportions under the chosen set are the result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tessera.llm.common import SLICE, map_arrow, texts_of

#: Cells of a language's table of hashed trigrams.
CELLS = 1 << 17
#: Trigrams of a run, and rounds of EM.
RUN, ROUNDS = 48, 12
#: A text's set of languages grows until so many larger sets in a row were no better.
PATIENCE = 3
#: Overlapping trigrams see every character three times; the penalty counts it once.
OVERLAP = 3
MOST_LANGUAGES = 512

_LETTER = np.zeros(0x110000, bool)


def _letters() -> np.ndarray:
    if not _LETTER[ord("a")]:
        _LETTER[:] = [chr(c).isalpha() for c in range(0x110000)]
    return _LETTER


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Cells of all trigrams of the texts end to end, where each text's begin, and whether it has a letter.

    Letters are lower-cased, all else counts as one blank; a text of n characters has n trigrams.
    """
    lower = [f" {t.lower()} " for t in texts]
    starts = np.r_[0, np.cumsum([len(t) for t in lower])]
    codes = np.frombuffer("".join(lower).encode("utf-32-le", "surrogatepass"), np.uint32)
    letter = _letters()[codes]
    codes = np.where(letter, codes, np.uint32(32))
    h = codes[:-2] * np.uint32(0x9E3779B1) + codes[1:-1] * np.uint32(0x85EBCA77) + codes[2:] * np.uint32(0xC2B2AE3D)
    h = (h ^ (h >> np.uint32(15))) * np.uint32(0x2C1B3C6D)
    cells = (h >> np.uint32(32 - CELLS.bit_length() + 1)).astype(np.int32)
    has = np.add.reduceat(letter, starts[:-1]) > 0
    # two cells across each border belong to no text
    inside = np.ones(len(codes) - 2, bool)
    borders = starts[1:-1]
    inside[borders - 1] = inside[borders - 2] = False
    counts = np.diff(starts) - 2
    return cells[inside], np.r_[0, np.cumsum(counts)], has


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", sample: int = 5_000) -> tuple[list[str], np.ndarray]:
    """Languages in order and their log-probabilities per cell, from rows with a language.

    About ``sample`` rows of each language at most are used, chosen by a hash of the text, and all rows of
    rarer languages; the text of the least hash is always among them, so no language is left without a table.
    Tables have a fixed size per language, and more than 512 languages are refused.  Counts are smoothed by a half.
    """
    rows = docs.filter(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(
        F.col(lang).cast("string").alias("lang"), F.col(text).alias("text")
    )
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 40))
    sizes = rows.groupBy("lang").agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("least"))
    sizes = sizes.limit(MOST_LANGUAGES + 1).collect()
    if len(sizes) > MOST_LANGUAGES:
        raise ValueError(f"more than {MOST_LANGUAGES} languages; their tables are sent to the workers")
    if not sizes:
        return [], np.zeros((0, CELLS), np.float32)
    last = {r["lang"]: max(r["least"], int(min(1.0, sample / r["n"]) * (1 << 40))) for r in sizes}
    limits = F.create_map(*[F.lit(x) for pair in last.items() for x in pair])
    picked = rows.filter(place <= limits[F.col("lang")])

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE):
                batch = whole.slice(start, SLICE)
                names, texts = batch.column("lang").to_pylist(), texts_of(batch)
                for name in set(names):
                    cells, _, _ = trigrams([t for t, own in zip(texts, names, strict=True) if own == name])
                    total.setdefault(name, np.zeros(CELLS, np.int64))
                    total[name] += np.bincount(cells, minlength=CELLS)
        yield from _packed(total)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[str, np.ndarray] = {}
        for batch in batches:
            for name, data in zip(batch.column("lang").to_pylist(), batch.column("counts").to_pylist(), strict=True):
                total[name] = total.get(name, 0) + np.frombuffer(data, np.int64)
        # half the bytes of counts, which the driver holds for all languages
        smooth = ((name, counts + 0.5) for name, counts in total.items())
        yield from _packed({name: np.log(c / c.sum()).astype(np.float32) for name, c in smooth})

    kind = "lang string, counts binary"
    tables = picked.mapInArrow(counted, kind).repartition("lang").mapInArrow(added, kind).collect()
    tables = sorted(tables, key=lambda r: r["lang"])
    return [r["lang"] for r in tables], np.stack([np.frombuffer(r["counts"], np.float32) for r in tables])


def _packed(total: dict[str, np.ndarray]) -> Iterator[pa.RecordBatch]:
    for name, counts in total.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([name], pa.string()), pa.array([counts.tobytes()], pa.binary())], names=["lang", "counts"]
        )


def _sum_by(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    return np.add.reduceat(values, starts, axis=0)


def _em(gain: np.ndarray, starts: np.ndarray, owner: np.ndarray, allowed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Proportions (document, language) over the allowed languages, and the log-likelihood per document."""
    share = allowed / allowed.sum(axis=1, keepdims=True)
    runs = np.diff(np.r_[starts, len(gain)])[:, None]
    for _ in range(ROUNDS):
        weight = gain * share[owner]
        total = weight.sum(axis=1, keepdims=True)
        share = _sum_by(weight / np.maximum(total, 1e-300), starts) / runs
    total = (gain * share[owner]).sum(axis=1)
    return share, _sum_by(np.log(np.maximum(total, 1e-300)), starts)


def mixtures(texts: list[str], log_p: np.ndarray) -> np.ndarray:
    """Proportions (text, language) under each text's chosen set; zero where a text has no letter."""
    languages = len(log_p)
    out = np.zeros((len(texts), languages))
    if not languages:
        return out
    cells, begins, has = trigrams(texts)
    good = np.flatnonzero(has & (np.diff(begins) > 0))
    if not len(good):
        return out
    # runs of RUN trigrams, the last of a text shorter
    counts = np.diff(begins)
    run_starts = [np.arange(begins[i], begins[i + 1], RUN) for i in range(len(texts)) if counts[i] > 0]
    with_runs = np.flatnonzero(counts > 0)
    per_text = np.array([len(r) for r in run_starts])
    where = np.concatenate(run_starts)
    logs = np.stack([np.add.reduceat(row[cells], where) for row in log_p], axis=1).astype(float)
    base = logs.max(axis=1)
    gain = np.exp(logs - base[:, None])
    starts = np.r_[0, np.cumsum(per_text)[:-1]]
    owner = np.repeat(np.arange(len(per_text)), per_text)
    offset = _sum_by(base, starts)
    full, _ = _em(gain, starts, owner, np.ones((len(per_text), languages)))
    order = np.argsort(-full, axis=1, kind="stable")
    best, chosen = np.full(len(per_text), -np.inf), full.copy()
    best_size = np.ones(len(per_text), int)
    for size in range(1, languages + 1):
        # only texts whose set still grows go on
        on = np.flatnonzero(best_size >= size - PATIENCE)
        if not len(on):
            break
        lengths = per_text[on]
        of_on = gain if len(on) == len(per_text) else gain[np.isin(owner, on)]
        allowed = np.zeros((len(on), languages))
        np.put_along_axis(allowed, order[on, :size], 1.0, axis=1)
        share, likelihood = _em(of_on, np.r_[0, np.cumsum(lengths)[:-1]], np.repeat(np.arange(len(on)), lengths), allowed)
        value = likelihood + offset[on] - OVERLAP * (size - 1) / 2 * np.log(np.maximum(2, counts[with_runs][on]))
        better = value > best[on]
        best[on[better]], best_size[on[better]] = value[better], size
        chosen[on[better]] = share[better]
    out[with_runs] = chosen
    out[~has] = 0
    return out


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], text: str = "text") -> DataFrame:
    """All rows and columns of ``docs`` with languages (name to proportion), lang_pred and score.

    lang_pred is the language of the largest proportion, the first by name of equal ones, score its
    proportion.  Null texts, texts without a letter, and all texts under an empty model are 'und' with score 0
    and no languages.  Columns of these names are replaced; repeated rows repeat their result.
    """
    rows = docs.drop("languages", "lang_pred", "score")
    names, log_p = model
    shared = rows.sparkSession.sparkContext.broadcast(log_p)
    schema = StructType(list(rows.schema.fields))
    for name, kind in (("languages", "map<string,double>"), ("lang_pred", "string"), ("score", "double")):
        schema = schema.add(name, _type(rows, kind), True)
    columns = rows.columns

    def over(batch: pa.RecordBatch) -> pa.RecordBatch:
        shares = mixtures(texts_of(batch, text), shared.value)
        found = [[(n, float(s)) for n, s in zip(names, own, strict=True) if s > 1e-6] for own in shares]
        top = [int(own.argmax()) if own.any() else -1 for own in shares] if names else [-1] * len(shares)
        made = [
            pa.array(found, pa.map_(pa.string(), pa.float64())),
            pa.array([names[k] if k >= 0 else "und" for k in top], pa.string()),
            pa.array([min(1.0, float(own[k])) if k >= 0 else 0.0 for k, own in zip(top, shares, strict=True)], pa.float64()),
        ]
        return pa.RecordBatch.from_arrays([*batch.columns, *made], names=[*columns, "languages", "lang_pred", "score"])

    return map_arrow(rows, schema, over)


def _type(df: DataFrame, kind: str):
    return df.sparkSession.range(0).select(F.lit(None).cast(kind).alias("x")).schema["x"].dataType
