"""Secret scan: fixed forms, and tokens that a battery of randomness tests tells from text.

All of it is in-row work on built-in expressions.  Fixed forms are patterns whose spans follow from
the lengths of what lies between the matches.  Other tokens, and the two sides of NAME=value, get an encoding by their characters;
uniformity of the alphabet (chi-squared), runs about the middle of the alphabet and serial
correlation are tested against a uniform source, and the token's likelihood under the corpus's own
characters gives a p-value for "text".  Per encoding and length class the Benjamini-Hochberg rule,
on a histogram of all p-values, decides which tokens are too unlike text; of these, the ones that the
battery takes for random are reported.
"""

from __future__ import annotations

import math
from functools import partial

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window as W

from tessera.functions.arrays import running
from tessera.functions.sqltext import let
from tessera.llm.common import text_of

# The forms that the scan's contract names.
ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]{24,}"

#: Kinds in the order in which spans of one start are listed.
KINDS = ("assign", "access", "hex", "random")

#: At least 20 characters with their padding; '=' between a name and a value ends the name, and is no part of it.
_LONG = "[A-Za-z0-9+/_-]"
_PADDING = "=++(?![A-Za-z0-9+/_=-])"
TOKEN = (
    rf"(?<!{_LONG})(?=[A-Za-z0-9+/_=-]{{20}}){_LONG}{{14,}}+"
    rf"(?:(?<={_LONG}{{20}})(?:{_PADDING})?+|{_PADDING})"
)
LETTERS = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/-_"
#: Alphabets in the order in which they are tried; a token takes the first that holds all of it.
ENCODINGS = {
    "decimal": ("^[0-9]+$", "0123456789"),
    "hex": ("^([0-9a-f]+|[0-9A-F]+)$", "0123456789abcdef"),
    "base32": ("^[A-Z2-7]+$", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"),
    "base64": ("^[A-Za-z0-9+/_-]+$", LETTERS),
}
CELLS = 8  # equal parts of the alphabet that the uniformity test counts
SPREAD = 2.0  # times the variance that independent characters would give text
STEP, TOP = 4, 800  # cells of the histogram over -ln p: a quarter wide, open above 200


def _plus(array: Column, step) -> Column:
    return F.aggregate(array, F.lit(0.0), step)


SPANS = "array<struct<start:int,rank:int,end:int>>"


def _matches(text: Column, pattern: str) -> Column:
    """(start, end, match) in code points of all matches, from running sums of lengths: linear in the text."""
    found, gaps = F.regexp_extract_all(text, F.lit(pattern), 0), F.split(text, pattern, -1)
    long = F.char_length
    # what follows the last match has no match of its own
    parts = F.zip_with(
        found, gaps, lambda m, gap: F.struct((long(gap) + long(m)).alias("step"), long(m).alias("n"), m.alias("match"))
    )
    whole = F.filter(parts, lambda m: m["match"].isNotNull())

    def placed(own: Column) -> Column:
        ends = running(own["step"], lambda one, other: one + other)
        return F.zip_with(
            own, ends, lambda m, end: F.struct((end - m["n"]).alias("start"), end.alias("end"), m["match"].alias("match"))
        )

    none = F.array().cast("array<struct<start:int,end:int,match:string>>")
    return F.when(text.rlike(pattern), let(whole, placed)).otherwise(none)


def _spans(matches: Column, rank: int) -> Column:
    return F.transform(
        matches, lambda m: F.struct(m["start"].alias("start"), F.lit(rank).alias("rank"), m["end"].alias("end"))
    )


def base_spans(text: Column) -> dict[str, Column]:
    values = F.regexp_extract_all(text, F.lit(ASSIGN), 2)
    assigned = F.zip_with(_matches(text, ASSIGN), values, lambda m, v: F.when(F.char_length(v) >= 6, m))
    return {
        "assign": F.when(
            text.rlike(ASSIGN), _spans(F.filter(assigned, lambda m: m.isNotNull()), 0)
        ).otherwise(F.array().cast(SPANS)),
        "access": F.when(
            F.contains(text, F.lit("AKIA")),
            _spans(F.filter(_matches(text, ACCESS), lambda m: m["end"] - m["start"] >= 20), 1),
        ).otherwise(F.array().cast(SPANS)),
        "hex": _spans(_matches(text, HEX), 2),
    }


def apart(listed: Column, spans: Column) -> Column:
    """The elements of ``listed`` (ordered by start) that overlap none of ``spans``.

    Both are sorted together once: an element is apart if all spans before it have ended and the
    next one begins behind it.
    """

    def merged(own: Column) -> Column:
        events = F.sort_array(
            F.concat(
                F.transform(
                    spans, lambda s: F.struct(s["start"].alias("start"), F.lit(0).alias("kind"), s["end"].alias("end"), F.lit(-1).alias("at"))
                ),
                F.transform(
                    own, lambda c, i: F.struct(c["start"].alias("start"), F.lit(1).alias("kind"), c["end"].alias("end"), i.alias("at"))
                ),
            )
        )

        def swept(rows: Column) -> Column:
            ended = running(F.transform(rows, lambda e: F.when(e["kind"] == 0, e["end"]).otherwise(0)), F.greatest)
            begins = F.transform(rows, lambda e: F.when(e["kind"] == 0, e["start"]).otherwise((1 << 31) - 1))
            following = F.reverse(running(F.reverse(begins), F.least))
            free = F.zip_with(
                F.zip_with(rows, ended, lambda e, top: F.struct(e.alias("e"), top.alias("top"))),
                following,
                lambda x, nxt: F.when(
                    (x["e"]["kind"] == 1) & (x["top"] <= x["e"]["start"]) & (nxt >= x["e"]["end"]), x["e"]["at"]
                ),
            )
            return F.transform(F.filter(free, lambda at: at.isNotNull()), lambda at: F.get(own, at))

        return let(events, swept)

    return F.when((F.size(spans) == 0) | (F.size(listed) == 0), listed).otherwise(let(listed, merged))


def _ln_tail(z: Column) -> Column:
    """ln of the upper tail of the normal distribution; relative error of the tail below 2e-7."""
    x = F.abs(z) / math.sqrt(2)
    t = 1 / (1 + x / 2)
    # The published rational fit of the complementary error function.
    fit = (-1.26551223, 1.00002368, 0.37409196, 0.09678418, -0.18628806, 0.27886807, -1.13520398, 1.48851587,
           -0.82215223, 0.17087277)
    poly = F.lit(fit[-1])
    for c in reversed(fit[:-1]):
        poly = poly * t + c
    ln = F.log(t) - x * x + poly - math.log(2)
    return F.when(z >= 0, ln).otherwise(F.log1p(-F.least(F.exp(ln), F.lit(0.5))))


def _chi2_ln_p(x: Column, df: int) -> Column:
    """ln of the chi-squared tail by the cube root of its mean, which is nearly normal."""
    spread = 2 / (9 * df)
    return _ln_tail((F.cbrt(x / df) - (1 - spread)) / math.sqrt(spread))


def tokens(text: Column) -> Column:
    """Array of (start, end, body, encoding) of all long tokens; body is without padding."""
    listed = _matches(text, TOKEN)

    def named(c: Column) -> Column:
        body = F.rtrim(c["match"], F.lit("="))
        encoding = F.lit(None).cast("string")
        for name, (pattern, _) in reversed(ENCODINGS.items()):
            encoding = F.when(body.rlike(pattern), F.lit(name)).otherwise(encoding)
        return F.struct(c["start"], c["end"], body.alias("body"), encoding.alias("encoding"))

    return F.filter(F.transform(listed, named), lambda c: c["encoding"].isNotNull() & (c["encoding"] != "decimal"))


def length_class(body: Column) -> Column:
    return F.floor(F.log2(F.char_length(body).cast("double"))).cast("int")


def battery(c: Column) -> Column:
    """ln of the least of three p-values, times three: small where the token is not random."""
    alphabet = F.lit(None).cast("string")
    for name, (_, letters) in ENCODINGS.items():
        alphabet = F.when(c["encoding"] == name, F.lit(letters)).otherwise(alphabet)
    body = F.when(c["encoding"] == "hex", F.lower(c["body"])).otherwise(c["body"])
    n = F.char_length(c["body"]).cast("double")
    places = F.transform(
        F.filter(F.split(body, ""), lambda ch: ch != ""),
        lambda ch: (F.position(ch, alphabet) - 0.5) / F.char_length(alphabet),
    )
    cells = F.transform(
        F.sequence(F.lit(0), F.lit(CELLS - 1)),
        lambda k: F.size(F.filter(places, lambda v: F.floor(v * CELLS) == k)).cast("double"),
    )
    chi = _plus(cells, lambda acc, k: acc + (k - n / CELLS) * (k - n / CELLS) / (n / CELLS))
    ups = _plus(places, lambda acc, v: acc + F.when(v > 0.5, 1.0).otherwise(0.0))
    pairs = F.zip_with(
        F.slice(places, 1, F.greatest(F.size(places) - 1, F.lit(0))),
        F.slice(places, 2, F.greatest(F.size(places) - 1, F.lit(0))),
        lambda a, b: F.struct(a.alias("a"), b.alias("b")),
    )
    runs = 1 + _plus(pairs, lambda acc, p: acc + F.when((p["a"] > 0.5) != (p["b"] > 0.5), 1.0).otherwise(0.0))
    downs = n - ups
    mean_runs = 1 + 2 * ups * downs / n
    var_runs = (mean_runs - 1) * (mean_runs - 2) / (n - 1)
    one_sided = (ups == 0) | (downs == 0)
    ln_runs = F.when(one_sided, -n * math.log(2)).otherwise(
        F.least(
            F.lit(0.0), math.log(2) + _ln_tail(F.abs(runs - mean_runs) / F.sqrt(F.greatest(var_runs, F.lit(1e-9))))
        )
    )
    # products about the middle; for a uniform source their sum has variance (n - 1) / 144
    serial = _plus(pairs, lambda acc, p: acc + (p["a"] - 0.5) * (p["b"] - 0.5)) * 12 / F.sqrt(n - 1)
    ln_serial = F.least(F.lit(0.0), math.log(2) + _ln_tail(F.abs(serial)))
    return F.least(_chi2_ln_p(chi, CELLS - 1), ln_runs, ln_serial) + math.log(3)


def _looked_up(table: Column, ch: Column) -> Column:
    return F.coalesce(F.try_element_at(table, ch), F.lit(0.0))


def ln_p_text(c: Column, frequency: dict[str, float]) -> Column:
    """ln of the probability that text of the corpus's characters looks as little like text as the token.

    All characters must fall in the encoding's alphabet, and their mean surprise against a uniform
    source must be as high as it is.
    """
    out = F.lit(0.0)
    for name, (_, letters) in ENCODINGS.items():
        own = set(letters) | (set(letters.upper()) if name == "hex" else set())
        inside = sum(frequency[ch] for ch in own)
        q = {ch: frequency[ch] / inside for ch in own}
        gain = {ch: -math.log(len(own) * q[ch]) for ch in own}
        mean = sum(q[ch] * gain[ch] for ch in own)
        sd = math.sqrt(SPREAD * sum(q[ch] * (gain[ch] - mean) ** 2 for ch in own))
        table = F.create_map(*[F.lit(v) for ch in sorted(own) for v in (ch, gain[ch])])
        n = F.char_length(c["body"]).cast("double")
        gains = F.transform(F.split(c["body"], ""), partial(_looked_up, table))
        total = _plus(gains, lambda acc, g: acc + g)
        ln = n * math.log(min(1.0, inside)) + _ln_tail((total - n * mean) / (sd * F.sqrt(n)))
        out = F.when(c["encoding"] == name, ln).otherwise(out)
    return out


def character_frequencies(docs: DataFrame, text: str) -> dict[str, float]:
    """Shares of the 66 token characters in all long tokens, smoothed by one."""
    bodies = docs.select(F.explode(tokens(text_of(text))).alias("c")).select("c.body")
    counted = bodies.select(F.explode(F.split("body", "")).alias("ch")).groupBy("ch").count()
    counts = {r["ch"]: r["count"] for r in counted.filter(F.col("ch").isin(list(LETTERS))).collect()}
    total = sum(counts.values()) + len(LETTERS)
    return {ch: (counts.get(ch, 0) + 1) / total for ch in LETTERS}


def thresholds(docs: DataFrame, text: str, frequency: dict[str, float], rate: float) -> dict[str, int]:
    """Per encoding and length class the histogram cell from which on tokens are discoveries at ``rate``."""
    c = docs.select(F.explode(tokens(text_of(text))).alias("c"))
    cell = F.least(F.floor(-ln_p_text(F.col("c"), frequency) * STEP), F.lit(TOP))
    named = F.concat_ws(":", F.col("c.encoding"), length_class(F.col("c.body")).cast("string"))
    cells = c.select(named.alias("class"), cell.alias("cell")).groupBy("class", "cell").count()
    own = W.partitionBy("class")
    as_low = F.sum("count").over(own.orderBy(F.desc("cell")))
    ranked = cells.withColumn("as_low", as_low).withColumn("m", F.sum("count").over(own))
    passing = ranked.filter(F.exp(-F.col("cell") / STEP) <= F.col("as_low") / F.col("m") * rate)
    return {r["class"]: r["cell"] for r in passing.groupBy("class").agg(F.min("cell").alias("cell")).collect()}


def scan(docs: DataFrame, text: str = "text", rate: float = 1e-4, least_random: float = 1e-3) -> DataFrame:
    """All rows and columns of ``docs`` with the arrays assign, access, hex and random of their spans.

    A span is (start, rank, end) in code points, end exclusive, rank the place of its kind in
    ``KINDS``.  ``rate`` is the false-discovery rate per class, ``least_random`` the p-value below
    which the battery takes a token for not random.  A random span never touches one of a fixed
    form.  Null counts as '' and has no spans; columns of these four names are replaced.
    """
    rows = docs.drop(*KINDS)
    frequency = character_frequencies(rows, text)
    cut = thresholds(rows, text, frequency, rate)
    fixed = rows.withColumns(base_spans(text_of(text)))
    table = F.create_map(*[F.lit(v) for k in sorted(cut) for v in (k, cut[k])]) if cut else None

    def found(c: Column) -> Column:
        named = F.concat_ws(":", c["encoding"], length_class(c["body"]).cast("string"))
        cell = F.least(F.floor(-ln_p_text(c, frequency) * STEP), F.lit(TOP))
        return (cell >= F.try_element_at(table, named)) & (battery(c) >= math.log(least_random))

    if table is None:
        random = F.array().cast(SPANS)
    else:
        spans = F.concat("assign", "access", "hex")
        kept = F.filter(let(tokens(text_of(text)), lambda own: apart(own, spans)), found)
        random = F.transform(
            kept, lambda c: F.struct(c["start"].alias("start"), F.lit(3).alias("rank"), c["end"].alias("end"))
        )
    return fixed.withColumn("random", random)


def listed(*kinds: str) -> Column:
    """The spans of some kinds as kind:start:end, by start, then kind, comma-joined."""
    names = F.array(*[F.lit(k) for k in KINDS])
    ordered = F.array_sort(F.concat(*kinds))
    return F.array_join(
        F.transform(
            ordered, lambda s: F.concat_ws(":", F.get(names, s["rank"]), s["start"].cast("string"), s["end"].cast("string"))
        ),
        ",",
    )
