"""One named query per operator, and the SQL where SQL can say it."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import (
    bpe,
    exact_dedup,
    html_text,
    jaccard_join,
    languages,
    packing,
    prefix_trie,
    quality,
    secrets,
    source_mix,
    spelling,
    toxicity,
    warc,
)
from tessera.llm.common import remainder
from tessera.plans.registry import query, table

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


@query(None)
def op1_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_text.extract(table(spark, sf_dir, "pages")).select("page_id", "url", "text", "n_chars")


#: Labelled rows the toxicity model learns from.
TOXIC_SAMPLE = 20_000


def toxicity_model(spark: SparkSession, sf_dir: str, docs: DataFrame) -> toxicity.Model:
    """Learned from labelled rows of ``docs`` outside the held-out fifth.

    Labels are sampled before texts are looked up, to about ``TOXIC_SAMPLE`` rows whatever their
    number; so few go to every task, and no text is moved to meet its label.
    """
    labels = table(spark, sf_dir, "labels").filter("toxic IS NOT NULL").filter(remainder("doc_id", 5) != 0)
    share = min(1.0, TOXIC_SAMPLE / max(1, labels.count()))
    picked = labels.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 20)) < int(share * (1 << 20)))
    picked = picked.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    return toxicity.learn(docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id"), sample=TOXIC_SAMPLE)


@query(None)
def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity_model(spark, sf_dir, docs)
    scored = toxicity.score(docs, model)
    return scored.select("doc_id", (remainder("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


@query(
    f"""
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), '{UPPER}', '{UPPER.lower()}') AS t FROM documents),
     g AS (SELECT t, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY t)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(t) AS text_sha256
FROM d JOIN g USING (t)"""
)
def op3_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.marks(table(spark, sf_dir, "documents"))


@query(None)
def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = languages.learn(docs.filter(remainder("doc_id", 4) != 2))
    found = languages.identify(docs.drop("lang"), model)
    return found.select("doc_id", (remainder("doc_id", 4) == 2).alias("held_out"), "lang_pred", "score")


@query(None)
def op5_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), words=4, percent=85)


@query(None)
def op6_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    archived = warc.responses(table(spark, sf_dir, "pages").select("page_id", "url", "html"), "2024-01-01T00:00:00Z")
    return warc.derivatives(archived, keep=("page_id",))


@query(None)
def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    rated = quality.rated(docs, table(spark, sf_dir, "labels").select("doc_id", "quality"))
    return rated.select("doc_id", *quality.BASE, "base_failed", "kept")


#: Weights go round by source; the mix wants this share of all words.
MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED = [3, 1, 2], 1.5, 2, "mix"


def mix_sql(documents: str = "documents") -> str:
    """Common table expressions up to ``mixed`` (doc_id, size, source, source_size, target, copies)."""
    rounds = "".join(
        f"""
fit{r} AS (SELECT source, place, gap, sum(size) OVER (PARTITION BY source ORDER BY place) AS upto FROM open{r - 1}
           WHERE NOT more AND gap > 0 AND size > 0 AND size <= gap),
stop{r} AS (SELECT source, min(place) FILTER (upto > gap) AS stop FROM fit{r} GROUP BY source),
new{r} AS (SELECT o.*, NOT o.more AND o.gap > 0 AND o.size <= o.gap AND s.source_met AND (s.stop IS NULL OR o.place < s.stop) AS new
           FROM open{r - 1} o LEFT JOIN (SELECT *, true AS source_met FROM stop{r}) s ON o.source IS NOT DISTINCT FROM s.source),
open{r} AS (SELECT doc_id, size, place, source, source_size, target, whole, more OR coalesce(new, false) AS more,
                   gap - sum(CASE WHEN new THEN size ELSE 0 END) OVER (PARTITION BY source) AS gap FROM new{r}),"""
        for r in range(1, source_mix.ROUNDS + 1)
    )
    done = f"open{source_mix.ROUNDS}"
    return rf"""
counted AS (SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size FROM {documents}),
sized AS (SELECT *, md5('{MIX_SEED}:' || coalesce(doc_id::VARCHAR, '') || ':' || size) AS place FROM counted),
sources AS (SELECT source, sum(size)::BIGINT AS source_size FROM sized GROUP BY source),
weighed AS (SELECT *, [3, 1, 2][((row_number() OVER (ORDER BY source NULLS LAST)) - 1) % 3 + 1] AS weight,
                   source_size * {MIX_EPOCHS} AS cap FROM sources),
levels AS (SELECT *, (sum(source_size) OVER () * {MIX_SHARE}::DOUBLE - coalesce(sum(cap) OVER before, 0))::DOUBLE
                     / (sum(weight) OVER () - coalesce(sum(weight) OVER before, 0)) AS level
           FROM weighed
           WINDOW before AS (ORDER BY cap / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (SELECT *, least(cap::DOUBLE, coalesce(max(CASE WHEN level * weight <= cap THEN level END) OVER () * weight,
                                                  cap::DOUBLE)) AS target FROM levels),
parts AS (SELECT source, source_size, target,
                 CASE WHEN source_size > 0 THEN floor(target / source_size) ELSE 0 END::BIGINT AS whole FROM targets),
open0 AS (SELECT s.*, p.source_size, p.target, p.whole, false AS more, p.target - p.whole * p.source_size AS gap
          FROM sized s JOIN parts p ON s.source IS NOT DISTINCT FROM p.source),{rounds}
ends AS (SELECT source, place, abs(sum(size) - max(gap)) AS off FROM {done}
         WHERE NOT more AND abs(size - gap) < gap GROUP BY source, place HAVING abs(sum(size) - max(gap)) < max(gap)),
closing AS (SELECT source, arg_min(place, (off, place)) AS place FROM ends GROUP BY source),
mixed AS (SELECT m.doc_id, m.size, m.source, m.source_size, m.target,
                 m.whole + (m.more OR coalesce(m.place = c.place, false))::BIGINT AS copies
          FROM {done} m LEFT JOIN closing c ON m.source IS NOT DISTINCT FROM c.source)"""


@query(
    f"""
WITH {mix_sql()}
SELECT doc_id, size, source_size, target, size * copies AS taken FROM mixed"""
)
def op8_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    mixed = source_mix.mix(docs, MIX_WEIGHTS, MIX_SHARE, MIX_EPOCHS, MIX_SEED)
    return mixed.select(
        F.col("key").alias("doc_id"), "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken")
    )


#: The tokenizer of the encoding query; vocabularies are never copied here.
RANKS = public_tokenizers.path("byte_bpe_50k.tiktoken")


@query(None)
def op9_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    encoded = bpe.encode(docs, RANKS, public_tokenizers.PATTERN, decoded=True)
    return encoded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


@query(None)
def op10_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secrets.scan(docs)
    return found.select(
        "doc_id",
        *[F.size(kind).cast("long").alias(f"n_{kind}") for kind in secrets.KINDS[:3]],
        F.sha2(secrets.listed("assign", "access", "hex"), 256).alias("base_sha256"),
        secrets.listed(*secrets.KINDS).alias("spans"),
    )


#: The vocabulary of the packing query.
WORDS = public_tokenizers.path("word_bpe_49k.json")


@query(None)
def op11_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack(table(spark, sf_dir, "documents"), WORDS, most=2048, end=0)
    digest = F.crc32("token_ids").alias("ids_crc32")
    return packed.select("doc_id", "piece", "start", "length", digest, "sequence_id", "offset")


@query(None)
def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.words(table(spark, sf_dir, "documents"), noise=31))


@query(None)
def op13_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    listed = prefix_trie.turns_of(table(spark, sf_dir, "conversations"))
    return prefix_trie.trie(prefix_trie.rebuilt(listed))
