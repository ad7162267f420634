"""From documents to training tokens in five stages, each over all that the one before it kept."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.llm import bpe, exact_dedup, jaccard_join, queries, source_mix, toxicity
from tessera.llm.common import text_of, without
from tessera.plans.registry import table
from tessera.sources.checkpoints import checkpointed, working_folder


#: What the operators read; all other columns go past them under names of their own.
READ = ("doc_id", "text", "source")


def _aside(docs: DataFrame) -> DataFrame:
    """Columns that no operator reads, renamed, so that none of theirs takes the place of one."""
    return docs.select(*[F.col(f"`{c}`").alias(c if c in READ else f"__{i}") for i, c in enumerate(docs.columns)])


def _back(rows: DataFrame, docs: DataFrame) -> DataFrame:
    """The columns of ``docs`` again, by their own names."""
    return rows.select(*[F.col(c if c in READ else f"__{i}").alias(c) for i, c in enumerate(docs.columns)])


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the grammar does not take for toxic."""
    scored = toxicity.score(_aside(docs), queries.toxicity_model(spark, sf_dir, docs))
    return _back(scored.filter("predicted = 0"), docs)


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the document with the largest id."""
    return _back(exact_dedup.duplicates(_aside(docs)).filter("kept"), docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by the Jaccard join, over five words and from 0.8 on, the one of the smallest id."""
    joined = jaccard_join.join(docs).filter("component_id <> doc_id").select("doc_id")
    return without(docs, checkpointed(joined), "doc_id")


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document as often as its source's target takes it."""
    planned, _ = source_mix.plan(docs, queries.MIX_WEIGHTS, queries.MIX_SHARE, queries.MIX_EPOCHS, queries.MIX_SEED)
    size = source_mix.word_count(text_of("text"))
    place = source_mix.place_of(queries.MIX_SEED, F.col("doc_id"), size)
    taken = source_mix.copies(_aside(docs), planned, place, size).filter("copies > 0")
    return _back(taken.withColumn("copy", F.explode(F.sequence(F.lit(1), F.col("copies")))), docs)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids in place of texts."""
    return bpe.encode(docs, queries.RANKS, public_tokenizers.PATTERN).drop("text")


STAGES = [
    ("toxicity", reject_toxic),
    ("exact_dedup", drop_copies),
    ("ngram_jaccard_join", drop_near_copies),
    ("source_mix", mix_sources),
    ("byte_bpe", encode),
]

#: The learned first stage and the tokenizer are beyond SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents of a folder, each written and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = working_folder(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
