"""Every stage takes effect on what the one before it kept."""

import public_tokenizers
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from tessera.llm import bpe, exact_dedup, jaccard_join, queries, toxicity

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def stages(spark, tmp_path_factory):
    folder = tmp_path_factory.mktemp("stages")
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    out = [docs]
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, out[-1], SF_DIR).write.parquet(f"{folder}/{name}")
        out.append(spark.read.parquet(f"{folder}/{name}"))
    return out


def ids(df):
    return sorted(r.doc_id for r in df.select("doc_id").collect())


def test_columns(stages):
    for df in stages[1:-1]:
        assert df.dtypes == stages[0].dtypes


def test_each_stage(spark, stages):
    docs, clean, single, apart, mixed, tokens = stages
    model = queries.toxicity_model(spark, SF_DIR, docs)
    assert ids(clean) == ids(toxicity.score(docs, model).filter("predicted = 0"))
    assert ids(single) == ids(exact_dedup.duplicates(clean).filter("kept"))
    lowered = [r.text.lower() for r in single.collect()]
    assert len(set(lowered)) == len(lowered)
    components = {r.doc_id: r.component_id for r in jaccard_join.join(single).collect()}
    assert ids(apart) == sorted(k for k, c in components.items() if k == c)
    sizes = {r.doc_id: (len(r.text.split()), r.source) for r in apart.collect()}
    counts: dict = {}
    for k in ids(mixed):
        counts[k] = counts.get(k, 0) + 1
    assert set(counts.values()) <= {1, 2} and set(counts) <= set(sizes)
    taken = sum(sizes[k][0] * n for k, n in counts.items())
    assert abs(taken / sum(n for n, _ in sizes.values()) - 1.5) < 0.05
    texts = {r.doc_id: r.text for r in mixed.collect()}
    vocabulary = bpe.read_ranks(queries.RANKS)
    tokenizer = bpe.Tokenizer(vocabulary, public_tokenizers.PATTERN)
    rows = tokens.collect()
    assert len(rows) == sum(counts.values())
    for r in rows:
        assert tokenizer.decode(bytes(r.token_ids)).decode() == texts[r.doc_id]


def test_run_gives_the_last_stage(spark, stages):
    assert ids(corpus_pipeline.run(spark, SF_DIR)) == ids(stages[-1])


def test_null_rows(spark):
    docs = spark.createDataFrame(
        [(None, None, None, None, None), (1, "", None, None, 0), (2, None, "en", "a", None), (3, "a b c d e f", "en", "a", 11)],
        "doc_id long, text string, lang string, source string, n_chars long",
    )
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, SF_DIR)
    assert {r.doc_id for r in docs.collect()} <= {None, 1, 2, 3}


def test_columns_named_like_those_of_operators(spark):
    """Extra columns of the input keep their values through every filtering stage."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet").limit(60)
    own = {"score": "s", "keep_id": "mine", "kept": "k", "target": "t", "copies": "c", "component_id": "x", "clauses": "z"}
    for name, value in own.items():
        docs = docs.withColumn(name, F.concat(F.lit(value), "doc_id"))
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, SF_DIR)
        for r in docs.collect():
            assert {n: r[n] for n in own} == {n: f"{v}{r.doc_id}" for n, v in own.items()}
