"""The corpus pipeline: language, quality, near duplicates, benchmark passages, token ids.

Each stage is ``(spark, docs, sf_dir) -> DataFrame`` and works on all that the one before it kept. All but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from readframe.llm import bpe, decontaminate, jaccard, langid, quality
from readframe.llm.common import stored, table


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that are rejected: without letters, or far from every language of the labelled rows."""
    return langid.keep(docs, langid.fit(docs))


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops texts that fail the base test or are probably bad."""
    return quality.keep(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the first document of each group of linked ones: five-word shingles, similarity 0.8 or more."""
    return jaccard.keep_first(docs, percent=80, words=5)


def benchmark_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts passages of the benchmark out of texts and drops texts that are mostly such passages."""
    kept = decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))
    return kept.withColumn("n_chars", F.length("text").cast(kept.schema["n_chars"].dataType)).select(docs.columns)


def token_ids(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Encodes every text: ``doc_id, n_tokens, ids, decoded_sha256``."""
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    coded = bpe.round_trip(docs, path, public_tokenizers.PATTERN)
    return coded.select("doc_id", "n_tokens", "ids", F.sha2("decoded", 256).alias("decoded_sha256"))


STAGES = [
    ("language", language),
    ("quality_rules", quality_rules),
    ("near_duplicates", near_duplicates),
    ("benchmark_passages", benchmark_passages),
    ("token_ids", token_ids),
]

# A trained classifier, a fitted model and a byte-pair encoder are not SQL; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
