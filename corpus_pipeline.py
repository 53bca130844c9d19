"""From raw documents to token ids: five stages, each by one operator.

Every stage takes ``(spark, docs, sf_dir)`` and returns the documents that its
predecessor kept, less or changed by its own decisions.  Stages keep the columns of
their input; the last one returns token ids.  Between stages the rows are written to
the shared folder and read again, so a stage that reads its input twice never repeats
the stages before it, and a lost executor repeats tasks of one stage only.

No SQL is given: perplexities, samples and token merges are beyond it.  The tests hold
the result against a version in plain Python.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.llm import bpe, decontaminate, kneser_ney, near_dedup, secret_scan
from tripstrata.sources.scratch import scratch_dir
from tripstrata.sources.writers import stage

VOCABULARY = "byte_bpe_50k.tiktoken"


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents whose perplexity is beyond the threshold of their language."""
    return kneser_ney.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def near_deduplication(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near-duplicates, the one with the least id."""
    return near_dedup.keep_one(docs)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that count as contaminated by the benchmark."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def secret_redaction(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces every secret by a mark; ``n_chars`` follows the text."""
    owner = F.split_part(F.col("source"), F.lit("/"), F.lit(1))
    redacted = secret_scan.redact_secrets(docs, F.col("source"), owner)
    if "n_chars" not in docs.columns:
        return redacted
    length = F.length("text").cast(docs.schema["n_chars"].dataType)
    return redacted.withColumn("n_chars", F.coalesce(length, "n_chars"))


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """``doc_id, n_tokens, ids, ids_sha256, decoded_sha256``; ids are packed 32-bit numbers."""
    vocabulary = bpe.share_vocabulary(spark, public_tokenizers.path(VOCABULARY))
    return bpe.encode_digests(docs, vocabulary, public_tokenizers.PATTERN, keep_ids=True)


STAGES = [
    ("quality_classifier", quality_classifier),
    ("near_deduplication", near_deduplication),
    ("benchmark_decontamination", benchmark_decontamination),
    ("secret_redaction", secret_redaction),
    ("byte_bpe", byte_bpe),
]
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the whole of ``documents``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    root = scratch_dir(spark, "pipeline")
    for name, function in STAGES[:-1]:
        docs = stage(function(spark, docs, sf_dir), f"{root}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
