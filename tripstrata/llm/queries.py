"""The operators of this subpackage over the whole of their tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripstrata.llm import (
    bpe,
    decontaminate,
    kneser_ney,
    language_id,
    licenses,
    near_dedup,
    periodic_runs,
    pii,
    prefix_trie,
    quality_rules,
    secret_scan,
    suffix_dedup,
    token_counts,
)
from tripstrata.llm.sql import ORACLE as ORACLE
from tripstrata.sources.scratch import scratch_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def secret_frequency(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sources are the repositories; the part before a slash is their owner."""
    owner = F.split_part(F.col("source"), F.lit("/"), F.lit(1))
    return secret_scan.scan_secrets(_table(spark, sf_dir, "documents"), F.col("source"), owner)


def near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.classes(_table(spark, sf_dir, "documents")).select("doc_id", "class_id")


def language_model_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return kneser_ney.classify(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")).drop("text_key")


def benchmark_windows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.find_windows(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return found.drop("items")


def cached_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(
        _table(spark, sf_dir, "documents"),
        public_tokenizers.path("word_bpe_49k.json"),
        scratch_dir(spark, "token-cache"),
    )


def page_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id.identify(_table(spark, sf_dir, "pages"), _table(spark, sf_dir, "documents"))


def risk_controlled_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules.quality_rules(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def license_templates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.scan_licenses(_table(spark, sf_dir, "documents"))


def repeated_passages(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = suffix_dedup.drop_repeats(_table(spark, sf_dir, "documents"))
    return left.select(
        "doc_id",
        "n_bytes",
        "n_removed",
        "n_spans",
        F.sha2("kept", 256).alias("kept_sha256"),
        (F.col("n_bytes") - F.col("n_removed")).alias("n_kept"),
        (F.col("n_removed") > 0).alias("has_repeats"),
        "n_shared_words",
        (F.col("n_shared_words") > 0).alias("shares_passage"),
    )


def byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = bpe.share_vocabulary(spark, public_tokenizers.path("byte_bpe_50k.tiktoken"))
    return bpe.encode_digests(_table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)


def periodic_word_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    rebuilt = docs.select("doc_id", periodic_runs.repeated_tails("text", "doc_id").alias("text"))
    best = periodic_runs.strongest("runs")
    start, length, period = (best.getField(name) for name in ("start", "length", "period"))
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", *[r.getField(f).cast("string") for f in ("start", "length", "period")]), F.lit("\n")))
    return periodic_runs.find_runs(rebuilt).select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        start.alias("start"),
        length.alias("length"),
        period.alias("period"),
        F.floor(1000 * length / period).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
        "n_words",
    )


def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.scan_pii(_table(spark, sf_dir, "documents"))
    base = pii.of_kinds("spans", *pii.BASE)
    return found.select(
        "doc_id",
        *[F.size(pii.of_kinds("spans", kind)).cast("long").alias(f"n_{kind}") for kind in pii.BASE],
        F.sha2(pii.listed(base), 256).alias("base_sha256"),
        pii.listed(F.col("spans")).alias("spans"),
    )


def conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    turns = prefix_trie.number_turns(_table(spark, sf_dir, "conversations"))
    return prefix_trie.build_trie(prefix_trie.share_heads(turns))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_secret_scan": secret_frequency,
    "op2_near_dedup": near_duplicates,
    "op3_quality_classifier": language_model_quality,
    "op4_benchmark_decontamination": benchmark_windows,
    "op5_token_counts": cached_token_counts,
    "op6_language_id": page_languages,
    "op7_quality_rules": risk_controlled_rules,
    "op8_license_scan": license_templates,
    "op9_suffix_dedup": repeated_passages,
    "op10_byte_bpe": byte_bpe,
    "op11_periodic_runs": periodic_word_runs,
    "op12_pii": personal_data,
    "op13_conversation_trie": conversation_trie,
}
