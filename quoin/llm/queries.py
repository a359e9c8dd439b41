"""The registered queries of this subpackage: each operator over its whole table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .fingerprint import fingerprints
from .language_id import language_id
from .line_dedup import line_dedup
from .ngram_join import ngram_join
from .quality_classifier import score_quality
from .quality_rules import quality_rules
from .sentencepiece_sampling import encode
from .shared import documents
from .source_mix import mix_sources
from .substring_dedup import substring_dedup
from .token_count import token_counts


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup(documents(spark, sf_dir), window=35).select("doc_id", "n_words", "n_removed", "kept_sha256")


def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup(documents(spark, sf_dir), min_docs=10, min_chars=1).select("doc_id", "n_lines", "n_dropped", F.sha2("kept_text", 256).alias("kept_sha256"))


def op3_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(documents(spark, sf_dir)).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


def op4_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language_id(documents(spark, sf_dir))


def op5_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_sources(documents(spark, sf_dir), weights=(5, 2, 1), share=1.5, epochs=2).select("doc_id", "size", "source_size", "target", "taken")


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return score_quality(documents(spark, sf_dir).select("doc_id", "text"), labels).select("doc_id", "held_out", "score", "predicted")


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir), size=5, percent=80)


def op7_ngram_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join(documents(spark, sf_dir), size=5, percent=80, with_links=True)


def op8_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(documents(spark, sf_dir))


def op9_token_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(documents(spark, sf_dir))


def op10_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode(documents(spark, sf_dir), with_ids=False).select("doc_id", "n_pieces", "ids_sha256", "lossless")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    own = (op1_substring_dedup, op2_line_dedup, op3_quality_rules, op4_language_id, op5_source_mix, op6_quality_classifier, op7_ngram_join, op7_ngram_links, op8_fingerprint, op9_token_count, op10_sentencepiece)
    return {f.__name__: f for f in own}
