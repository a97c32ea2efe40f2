"""Registered queries of the training-data operators, and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from .collocations import COLLOCATION_SQL, collocation_report
from .common import table
from .embeddings import EMBEDDING_SQL, embedding_report
from .licenses import license_report
from .line_dedup import LINE_DEDUP_SQL, line_dedup_report
from .mixing import MIX_SQL, mix_report
from .packed_ids import packed_ids_report
from .packing import packing_report
from .quality import quality_report
from .repetition import repetition_report
from .simhash import simhash_report
from .token_counts import token_count_report
from .toxicity import toxicity_report
from .variants import variant_report


def tokenizer(name: str) -> str:
    """Path of a public vocabulary file; the package that holds them is found at run time."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op2_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing_report(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_count_report(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op4_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_report(table(spark, sf_dir, "documents"))


def op5_packed_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packed_ids_report(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op6_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_report(table(spark, sf_dir, "documents"))


def op7_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_report(table(spark, sf_dir, "documents"))


def op8_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_report(table(spark, sf_dir, "embeddings"))


def op9_repetition_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition_report(table(spark, sf_dir, "documents"))


def op10_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup_report(table(spark, sf_dir, "documents"))


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op12_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variant_report(table(spark, sf_dir, "documents"))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocation_report(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f for f in (op1_toxicity, op2_best_fit_packing, op3_token_counts, op4_license_scan,
                            op5_packed_ids, op6_curriculum_mix, op7_simhash_dedup, op8_embedding_dedup,
                            op9_repetition_rules, op10_line_dedup, op11_quality,
                            op12_spelling_variants, op13_collocations)
}

SQL: dict[str, str] = {"op6_curriculum_mix": MIX_SQL, "op8_embedding_dedup": EMBEDDING_SQL,
                       "op10_line_dedup": LINE_DEDUP_SQL, "op13_collocations": COLLOCATION_SQL}
