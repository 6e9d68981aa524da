"""The registered queries of this package: each applies an operator, with production parameters, to its whole table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from twinleaf.llm.bpe import encode_digests
from twinleaf.llm.common import table
from twinleaf.llm.digests import fingerprints
from twinleaf.llm.licenses import license_labels
from twinleaf.llm.minhash import near_duplicates
from twinleaf.llm.mixing import mix_positions
from twinleaf.llm.quality import quality_scores
from twinleaf.llm.rules import quality_rules
from twinleaf.llm.secrets import secret_spans
from twinleaf.llm.sql import SQL
from twinleaf.llm.tokens import token_counts
from twinleaf.llm.urls import url_verdicts


def op1_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "documents"))


def tokenizer(name: str) -> str:
    """The place of a public tokenizer's file on this machine; it must be the same on the executors."""
    import public_tokenizers

    return public_tokenizers.path(name)


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_verdicts(table(spark, sf_dir, "pages"))


def op3_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts(table(spark, sf_dir, "documents"), tokenizer("word_bpe_49k.json"))


def op4_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_digests(table(spark, sf_dir, "documents"), tokenizer("byte_bpe_50k.json"))


def op5_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_scores(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


#: Target weights of the mix; sources that are not named have 1.
TARGET_WEIGHTS = {"src0": 4.0, "src1": 2.0, "src2": 2.0, "src3": 0.5}


def op6_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_positions(table(spark, sf_dir, "documents"), TARGET_WEIGHTS)


def op7_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality_rules(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_spans(table(spark, sf_dir, "documents"))


def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_labels(table(spark, sf_dir, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {f.__name__: f for f in (op1_minhash, op2_url_filter, op3_token_counts, op4_bpe, op5_quality_classifier, op6_source_mix, op7_quality_rules, op8_fingerprints, op9_secret_scan, op10_license_scan)}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
