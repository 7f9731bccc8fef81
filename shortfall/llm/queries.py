"""Registered queries of the operators and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall.llm import (
    balltree,
    bpe,
    decontaminate,
    html,
    jaccard,
    language,
    lm,
    mixing,
    quality,
    sharding,
    spelling,
    toxicity,
    urls,
)
from shortfall.llm.base import read

#: The rank file that op13 encodes with.
RANKS = "byte_bpe_multi_50k.tiktoken"


def op1_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    return language.language_id(read(spark, sf_dir, "documents"))


def op2_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.url_filter(spark, read(spark, sf_dir, "pages"))


def op3_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.jaccard_components(spark, read(spark, sf_dir, "documents"))


def op4_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.quality(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lm.language_model(spark, read(spark, sf_dir, "documents"))


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.extract(read(spark, sf_dir, "pages"))


def op8_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = mixing.mixing(spark, read(spark, sf_dir, "documents"))
    return rows.withColumn("target", F.round("target", 6)).withColumn("position", F.round("position", 6))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    return toxicity.toxicity(read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels"))


def op10_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.sharded(spark, read(spark, sf_dir, "documents"))


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(spark, read(spark, sf_dir, "documents"))


def op12_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return balltree.ranked(spark, read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    model = bpe.ByteBPE(bpe.read_ranks(public_tokenizers.path(RANKS)), public_tokenizers.PATTERN)
    return bpe.digests(bpe.encoded(read(spark, sf_dir, "documents"), model))


def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, sf_dir)


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    q.__name__: q
    for q in (
        op1_language_id,
        op2_url_filter,
        op3_jaccard_join,
        op4_quality_rules,
        op5_decontamination,
        op6_lm_scoring,
        op7_html_extraction,
        op8_mixing,
        op9_toxicity,
        op10_sharding,
        op11_spelling_variants,
        op12_ranked_search,
        op13_byte_bpe,
        pipeline,
    )
}
