"""The corpus pipeline: documents to shards of training data, stage by stage."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shortfall.llm import decontaminate, jaccard, language, mixing, sharding
from shortfall.llm.base import Store, crc_mod, read


def keep_identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is identified; rejected ones go."""
    model = language.train(docs, crc_mod(F.col("doc_id"), 3) != 1)
    found = language.identify(docs, model)
    return found.filter("not _language.rejected").select(*[f"`{c}`" for c in docs.columns])


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group that links join."""
    return jaccard.first_of_each(spark, docs)


def drop_leaked(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a passage of the benchmark."""
    bench = decontaminate.load(read(spark, sf_dir, "benchmark"))
    found = decontaminate.find_leaks(docs, bench)
    return found.filter(F.size("_leaks") == 0).select(*[f"`{c}`" for c in docs.columns])


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix takes them, in training order, with their position in it."""
    return mixing.positioned(spark, docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard of each remaining row and its place there, in training order."""
    return sharding.sharded(spark, docs)


STAGES = [
    ("language ID", keep_identified),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_leaked),
    ("mixing sources to target weights", mix),
    ("sharding", shard),
]

#: Language ID and decontamination are beyond SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to documents; each result is written and read again."""
    store = Store(spark, "pipeline")
    docs = read(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = store.put(stage(spark, docs, sf_dir))
    return docs
