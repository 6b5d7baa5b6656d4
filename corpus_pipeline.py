"""From raw documents to shuffled training shards, in five stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from spendtally.llm import decontaminate, mixing, neardup, quality, sharding
from spendtally.llm.common import cut, table, word_count

SHARDS = 16


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that a classifier learned from ``labels`` does not reject."""
    return quality.good_documents(docs, table(spark, sf_dir, "labels"))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by 5-word shingles at 0.8; documents without words stay."""
    return neardup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no test item of ``benchmark``."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as their source's target weight takes them, in training order.

    The last document that a source gives is left whole.
    """
    return mixing.training_order(docs, word_count(F.col("text"))).select(*[F.col(f"`{c}`") for c in docs.columns])


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in random order over 16 equal shards: the columns of documents, ``shard`` and ``slot``."""
    return sharding.shuffled_shards(docs, SHARDS, seed=20, row_bytes=sharding.text_bytes(F.col("text")) + 64)


STAGES = [
    ("quality classifier", quality_classifier),
    ("MinHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mix_sources),
    ("sharding", shard),
]
#: The classifier and the shuffle are beyond SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage keeps is written to the checkpoint folder before the next reads it."""
    docs = table(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs if i == 0 else cut(docs), sf_dir)
    return docs
