"""The corpus pipeline: documents through five of the training-data operators, each stage written and read again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from mediasieve.llm import decontaminate, mix_sources, near_copies, quality, shard, simhash_dedup
from mediasieve.llm.common import settle, table


def accept(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier doesn't reject."""
    return quality.accepted(docs, table(spark, sf_dir, "labels"))


def deduplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near duplicates: by SimHash, segments, the grid join and the check by bits; and by five-word shingles at similarity 0.8, most of which differ in more bits than that join allows."""
    return near_copies.keep_one(docs, found=simhash_dedup.simhash_components(docs))


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.clean(docs, table(spark, sf_dir, "benchmark"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources: documents as often as it takes them."""
    return mix_sources.take(docs)


def deal(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with shard and slot."""
    return shard.sharded(docs, ["doc_id"])


STAGES = [("quality", accept), ("near_duplicates", deduplicate), ("decontamination", decontaminated), ("mixing", mix), ("sharding", deal)]
#: Fingerprints, classifiers and draws can't be expressed in SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = settle(docs)
    return docs
