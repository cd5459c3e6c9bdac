"""Training-corpus pipeline over ``documents``.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame that is written
as Parquet and read back as the next stage's docs. All stages but the last
return the columns of documents; the last adds shard and slot.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from daybook.llm import decontaminate, mix, shard, simhash, toxicity
from daybook.llm.common import read, saved


def reject_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score of 0.7 or more go."""
    return toxicity.without_toxic(docs, read(spark, sf_dir, "labels"))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash group stays: the one with the smallest doc_id."""
    return simhash.keep_one(docs, simhash.SHINGLE_WORDS, simhash.MAX_DISTANCE)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return decontaminate.without_benchmark(docs, read(spark, sf_dir, "benchmark"))


def mixed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of sources takes it."""
    return mix.resampled(docs)


def sharded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their shard and slot."""
    return shard.sharded(docs)


STAGES = [("toxicity", reject_toxic), ("simhash near-dedup", near_duplicates), ("decontamination", decontaminated),
          ("mixing", mixed), ("sharding", sharded)]

#: Trained scores, XXH64 fingerprints and hashed draws have no SQL form; tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = saved(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
