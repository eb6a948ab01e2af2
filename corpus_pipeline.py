"""A training-corpus pipeline of five stages over ``documents``, each calling one operator.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; it is written as Parquet in the shared checkpoint
folder and read again as the next stage's docs, so a lost executor costs at most the stage at hand.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from mailposture.llm import mixing, ordinal_quality, rendezvous, simhash, string_tiling
from mailposture.llm.common import ensure_checkpoint_dir, table

#: Shards of the last stage.
SHARDS = 24


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal quality model rejects go."""
    model = ordinal_quality.fit(ordinal_quality.graded(docs, table(spark, sf_dir, "labels")))
    return ordinal_quality.score(docs, model, prefix="_").filter("_kept").select(docs.columns)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents alike in their 5-word shingles (Jaccard similarity 0.8 or more) the first stays."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go."""
    return string_tiling.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it: not at all, or up to three times."""
    return mixing.repeat(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents with their shard and their slot in it."""
    return rendezvous.assign(docs, "doc_id", [1.0] * SHARDS)


STAGES = [
    ("quality classifier", quality),
    ("SimHash near-dedup", near_dedup),
    ("benchmark decontamination", decontamination),
    ("mixing sources to target weights", mixture),
    ("sharding", shards),
]

#: The classifier is fitted and the tiles are greedy: SQL cannot express these stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result is read from the last stage's files."""
    ensure_checkpoint_dir(spark)
    folder = f"{spark.sparkContext.getCheckpointDir()}/corpus-{uuid.uuid4().hex}"
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        stage(spark, docs, sf_dir).write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
