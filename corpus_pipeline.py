"""A training corpus from raw documents, stage by stage.

Each stage reads the documents its predecessor wrote to the shared folder, so a lost
executor costs at most the stage at hand. All stages but the last return the columns of
the documents they are given.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from matchstats.llm.decontamination import without_passages
from matchstats.llm.mixing import mix
from matchstats.llm.quality import accepted, fit_quality
from matchstats.llm.queries import SHARDS
from matchstats.llm.sharding import shuffle_into_shards
from matchstats.llm.simhash import RADIUS, SHINGLE_WORDS, one_of_each
from matchstats.llm.tables import read_table, written


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts; it learns from labels of these."""
    return accepted(docs, fit_quality(docs, read_table(spark, sf_dir, "labels")))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near-duplicates, the document with the least id.

    Documents are near-duplicates where SimHash fingerprints of four-word shingles differ
    in at most four bits, by a chain of such pairs.
    """
    return one_of_each(docs, radius=RADIUS, size=SHINGLE_WORDS)


def decontaminate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no passage of a benchmark item."""
    return without_passages(docs, read_table(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents repeated or left out, so that sources come near their target weights."""
    return mix(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All rows in random order, with shard and slot."""
    return shuffle_into_shards(docs, SHARDS)


STAGES = [
    ("quality", keep_quality),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", decontaminate),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: Trained models and seeded draws have no SQL form; tests hold the stages to brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
