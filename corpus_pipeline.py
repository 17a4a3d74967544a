"""A training corpus from ``documents``: five stages, each by one of the operators in
``featurekit.llm``; every stage's result is written and is the next one's input.

Every stage takes (spark, docs, sf_dir) and works on all of ``docs``; all but the last
return the columns of ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from featurekit.llm import decontam, jaccard, mixing, sharding, toxicity
from featurekit.llm.common import read, written


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents scored 0.7 or more by the toxicity model go; it is trained on the labelled
    documents among ``docs``."""
    return toxicity.clean_documents(docs, read(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document (smallest doc_id) of each group whose 5-word shingles have a Jaccard
    similarity of 0.8 or more."""
    return jaccard.representatives(docs, n=5, percent=80)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a window of a benchmark item go."""
    return decontam.clean_documents(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The mix of sources by weight: documents cut to the words taken, a row per pass."""
    return mixing.mixed_documents(docs)


def shard(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The rows in random order over 16 shards."""
    return sharding.external_shuffle(docs, n_shards=16)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_duplicates", drop_near_duplicates),
    ("decontamination", drop_contaminated),
    ("mixing", mix_sources),
    ("sharding", shard),
]

#: The first stage is a trained model: no SQL expresses it.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"corpus-{name}")
    return docs


QUERIES = {"pipeline": run}
ORACLES: dict[str, str] = {} if ORACLE_SQL is None else {"pipeline": ORACLE_SQL}
