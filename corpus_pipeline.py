"""A training corpus from ``documents``: five stages, each one of the document operators.

Every stage but the last returns the columns of its input; each is written
to the shared scratch folder and read again by the next.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ridelake.llm import decontaminate, langid, mixing, near_dup, sharding
from ridelake.llm.common import stored, table


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language the network recognises."""
    return langid.recognised(docs, langid.train_filter(docs))


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group."""
    return near_dup.keep_one(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without benchmark passages."""
    return decontaminate.clean_documents(docs, table(spark, sf_dir, "benchmark"))


def mixing_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.mixed_documents(docs)


def sharding_slots(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with their virtual slot, shard and map version."""
    return sharding.assign(docs)


STAGES = [
    ("language_id", language_id),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing_sources", mixing_sources),
    ("sharding", sharding_slots),
]

# no SQL counterpart: a trained network decides the first stage
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
