"""A corpus from raw documents to packed sequences, in five written stages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerline.llm import mixing, near_text, packing, surrogates, toxicity
from ledgerline.llm.common import documents, ship, written
from ledgerline.llm.queries import SURROGATE_KEY
from ledgerline.llm.tokens import default_vocabulary


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity models, fitted on these documents, don't reject."""
    ship(spark)
    return toxicity.without_toxic(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each class at five-word similarity 0.8."""
    ship(spark)
    return near_text.one_of_each_class(docs)


def replace_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents with surrogates in their texts."""
    ship(spark)
    replaced = surrogates.replace(docs, SURROGATE_KEY)
    return replaced.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The same documents in the order of the mix, partition after partition."""
    placed = mixing.mixed(docs)
    return (
        placed.repartitionByRange("mix_slot")
        .sortWithinPartitions("mix_slot", "mix_place")
        .select(docs.columns)
    )


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 tokens with little padding, numbered in the order of the mix.

    Files are not read in the order in which they were written, so the order is made
    anew from the documents: a place in the mix depends on nothing else.
    """
    ship(spark)
    ordered = mix_sources(spark, docs, sf_dir)
    return packing.sequences(packing.pack(ordered, default_vocabulary()))


STAGES = [
    ("toxicity", drop_toxic),
    ("near-copies", drop_near_copies),
    ("surrogates", replace_personal_data),
    ("mixing", mix_sources),
    ("packing", pack),
]

# Tokens and model scores are beyond SQL; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each written and read again."""
    docs = documents(spark, sf_dir)
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return docs
