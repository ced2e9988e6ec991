"""Training-data pipeline: quality, toxicity, exact dedup, SimHash near-dedup, packing.

Each stage reads all its predecessor kept, and what it drops stays dropped. Stages
hand over Parquet tables in the shared folder, so a lost executor costs one stage.

Every stage but the last returns the columns of its input, whatever else they are named.
A null text counts as empty, a missing doc_id is a value like any other, repeated rows
are rows of their own until a dedup stage drops them, and empty tables give empty tables.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapelake.llm import exact_dedup, packing, quality, simhash, toxicity
from tapelake.workspace import materialize


def keep_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose grade is likely to be 1 or more, by a model of the labelled rows.

    Without labelled documents of two grades nothing is rejected.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return quality.select_quality(docs, quality.train(docs, labels))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the model of the labelled rows does not score as toxic.

    Without labelled documents of both kinds nothing is rejected.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.drop_toxic(docs, toxicity.train(docs, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents equal after lower-casing A-Z, the one with the largest doc_id."""
    return exact_dedup.drop_exact_duplicates(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked by SimHash, the one with the smallest doc_id."""
    return simhash.drop_near_duplicates(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents with their places in sequences of 1,024 tokens."""
    return packing.packed_digests(docs)


STAGES = [
    ("quality", keep_quality),
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("simhash_near_dedup", drop_near_copies),
    ("best_fit_packing", pack),
]

# The classifiers and the tokenizer are beyond SQL; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
