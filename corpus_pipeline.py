"""From raw documents to packed training sequences, one operator a stage.

Each stage takes (spark, docs, sf_dir) and its result is written and read again as the next one's docs.
Stages but the last return the columns of ``documents``, whatever else the table has; rows without an id are kept.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cadence.llm import exact, jaccard, mixing, packing, toxicity
from cadence.sources.staging import shared_folder


def clean_of_toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity score below the threshold, in one pass over the texts."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, labels)


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each group of equal texts."""
    return exact.keep_first(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of texts that share four fifths of their five-word shingles."""
    return jaccard.first_of_each(docs)


def mixed_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it, in the order of its training positions."""
    return mixing.mixed(docs)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces and their places in sequences."""
    return packing.pack(docs)


STAGES = [
    ("toxicity", clean_of_toxicity),
    ("exact_dedup", exact_copies),
    ("near_dedup", near_copies),
    ("mixing", mixed_sources),
    ("packing", packed),
]

#: Language-model scoring and token ids can't be said in SQL; the stages are tested against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, step in STAGES:
        path = f"{shared_folder(spark)}/corpus-pipeline/{name}-{uuid.uuid4().hex}"
        docs = step(spark, docs, sf_dir)
        docs.write.parquet(path)
        docs = spark.read.schema(docs.schema).parquet(path)
    return docs
