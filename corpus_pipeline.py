"""A training corpus from raw documents: five stages, each one operator over all that is left.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame, which is written and read again
as the next one's ``docs``. All but the last return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from tideline.llm import decontaminate, language_id, near_duplicates, packing, secret_scan
from tideline.llm.queries import vocabulary
from tideline.llm.text import bound_batches
from tideline.session import checkpoint_dir, scratch

# SQL cannot express the learnt language model.
ORACLE_SQL = None

# Words per shingle and least similarity in percent of the near-duplicate stage, as in the query.
SHINGLE, MIN_PERCENT = 2, 80


def identified(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a language of the corpus; those the model rejects go."""
    bound_batches(spark)
    return language_id.keep_identified(docs)


def deduplicated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies, the one with the smallest id."""
    bound_batches(spark)
    return near_duplicates.keep_one(docs, size=SHINGLE, percent=MIN_PERCENT)


def decontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark passages."""
    bound_batches(spark)
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, every secret replaced by a mark."""
    bound_batches(spark)
    return secret_scan.redact(docs, length="n_chars" if "n_chars" in docs.columns else None)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The places of all documents' token pieces in training sequences."""
    bound_batches(spark)
    return packing.pack(docs, vocabulary())


STAGES = [
    ("language_id", identified),
    ("near_duplicates", deduplicated),
    ("decontaminate", decontaminated),
    ("secrets", without_secrets),
    ("packing", packed),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``, each result written to shared storage and read again.

    The tables a stage keeps for itself are removed when its result is written.
    """
    folder = f"{checkpoint_dir(spark)}/pipeline/{uuid.uuid4().hex}"
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}_{name}"
        with scratch(spark):
            stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
