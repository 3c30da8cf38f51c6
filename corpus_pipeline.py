"""A corpus pipeline of five stages, each calling one of the training-data operators."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from quern.llm.byte_bpe import token_digests
from quern.llm.common import materialize
from quern.llm.decontamination import drop_contaminated
from quern.llm.near_duplicates import drop_near_duplicates
from quern.llm.secrets import mask_secrets
from quern.llm.toxicity import drop_toxic


def toxicity(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity operator rejects go."""
    return drop_toxic(spark, docs, sf_dir)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates stays, the one with the smallest id."""
    return drop_near_duplicates(spark, docs, sf_dir)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that benchmark passages contaminate go."""
    return drop_contaminated(spark, docs, sf_dir)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets in texts are masked; every document stays."""
    return mask_secrets(spark, docs, sf_dir)


def byte_bpe(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document's id, token count and digests of its tokens and of what they decode to."""
    return token_digests(spark, docs, sf_dir)


STAGES = [
    ("toxicity", toxicity),
    ("near_duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("secrets", secrets),
    ("byte_bpe", byte_bpe),
]

#: SQL can express neither the compression model nor the tokenizer; tests hold the operators, and the near-duplicates stage, against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stages over the documents, each one's result written to the shared folder and read again."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = materialize(stage(spark, docs, sf_dir), f"stage-{name}")
    return docs
