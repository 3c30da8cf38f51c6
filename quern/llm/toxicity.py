"""Toxicity by compression distance.

Two zstandard dictionaries, one from toxic and one from ordinary labelled texts, compress every window of a text; what the
toxic one saves in all and in one window, calibrated on labelled texts that trained neither, gives a probability and, by a
threshold, a verdict. As toxic texts consist of ordinary words for the most part, both dictionaries hold what is trained on
ordinary windows; what the toxic one holds besides are passages of toxic texts.

Null and empty texts have no windows and score as such; repeated rows score alike; an empty table gives an empty result;
extra columns stay; without labels of both classes the score is the prior.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import labelled_scores
from quern.llm.common import id_crc32, read_table
from quern.llm.compression import passage_pair

THRESHOLD = 0.3


def held_out() -> Column:
    """Rows whose labels are never learnt from."""
    return F.pmod(id_crc32("doc_id"), F.lit(4)) == 2


def add_toxicity(documents: DataFrame, labels: DataFrame, learn_from: Column | None = None, threshold: float = THRESHOLD) -> DataFrame:
    """documents (text, and any columns) with toxicity double and toxic boolean (toxicity >= threshold). labels: doc_id, toxic."""
    model = labelled_scores.fit(documents, labels, "toxic", 1, F.lit(True) if learn_from is None else learn_from, lower=True, build=passage_pair)
    return labelled_scores.score(documents.drop("toxic"), model, "toxicity").withColumn("toxic", F.col("toxicity") >= threshold)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = add_toxicity(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels"), ~held_out())
    return found.select("doc_id", held_out().alias("held_out"), F.col("toxicity").alias("score"), F.col("toxic").cast("int").alias("predicted"))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are not rejected, with their own columns."""
    return add_toxicity(docs, read_table(spark, sf_dir, "labels"), ~held_out()).filter(~F.col("toxic")).select(*docs.columns)
