"""Quality classification by compression.

Zstandard trains one dictionary on the windows of labelled good texts and one on those of bad texts. The difference of a
text's compressed sizes, per raw byte, calibrated on labelled texts that trained neither dictionary, is its score: the
probability that it is good.

Null and empty texts have no windows and score as such; repeated rows score alike; an empty table gives an empty result;
extra columns stay; without labels of both classes the score is the prior.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm import labelled_scores
from quern.llm.common import id_crc32, read_table
from quern.llm.compression import trained_pair

THRESHOLD = 0.3


def held_out() -> Column:
    """Rows whose labels are never learnt from."""
    return F.pmod(id_crc32("doc_id"), F.lit(5)) == 0


def add_quality(documents: DataFrame, labels: DataFrame, learn_from: Column | None = None) -> DataFrame:
    """documents (text, and any columns) with quality_score double. labels: doc_id, quality (1 good, 0 bad)."""
    model = labelled_scores.fit(documents, labels, "quality", 0, F.lit(True) if learn_from is None else learn_from, lower=False, build=trained_pair)
    return labelled_scores.score(documents, model, "quality_score", complement=True)


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = add_quality(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "labels"), ~held_out())
    score = F.col("quality_score")
    return found.select("doc_id", held_out().alias("held_out"), score.alias("score"), (score >= THRESHOLD).cast("int").alias("predicted"))
