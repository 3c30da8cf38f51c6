"""Fit a compression model on a bounded sample of labelled documents and score every document with it."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, materialize, release, utf8_values, with_fields
from quern.llm.compression import CompressionModel

#: At most so many labelled documents of each class, of so many characters together, train a model; one that doesn't fit is left out, and the next ones are tried.
ROWS_PER_CLASS, CHARACTERS_PER_CLASS = 1000, 6_000_000


def fit(documents: DataFrame, labels: DataFrame, label: str, special: int, learn_from: Column, lower: bool, build: Callable) -> CompressionModel:
    """A model of the probability that `label` is `special`.

    labels: doc_id and `label`; rows with a null in either are ignored, as are documents with both labels. learn_from:
    a condition on doc_id. Per class the ROWS_PER_CLASS ids with the smallest hashes are taken, and of these, in that order,
    those that still fit CHARACTERS_PER_CLASS, so the sample is bounded and the same in every run, and a labelled text
    above the bound trains nothing but leaves the others; the prior comes from counts of all
    labelled rows. build: makes a pair of dictionaries of special and ordinary texts.
    """
    clean = (
        labels.filter(learn_from & F.col("doc_id").isNotNull() & F.col(label).isNotNull())
        .groupBy("doc_id").agg(F.min(label).alias("low"), F.max(label).alias("high"))
        .filter("low = high").select("doc_id", (F.col("low") == special).alias("is_special"))
    )
    counts = {r["is_special"]: r["n"] for r in clean.groupBy("is_special").agg(F.count("*").alias("n")).collect()}
    picked = [clean.filter(F.col("is_special") == c).orderBy(F.xxhash64("doc_id"), "doc_id").limit(ROWS_PER_CLASS) for c in (True, False)]
    sample = F.broadcast(picked[0].unionByName(picked[1]))  # 2 * ROWS_PER_CLASS rows at most
    texts = (
        documents.select("doc_id", "text").filter("text IS NOT NULL AND text <> ''")
        .join(sample, "doc_id").groupBy("doc_id").agg(F.first("is_special").alias("is_special"), F.max("text").alias("text"))
    )
    stored = materialize(texts, "labelled")
    fits, left = [], {True: CHARACTERS_PER_CLASS, False: CHARACTERS_PER_CLASS}
    for r in stored.orderBy(F.xxhash64("doc_id"), "doc_id").select("doc_id", "is_special", F.length("text").alias("n")).collect():  # 2 * ROWS_PER_CLASS rows at most
        if r["n"] <= left[r["is_special"]]:
            left[r["is_special"]] -= r["n"]
            fits.append(r["doc_id"])
    rows = stored.filter(F.col("doc_id").isin(fits)).orderBy(F.xxhash64("doc_id"), "doc_id").select("is_special", "text").collect() if fits else []
    texts = {c: [r["text"].encode() for r in rows if r["is_special"] is c] for c in (True, False)}
    return CompressionModel.fit(texts[True], texts[False], counts.get(True, 0), counts.get(False, 0), lower, build)


def score(documents: DataFrame, model: CompressionModel, name: str = "score", complement: bool = False) -> DataFrame:
    """documents with a column `name`, the model's probability for the whole text (null: empty text); complement: 1 less it. A column of that name is replaced."""
    spark = documents.sparkSession
    bounded_batches(spark)
    documents = documents.drop(name)
    held = spark.sparkContext.broadcast(model)

    def scored(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = held.value
        for batch in batches:
            values = [m.score(t) for t in utf8_values(batch)]
            yield batch.append_column(name, pa.array([1 - v for v in values] if complement else values, pa.float64()))
        release()

    return documents.mapInArrow(scored, with_fields(documents.schema, **{name: "double"}))
