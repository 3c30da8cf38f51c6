"""Quality rules: counted base rules, then a log-likelihood ratio of hashed n-grams; built-in functions only.

Hashed n-grams of a trusted target corpus and of the raw corpus (all documents) give two smoothed multinomials over
BUCKETS buckets. A document's verdict is the mean log ratio of its n-grams against a fixed threshold, so each document is
decided alike whatever else is in the table's order or partitions.

Null texts have no words and fail the base rules, as empty ones do. Repeated rows are each scored; an empty table gives
an empty result; without any target document the ratio is 0 for all. Extra columns stay unless named like a result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import fresh, materialize, read_table

#: Buckets of the hashed n-grams of orders 1 and 2: the model is a table of so many rows at most, whatever the corpus.
BUCKETS = 1 << 16
SMOOTHING, THRESHOLD = 0.5, -0.2
LEAST_WORDS, MOST_REPEATED_PERCENT = 50, 50
#: Ids of the target that go to every task, about 16 MB; more are joined by a shuffle.
MOST_BROADCAST = 1_000_000
SPACES = "[\\x20\\x09-\\x0D]+"


def words(text: str = "text") -> Column:
    """The words of a text column: what stands between white space. Null: none."""
    return F.array_remove(F.split(F.coalesce(F.col(text), F.lit("")), SPACES), "")


def buckets(w: str) -> Column:
    """The buckets of each word and of each pair of neighbouring words of the array column w."""
    pairs = F.zip_with(F.slice(w, F.lit(1), F.greatest(F.size(w) - 1, F.lit(0))), F.slice(w, F.lit(2), F.greatest(F.size(w) - 1, F.lit(0))), lambda a, b: F.pmod(F.xxhash64(a, b), F.lit(BUCKETS)).cast("int"))
    return F.concat(F.transform(w, lambda a: F.pmod(F.xxhash64(a), F.lit(BUCKETS)).cast("int")), pairs)


def repeated_words(w: str) -> Column:
    """How many words stand in a window of three words that occurs twice or more. Windows are sorted as (64-bit hash, place); equal neighbours are repeated."""
    n = F.greatest(F.size(w) - 2, F.lit(0))
    part = lambda i: F.slice(w, F.lit(i), n)
    pairs = F.zip_with(part(1), part(2), lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    hashes = F.zip_with(pairs, part(3), lambda p, c: F.xxhash64(p["a"], p["b"], c))
    ordered = F.sort_array(F.transform(hashes, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))
    return ordered.alias("ordered")


def repeated_count(ordered: str) -> Column:
    n = F.greatest(F.size(ordered) - 1, F.lit(0))
    # neighbours in hash order that are equal: both places are repeated
    equal = F.zip_with(F.slice(ordered, F.lit(1), n), F.slice(ordered, F.lit(2), n), lambda a, b: F.when(a["h"] == b["h"], F.array(a["i"], a["i"] + 1, a["i"] + 2, b["i"], b["i"] + 1, b["i"] + 2)))
    return F.size(F.array_distinct(F.flatten(F.filter(equal, lambda x: x.isNotNull())))).cast("long")


def add_base(documents: DataFrame, w: str = "__w") -> DataFrame:
    """documents with n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words (long), base_failed, and the words as an array w."""
    text = F.coalesce(F.col("text"), F.lit(""))
    lines = F.filter(F.split(text, "\n"), lambda x: x.rlike("[^\\x20\\x09-\\x0D]"))
    own, ordered = fresh(documents, "lines"), fresh(documents, "ordered")
    d = documents.withColumn(w, words()).withColumn(own, lines).withColumn(ordered, repeated_words(w))
    d = (
        d.withColumn("n_words", F.size(w).cast("long"))
        .withColumn("word_chars", F.length(F.array_join(w, "")).cast("long"))
        .withColumn("n_symbols", F.regexp_count(text, F.lit("[#*$%&|<>]")).cast("long"))
        .withColumn("n_dup_lines", (F.size(own) - F.size(F.array_distinct(own))).cast("long"))
        .withColumn("n_repeat_words", repeated_count(ordered))
        .drop(own, ordered)
    )
    return d.withColumn("base_failed", (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED_PERCENT * F.col("n_words")))


def log_ratios(documents: DataFrame, target_ids: DataFrame) -> DataFrame:
    """bucket int, ratio double: log of the bucket's smoothed share in the target less that in all documents. target_ids: doc_id."""
    target = materialize(target_ids.select("doc_id").distinct(), "target").withColumn("__t", F.lit(1))
    if target.count() <= MOST_BROADCAST:
        target = F.broadcast(target)
    # beyond that the texts are shuffled as they stand, and cut into words after
    marked = documents.select("doc_id", "text").join(target, "doc_id", "left").select(F.coalesce("__t", F.lit(0)).alias("t"), words().alias("__w"))
    grams = marked.select("t", F.explode(buckets("__w")).alias("bucket"))
    counted = materialize(grams.groupBy("bucket").agg(F.count("*").alias("raw"), F.sum("t").alias("target")), "buckets")
    total = counted.agg(F.coalesce(F.sum("raw"), F.lit(0)).alias("r"), F.coalesce(F.sum("target"), F.lit(0)).alias("t")).first()
    if not total["t"]:
        return counted.select("bucket", F.lit(0.0).alias("ratio"))
    share = lambda c, n: (F.col(c) + SMOOTHING) / F.lit(float(n + SMOOTHING * BUCKETS))
    return counted.select("bucket", (F.log(share("target", total["t"])) - F.log(share("raw", total["r"]))).alias("ratio"))


def trusted_ids(labels: DataFrame) -> DataFrame:
    """All ids of documents that are labelled good and never bad."""
    good = labels.filter("doc_id IS NOT NULL AND quality IS NOT NULL").groupBy("doc_id").agg(F.min("quality").alias("q")).filter("q = 1")
    return good.select("doc_id")


def add_rules(documents: DataFrame, target_ids: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """documents with the base columns, llr double (mean log ratio of the n-grams, 0 without any) and kept boolean."""
    names = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed"]
    documents = documents.drop(*names, "llr", "kept")
    # helper columns have names that no column of the documents has
    row, w, bucket, ratio = (fresh(documents, x) for x in ("row", "w", "bucket", "ratio"))
    based = add_base(documents, w).withColumn(row, F.monotonically_increasing_id())
    kept_columns = [c for c in documents.columns if c != "text"]
    # BUCKETS rows at most; each document's n-grams meet again in the task that made them, before one row of it is shuffled
    table = F.broadcast(log_ratios(documents, target_ids).toDF(bucket, ratio))
    grams = based.select(row, *kept_columns, *names, F.explode_outer(buckets(w)).alias(bucket))
    scored = grams.join(table, bucket, "left").groupBy(row, *kept_columns, *names).agg(F.coalesce(F.avg(ratio), F.lit(0.0)).alias("llr"))
    return scored.drop(row).withColumn("kept", ~F.col("base_failed") & (F.col("llr") >= threshold))


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = add_rules(read_table(spark, sf_dir, "documents").select("doc_id", "text"), trusted_ids(read_table(spark, sf_dir, "labels")))
    return rules.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept", "llr")
