"""Metrics of runs over files: failures by error, parser and extension, and what became of the files, each in one pass of grouping sets."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

# From what failure rate on, and for which commonest error, something is recommended.
HIGH_FAILURE_PERCENT = 50
ADVICE = {"corrupted": "High corrupted PDF rate - implement pre-validation", "memory": "Memory issues detected - reduce worker memory or batch sizes"}


def sets_of(df: DataFrame, dimensions: list[str], *aggregates: Column) -> DataFrame:
    """dimension, value and the aggregates: for each value of each dimension, and over all rows as dimension "all". One pass: each row is expanded once a dimension, and added up in its task before anything is shuffled. Null values count as "unknown"."""
    known = df.withColumns({c: F.coalesce(F.col(c).cast("string"), F.lit("unknown")) for c in dimensions})
    g = known.groupingSets([[F.col(c)] for c in dimensions] + [[]], *dimensions).agg(F.grouping_id().alias("g"), *aggregates)
    # a set's bit is 0 for the column it groups by
    bit = lambda i: F.col("g").bitwiseAND(1 << (len(dimensions) - 1 - i)) == 0
    name, value = F.lit("all"), F.lit("")
    for i, c in enumerate(dimensions):
        name, value = F.when(bit(i), c).otherwise(name), F.when(bit(i), F.col(c)).otherwise(value)
    return g.withColumn("dimension", name).withColumn("value", value).drop("g", *dimensions)


def failures(failed: DataFrame, dimensions: tuple[str, ...] = ("error", "parser", "extension")) -> DataFrame:
    """dimension, value, n, percent of failed files, which have a column for each dimension."""
    f = sets_of(failed, list(dimensions), F.count("*").alias("n"))
    return f.select("dimension", "value", "n", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy("dimension")), 6).alias("percent"))


def runs(results: DataFrame, dimensions: tuple[str, ...] = ("parser",)) -> DataFrame:
    """dimension, value, total, success, skipped, errors, timeout, crash, share, success_percent, failure_percent, seconds and per_minute of results (status: success, skipped, or an error with reason; seconds); percentages are of what was tried, share is of all files, rates are of successes over the seconds of all."""
    is_error = ~F.col("status").isin("success", "skipped") | F.col("status").isNull()
    of = lambda c: F.count_if(c)
    r = sets_of(
        results, list(dimensions), F.count("*").alias("total"), of(F.col("status") == "success").alias("success"), of(F.col("status") == "skipped").alias("skipped"), of(is_error).alias("errors"),
        of(is_error & (F.col("reason") == "timeout")).alias("timeout"), of(is_error & (F.col("reason") == "crash")).alias("crash"), F.sum("seconds").alias("seconds"),
    )
    tried = F.col("success") + F.col("errors")
    percent = lambda c: F.when(tried > 0, F.round(100.0 * F.col(c) / tried, 2)).otherwise(0.0)
    return r.select(
        "dimension", "value", "total", "success", "skipped", "errors", "timeout", "crash", F.round(100.0 * F.col("total") / F.sum("total").over(Window.partitionBy("dimension")), 2).alias("share"),
        percent("success").alias("success_percent"), percent("errors").alias("failure_percent"), F.round("seconds", 2).alias("seconds"),
        F.when(F.col("seconds") > 0, F.round(60.0 * F.col("success") / F.col("seconds"), 2)).otherwise(0.0).alias("per_minute"),
    )


def advice(run: DataFrame, failed: DataFrame) -> DataFrame:
    """advice: what to look at, from what runs() and failures() give: a high failure rate over all, and the commonest error, the first by name of equals."""
    high = run.filter((F.col("dimension") == "all") & (F.col("failure_percent") > HIGH_FAILURE_PERCENT)).select(F.format_string("High failure rate (%s%%) - investigate primary parser issues", F.col("failure_percent").cast("string")).alias("advice"))
    top = failed.filter("dimension = 'error'").agg(F.min_by("value", F.struct(-F.col("n"), "value")).alias("error"))
    known = F.create_map(*(F.lit(x) for kv in ADVICE.items() for x in kv))
    return high.unionByName(top.select(F.try_element_at(known, F.col("error")).alias("advice")).filter("advice IS NOT NULL"))
