"""Scores, forms and conversions of training records of any form: messages or conversations (arrays of structs), instruction, input and output, text and content; a column that a form lacks is null or absent."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.operators.records import completeness, text_quality

TURNS = {"messages": ("role", "content"), "conversations": ("from", "value")}
TEXTS = ["text", "content", "input", "output"]


def column(records: DataFrame, name: str) -> Column:
    """A column of the records; null if they have none of that name."""
    kind = "array<struct<{}:string,{}:string>>".format(*TURNS[name]) if name in TURNS else "string"
    return F.col(name) if name in records.columns else F.lit(None).cast(kind)


def texts(records: DataFrame) -> Column:
    """The texts of a record that aren't empty: of its messages, else of instruction, input and output, else of its conversations, else of its text fields."""
    c = lambda name: column(records, name)
    of = F.when(c("messages").isNotNull(), F.transform(c("messages"), lambda m: m["content"]))
    of = of.when(c("instruction").isNotNull(), F.array(c("instruction"), c("input"), c("output")))
    of = of.when(c("conversations").isNotNull(), F.transform(c("conversations"), lambda m: m["value"]))
    return F.filter(of.otherwise(F.array(*(c(x) for x in TEXTS))), lambda t: t.isNotNull() & (t != ""))


def structure_score(records: DataFrame) -> Column:
    """Messages: two thirds if there are any, a third for two roles; an instruction and an output: a half each; conversations: 1 if there are any; text fields: a quarter each."""
    c = lambda name: column(records, name)
    full = lambda x: F.coalesce(x != "", F.lit(False)).cast("double")
    roles = F.array_distinct(F.transform(c("messages"), lambda m: m["role"]))
    chat = (F.when(F.size(c("messages")) > 0, 1.0).otherwise(0.0) + F.when(F.size(roles) >= 2, 0.5).otherwise(0.0)) / 1.5
    plain = F.when(c("conversations").isNotNull(), F.when(F.size(c("conversations")) > 0, 1.0).otherwise(0.0)).otherwise(sum((0.25 * full(c(x)) for x in TEXTS), F.lit(0.0)))
    return F.when(c("messages").isNotNull(), chat).when(c("instruction").isNotNull(), 0.5 * full(c("instruction")) + 0.5 * full(c("output"))).otherwise(plain)


def add_scores(records: DataFrame) -> DataFrame:
    """records with structure, completeness, quality (means over the texts, 0 without any) and overall (0.3, 0.3 and 0.4 of them)."""
    r = records.withColumn("__texts", texts(records))
    mean = lambda score: F.coalesce(F.aggregate(F.transform("__texts", score), F.lit(0.0), lambda a, x: a + x) / F.nullif(F.size("__texts"), F.lit(0)), F.lit(0.0))
    r = r.withColumn("structure", structure_score(records)).withColumn("completeness", mean(completeness)).withColumn("quality", mean(text_quality)).drop("__texts")
    return r.withColumn("overall", 0.3 * F.col("structure") + 0.3 * F.col("completeness") + 0.4 * F.col("quality"))


def passing(scored: DataFrame, least: float = 0.7) -> DataFrame:
    """The records of an overall score from `least` on, with it as _quality_score."""
    return scored.filter(F.col("overall") >= least).withColumn("_quality_score", F.col("overall"))


def averages(scored: DataFrame, least: float = 0.7) -> DataFrame:
    """One row: how many records there are, pass and fail, and the mean of each score."""
    return scored.agg(
        F.count("*").alias("total"), F.count_if(F.col("overall") >= least).alias("valid"), F.count_if(F.col("overall") < least).alias("filtered"),
        *(F.avg(c).alias(f"avg_{c}") for c in ("structure", "completeness", "quality", "overall")),
    )


def valid_form(records: DataFrame, form: str) -> Column:
    """Whether a record is whole in a form: each message with role and content, each conversation with from and value, instruction and output, or messages at all (qwen3)."""
    whole = lambda name: F.forall(column(records, name), lambda m: m[TURNS[name][0]].isNotNull() & m[TURNS[name][1]].isNotNull())
    checks = {
        "openai": column(records, "messages").isNotNull() & whole("messages"), "sharegpt": column(records, "conversations").isNotNull() & whole("conversations"),
        "alpaca": column(records, "instruction").isNotNull() & column(records, "output").isNotNull(), "qwen3": column(records, "messages").isNotNull(),
    }
    return F.coalesce(checks[form], F.lit(False))


def metadata(records: DataFrame, exclude: list[str], explicit: str | None = None, allow_empty: bool = False) -> Column:
    """As a map of strings: the column `explicit` where given and not null, else all other columns but those to exclude; an empty map is null unless allowed."""
    others = [c for c in records.columns if c not in exclude and c != explicit]
    rest = F.map_filter(F.create_map(*(x for c in others for x in (F.lit(c), F.col(c).cast("string")))), lambda k, v: v.isNotNull()) if others else F.create_map().cast("map<string,string>")
    of = rest if explicit is None else F.coalesce(F.col(explicit), rest)
    return of if allow_empty else F.when(F.size(of) > 0, of)


def convert(records: DataFrame, form: str, keep: list[str] | None = None) -> DataFrame:
    """instruction, input and output as messages (openai), conversations (sharegpt), messages with a thinking block (qwen3) or as they are (alpaca, nulls empty), with the columns to keep."""
    from quern.operators.records import messages, think

    keep = keep or []
    if form == "alpaca":
        return records.select(*keep, *(F.coalesce(c, F.lit("")).alias(c) for c in ("instruction", "input", "output")))
    if form == "sharegpt":
        return records.select(*keep, messages("sharegpt").alias("conversations"))
    if form not in ("openai", "qwen3"):
        raise ValueError(f"no form {form}")
    return (records.withColumn("output", think(F.col("output"))) if form == "qwen3" else records).select(*keep, messages().alias("messages"))
