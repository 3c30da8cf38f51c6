"""Training records: chat formats, quality scores, repairs, filters and splits."""

from __future__ import annotations

from decimal import Decimal
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quern.functions.text import literal_count, occurrences, strip
from quern.operators import ordered

THINK_FROM = 100


def messages(form: str = "openai") -> Column:
    """system, user and assistant turns of instruction, input and output, without empty ones; sharegpt names them otherwise."""
    names = {"openai": ("role", "content", ("system", "user", "assistant")), "sharegpt": ("from", "value", ("system", "human", "gpt"))}
    role, text, who = names[form]
    turns = F.array(*(F.struct(F.lit(w).alias(role), F.coalesce(F.col(c), F.lit("")).alias(text)) for w, c in zip(who, ("instruction", "input", "output"), strict=True)))
    return F.filter(turns, lambda x: x[text] != "")


def think(output: Column, longer_than: int = THINK_FROM) -> Column:
    """An empty thinking block before outputs of more than so many characters."""
    return F.when(F.length(output) > longer_than, F.concat(F.lit("<think>\n\n</think>\n\n"), output)).otherwise(output)


def valid_output(output: Column) -> Column:
    """At least 20 characters, not full of its own first 10, and at most 30 % signs."""
    n = F.length(output)
    repeats = literal_count(output, F.left(output, F.lit(10)))
    signs = occurrences(output, r"[^\p{L}\p{N}_\s]")
    return (n >= 20) & (repeats <= n / 20) & (signs <= 0.3 * n)


def integrity(examples: DataFrame) -> DataFrame:
    """Examples (ord, input, output) whose output has 10 characters and is valid, the first of each input with output. The hash alone is shuffled."""
    out = strip(F.coalesce("output", F.lit("")))
    good = examples.filter((F.length(out) >= 10) & valid_output(F.coalesce("output", F.lit(""))))
    key = F.md5(F.concat(F.coalesce("input", F.lit("")), F.coalesce("output", F.lit(""))))
    return good.join(good.groupBy(key.alias("k")).agg(F.min("ord").alias("ord")).select("ord"), "ord", "left_semi")


def completeness(text: Column) -> Column:
    n, words = F.length(text), occurrences(text, r"[^\s]+")
    ends = F.regexp_replace(text, r"\s+$", "").rlike(r"[.!?]$")
    return F.when(n >= 50, 0.3).when(n >= 20, 0.15).otherwise(0.0) + F.when(words >= 10, 0.3).when(words >= 5, 0.15).otherwise(0.0) + F.when(ends, 0.4).otherwise(0.0)


def text_quality(text: Column) -> Column:
    """1, less for runs of signs, of one character, control characters, few distinct words, a small share of Hangul and many blank lines; at least 0."""
    words = F.filter(F.split(text, r"\s+"), lambda x: x != "")
    penalty = lambda c, p: F.when(c, p).otherwise(0.0)
    hangul = occurrences(text, "[가-힣]") / F.greatest(F.length(F.replace(text, F.lit(" "), F.lit(""))), F.lit(1))
    lost = (
        penalty(text.rlike(r"[!@#$%^&*()]{4,}"), 0.2) + penalty(text.rlike(r"(?s)(.)\1{5,}"), 0.2) + penalty(text.rlike(r"[\x00-\x08\x0b\x0c\x0e-\x1f]"), 0.2)
        + penalty((F.size(words) > 10) & (F.size(F.array_distinct(words)) < 0.3 * F.size(words)), 0.3)
        + penalty((hangul > 0.1) & (hangul < 0.3), 0.1) + penalty(literal_count(text, F.lit("\n\n")) > 0.1 * F.length(text), 0.1)
    )
    return F.when(F.coalesce(text, F.lit("")) == "", 0.0).otherwise(F.greatest(F.lit(0.0), 1.0 - lost))


def split(examples: DataFrame, train: float = 0.8, validation: float = 0.1, seed: int = 42) -> DataFrame:
    """examples (id) with split: the first floor(n * train) in the order of a seeded hash train, floor(n * validation) follow, the rest tests. Sizes are exact: rows are numbered over ranges, so no task sees all of them."""
    if min(train, validation) < 0 or train + validation > 1 + 1e-9:
        raise ValueError("ratios must be positive and sum to at most 1")
    digest = F.md5(F.concat(F.col("id").cast("string"), F.lit(f":{seed}")))
    # ranks and how many there are come from one stored numbering: ranges drawn anew would cut elsewhere
    placed = ordered.numbered(examples.withColumns({"__none": F.col("id").isNull(), "__o": digest}), ["__none", "__o", "id"], "__rank")
    total = placed.count()
    n_train, n_validation = int(total * Decimal(str(train))), int(total * Decimal(str(validation)))
    rank = F.col("__rank")
    return placed.withColumn("split", F.when(rank < n_train, "train").when(rank < n_train + n_validation, "validation").otherwise("test")).drop("__none", "__o", "__rank")


def summaries(documents: DataFrame, least: int = 500, most: int = 8000) -> DataFrame:
    """One example for each text (id, text) of more than `least` characters, its input cut to `most`."""
    n = F.length("text")
    return documents.filter(n > least).select("id", F.left("text", F.lit(most)).alias("input"), (n > most).alias("truncated"), n.alias("original_length"))


def sampled(rows: DataFrame, by: list[str], fraction: float, seed: int = 42) -> DataFrame:
    """About that fraction of the rows: those whose seeded digest of the columns `by` is in the first part of all digests. The same rows each time, and a larger fraction holds a smaller one."""
    at = F.conv(F.left(F.md5(F.concat_ws(":", *(F.coalesce(F.col(c).cast("string"), F.lit("")) for c in by), F.lit(str(seed)))), F.lit(8)), 16, 10).cast("long")
    return rows.filter(at < round(fraction * (1 << 32)))


def capped(rows: DataFrame, keys: list[str], order: list[str], most: int) -> DataFrame:
    """The first `most` rows of each key by an order that tells all rows apart."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return rows.withColumn("__place", F.row_number().over(w)).filter(F.col("__place") <= most).drop("__place")


def ordered_distinct(rows: DataFrame, column: str, order: str) -> DataFrame:
    """The distinct values of a column, not null or empty, with `first`, the least of `order` where each stands."""
    return rows.filter(F.col(column).isNotNull() & (F.col(column).cast("string") != "")).groupBy(column).agg(F.min(order).alias("first"))


def most_common(rows: DataFrame, column: str, order: str, most: int | None = None) -> DataFrame:
    """Values of a column with n, the most frequent first, of equally frequent ones that which comes first by `order`: place counts from 1. most: so many at most."""
    counts = rows.groupBy(column).agg(F.count("*").alias("n"), F.min(order).alias("first"))
    ranked = counts.orderBy(F.desc("n"), "first").limit(most) if most else counts
    return ranked.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "first"))).drop("first") if most else ordered.numbered(ranked.withColumn("minus", -F.col("n")), ["minus", "first"], "place").withColumn("place", F.col("place") + 1).drop("minus", "first")


def first_of_each(examples: DataFrame, columns: list[str]) -> DataFrame:
    """The first by ord of rows alike in all columns; nulls are alike."""
    key = F.md5(F.to_json(F.struct(*columns)))
    return examples.join(examples.groupBy(key.alias("k")).agg(F.min("ord").alias("ord")).select("ord"), "ord", "left_semi")


def merged(sets: list[DataFrame], columns: list[str], seed: int = 42) -> DataFrame:
    """The distinct rows of all sets by the given columns, shuffled: place is a row's rank by a seeded digest of them, numbered over ranges."""
    both = reduce(DataFrame.unionByName, (s.select(*columns) for s in sets))
    digest = F.md5(F.concat_ws(":", F.to_json(F.struct(*columns)), F.lit(str(seed))))
    return ordered.numbered(both.distinct().withColumn("__digest", digest), ["__digest", *columns], "place").drop("__digest")


def leaves(kind: T.DataType, value: Column, path: str) -> tuple[Column, Column]:
    """A value without its empty parts, null if nothing is left, and the paths of the texts and nulls that are empty in it. The type says what to look into: fields of structs and items of arrays, whose paths name their place."""
    none = F.array().cast("array<string>")
    if isinstance(kind, T.StructType):
        parts = [leaves(f.dataType, value.getField(f.name), f"{path}.{f.name}" if path else f.name) for f in kind.fields]
        kept = F.struct(*(p.alias(f.name) for (p, _), f in zip(parts, kind.fields, strict=True)))
        some = reduce(lambda a, b: a | b, (p.isNotNull() for p, _ in parts), F.lit(False))
        return F.when(some, kept), F.concat(*(x for _, x in parts)) if parts else none
    if isinstance(kind, T.ArrayType):
        inner = kind.elementType
        blank = lambda v: F.lit(False) if isinstance(inner, (T.StructType, T.ArrayType)) else leaves(inner, v, "")[0].isNull()
        full = F.filter(value, lambda v: v.isNotNull() & ~blank(v))
        kept = F.filter(F.transform(full, lambda v: leaves(inner, v, "")[0]), lambda v: v.isNotNull())
        # what is empty within items is named by the item's place; empty items themselves go unnamed
        within = F.flatten(F.transform(value, lambda v, i: F.transform(leaves(inner, v, "")[1], lambda p: F.concat(F.lit(f"{path}["), i.cast("string"), F.lit("]."), p)))) if isinstance(inner, T.StructType) else none
        return F.when(F.size(kept) > 0, kept), F.coalesce(within, none)
    gone = value.isNull() | (strip(value) == "" if isinstance(kind, T.StringType) else F.lit(False))
    return F.when(~gone, value), F.when(gone, F.array(F.lit(path))).otherwise(none)


def without_empty(records: DataFrame, keep: list[str]) -> DataFrame:
    """records with every column but those of `keep` freed of empty texts, arrays and objects at any depth, and removed, the paths of empty fields in the order of the columns."""
    kinds = {f.name: f.dataType for f in records.schema.fields}
    parts = {c: leaves(kinds[c], F.col(c), c) for c in records.columns if c not in keep}
    removed = F.concat(*(x for _, x in parts.values())) if parts else F.array().cast("array<string>")
    return records.select(*(parts[c][0].alias(c) if c in parts else c for c in records.columns), removed.alias("removed"))


def table_examples(cells: DataFrame, instruction: str = "") -> DataFrame:
    """One example for each table with cells: the table as Markdown is the output; n_rows and n_cols describe it."""
    from quern.operators.tables import markdown_tables

    size = cells.groupBy("id", "table_no").agg(F.countDistinct("row").alias("n_rows"), (F.max("col") + 1).alias("n_cols"))
    return markdown_tables(cells).join(size, ["id", "table_no"]).select("id", "table_no", F.lit(instruction).alias("instruction"), F.lit("").alias("input"), F.col("markdown").alias("output"), "n_rows", "n_cols")
