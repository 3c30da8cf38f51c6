"""Paragraphs and rows of tables as chunks for retrieval, each with the clause it belongs to."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import path_parts, strip
from quern.operators import chunking, tables
from quern.operators.classify import document_role


def last_at_or_before(facts: DataFrame, asked: DataFrame, key: str, at: str, columns: list[str]) -> DataFrame:
    """asked with the columns of the last of facts (key, at, columns) at or before each row, null without one: both in one order by key and place, where the last fact carries on, so that no pair is made."""
    both = facts.select(key, at, F.struct(*columns).alias("__fact"), F.lit(0).alias("__asked"), F.lit(None).alias("__row")).unionByName(asked.select(key, at, F.lit(None).alias("__fact"), F.lit(1).alias("__asked"), F.struct("*").alias("__row")))
    w = Window.partitionBy(key).orderBy(at, "__asked").rowsBetween(Window.unboundedPreceding, 0)
    held = both.withColumn("__fact", F.last("__fact", ignorenulls=True).over(w)).filter("__asked = 1")
    return held.select("__row.*", *(F.col(f"__fact.{c}").alias(c) for c in columns))


def table_row_chunks(documents: DataFrame, separator: str = "  ", headings: dict[str, str] | None = None, least: float = 0.6, in_place: bool = False, titles: DataFrame | None = None) -> DataFrame:
    """id, table_no, row, text, clause_title, heading_path: a sentence for each row of each table of documents (id, text) that passes the gate, from cells of reliability `least` on.

    The clause is the one in force at the document's end, or with in_place at the table's first line; titles (id, table_no,
    title) that begin as a heading does go before it.
    """
    lines = documents.select("id", F.posexplode(F.split("text", "\n")).alias("idx", "text"))
    heads = chunking.clause_context(lines, headings)
    kinds = headings or chunking.HEADINGS
    like_heading = lambda c: F.coalesce(strip(c).rlike("|".join(f"(?:{p})" for p in kinds.values())), F.lit(False))
    heads = heads.filter(like_heading(F.col("text"))).select("id", "idx", "clause_title", "heading_path")
    cells = tables.detect(documents.select("id", "text"), separator, places=True).withColumn("reliability", tables.reliability(F.col("text")))
    passed = tables.gate(cells).filter("passed").select("id", "table_no")
    first = cells.groupBy("id", "table_no").agg(F.min("line_no").alias("idx")).join(passed, ["id", "table_no"])
    context = ["clause_title", "heading_path"]
    if in_place:
        placed = last_at_or_before(heads, first, "id", "idx", context)
    else:
        last = heads.groupBy("id").agg(F.max_by(F.struct(*context), "idx").alias("x"))
        placed = first.join(last, "id", "left").select("id", "table_no", *(F.col(f"x.{c}").alias(c) for c in context))
    if titles is not None:
        placed = placed.join(titles.select("id", "table_no", "title"), ["id", "table_no"], "left").withColumn("clause_title", F.when(like_heading(F.col("title")), F.col("title")).otherwise(F.col("clause_title")))
    sentences = tables.row_sentences(cells.join(passed, ["id", "table_no"], "left_semi"), least)
    return sentences.join(placed, ["id", "table_no"]).select("id", "table_no", "row", F.col("sentence").alias("text"), *context)


def product_id(path: Column) -> Column:
    """The name of a path's folder; of a bare file name, the name without its suffix."""
    p = path_parts(F.coalesce(path, F.lit("")))
    return F.when(~p["parent"].isin("", "."), p["parent"]).otherwise(p["stem"])


def paragraph_chunks(documents: DataFrame, headings: dict[str, str] | None = None) -> DataFrame:
    """id, idx, text, role, product_id, version, clause_title, heading_path: each paragraph, a line that isn't blank, of documents (id, text, path, and if known product_id and version) with the clause in force. role is told by the path."""
    known = lambda c: F.when(F.coalesce(F.col(c), F.lit("")) != "", F.col(c)) if c in documents.columns else F.lit(None).cast("string")
    about = documents.select("id", document_role(F.coalesce("path", F.lit(""))).alias("role"), F.coalesce(known("product_id"), product_id(F.col("path"))).alias("product_id"), F.coalesce(known("version"), F.lit("unknown")).alias("version"))
    lines = documents.select("id", F.posexplode(F.split("text", "\n")).alias("idx", "text"))
    p = chunking.clause_context(lines.withColumn("text", strip(F.col("text"))).filter("text <> ''"), headings)
    return p.join(about, "id").select("id", "idx", "text", "role", "product_id", "version", "clause_title", "heading_path")
