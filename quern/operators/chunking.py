"""Cutting documents into clauses, chunks and articles."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import strip
from quern.operators import packing


# How the headings of each kind begin.
HEADINGS = {"chapter": r"(?U)^제\s*\d+\s*장", "section": r"(?U)^제\s*\d+\s*절", "article": r"(?U)^제\s*\d+\s*조", "appendix": r"(?U)^별표\s*\d+"}


def clause_context(paragraphs: DataFrame, headings: dict[str, str] | None = None) -> DataFrame:
    """paragraphs (id, idx, text) with chapter, section, article, appendix in force, clause_title and heading_path. A chapter ends section and article, a section the article, an appendix all three. headings: a pattern for each of these, other than HEADINGS."""
    text = strip(F.col("text"))
    kinds = headings or HEADINGS
    d = paragraphs
    for name in HEADINGS:
        d = d.withColumn(name, F.when(text.rlike(kinds[name]), F.struct(F.col("idx").alias("at"), text.alias("title"))))
    w = Window.partitionBy("id").orderBy("idx").rowsBetween(Window.unboundedPreceding, 0)
    for name in HEADINGS:
        d = d.withColumn(name, F.last(name, ignorenulls=True).over(w))
    at = lambda c: F.coalesce(F.col(f"{c}.at"), F.lit(-1))
    in_force = {
        "chapter": at("chapter") > at("appendix"),
        "section": (at("section") > at("appendix")) & (at("section") > at("chapter")),
        "article": (at("article") > at("appendix")) & (at("article") > at("chapter")) & (at("article") > at("section")),
        "appendix": F.lit(True),
    }
    d = d.select("id", "idx", "text", *(F.when(ok, F.col(f"{c}.title")).alias(c) for c, ok in in_force.items()))
    return d.withColumn("clause_title", F.coalesce("article", "section", "chapter", "appendix")).withColumn("heading_path", F.filter(F.array("chapter", "section", "article", "appendix"), lambda x: x.isNotNull()))


def pack(documents: DataFrame, size: int = 1000) -> DataFrame:
    """id, chunk_no, text: paragraphs (an array of each document) put together while they and the blank line after each fit size; longer ones alone. Blank chunks are left out but keep their number."""
    p = documents.select("id", F.posexplode("paragraphs").alias("idx", "p")).withColumn("n", (F.length("p") + 2).cast("long"))
    # a paragraph and its blank line count together, as the open chunk ends with one
    dealt = packing.greedy_groups(p, "id", "idx", "n", size, "chunk_no")
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("idx", "p"))), lambda x: x["p"])
    chunks = dealt.groupBy("id", "chunk_no").agg(strip(F.array_join(ordered, "\n\n")).alias("text"))
    return chunks.filter("text <> ''")


def segments(documents: DataFrame, header: str) -> DataFrame:
    """id, segment, start_line, end_line, title and n_chars of what begins at each line that matches header; lines before the first aren't in any."""
    lines = documents.select("id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))
    w = Window.partitionBy("id").orderBy("line_no").rowsBetween(Window.unboundedPreceding, 0)
    numbered = lines.withColumn("segment", F.sum(F.col("line").rlike(header).cast("int")).over(w)).filter("segment > 0")
    return numbered.groupBy("id", "segment").agg(F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"), F.min_by("line", "line_no").alias("title"), F.sum(F.length("line")).alias("n_chars"))
