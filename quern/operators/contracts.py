"""What a parsed document must have, as a JSON text; its metadata; and the last filters of generated examples."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import squash, strip
from quern.operators import packing

# The fields that a document must have, and the names of its metadata's fields, the first found counting.
SECTIONS, DOCUMENT_FIELDS = ["document", "content", "tables", "assets"], ["source_path", "format", "parser", "encrypted"]
NAMES, VERSIONS, CHANNELS, OPTIONAL = ["product_name", "productName", "상품명", "title", "name"], ["version", "버전", "effective_date", "date"], ["channel", "sales_channel", "distribution_channel", "채널"], ["channel", "source_file", "created_at", "company"]
QUOTED = "[\"'‘’]([^\"'‘’]{6,})[\"'‘’]"
QUOTE_EXPECTED = ["definition", "operation", "multimodal"]
TOKENS_A_GROUP = 6000


def field(doc: Column, *names: str) -> Column:
    return F.get_json_object(doc, "$" + "".join(f"['{n}']" for n in names))


def contract_violation(doc: Column) -> Column:
    """The first rule that a document, as a JSON text, breaks; null if it keeps all. A null field counts as missing, as does every field of what is no JSON."""
    is_list = lambda c: F.json_array_length(c).isNotNull()
    table = lambda t, i: F.when(field(t, "table_id").isNull(), F.format_string("tables[%d] missing table_id", i)).when(~is_list(field(t, "cells")), F.format_string("tables[%d].cells must be a list", i)).when(field(t, "shape").isNull(), F.format_string("tables[%d] missing shape", i))
    of_tables = F.filter(F.transform(F.from_json(field(doc, "tables"), "array<string>"), table), lambda x: x.isNotNull())
    rules = [F.when(field(doc, s).isNull(), F.lit(f"missing {s}")) for s in SECTIONS]
    rules += [F.when(field(doc, "document", k).isNull(), F.lit(f"missing document.{k}")) for k in DOCUMENT_FIELDS]
    rules += [F.when(~is_list(field(doc, "content", "paragraphs")), F.lit("content.paragraphs must be a list")), F.when(~is_list(field(doc, "tables")), F.lit("tables must be a list"))]
    rules += [F.try_element_at(of_tables, F.lit(1)), F.when(~is_list(field(doc, "assets", "images")), F.lit("assets.images must be a list"))]
    return F.coalesce(*rules)


def has_content(doc: Column) -> Column:
    """A path, and a paragraph or a table at least."""
    n = lambda *names: F.coalesce(F.json_array_length(field(doc, *names)), F.lit(0))
    return (F.coalesce(field(doc, "document", "source_path"), F.lit("")) != "") & ((n("content", "paragraphs") > 0) | (n("tables") > 0))


def metadata(doc: Column) -> Column:
    """A struct of product_name, version (YYYYMM), channel_hint and quality of the first object among metadata, meta and document.metadata, else of the document itself."""
    as_object = lambda c: F.when(c.startswith("{"), c)
    section = F.coalesce(as_object(field(doc, "metadata")), as_object(field(doc, "meta")), as_object(field(doc, "document", "metadata")), doc)
    first = lambda names: F.coalesce(*(field(section, n) for n in names))
    month = lambda c: F.nullif(F.regexp_replace(F.regexp_extract(c, r"(\d{4}[-.]?\d{2})", 1), "[-.]", ""), F.lit(""))
    name = squash(F.coalesce(first(NAMES), field(doc, "document", "title")))
    version = F.coalesce(*(month(field(section, n)) for n in (*VERSIONS, "source_file")))
    filled = lambda n: F.coalesce(field(section, n) != "", F.lit(False))
    hint = F.coalesce(*(F.when(filled(n), field(section, n)) for n in CHANNELS))
    some = sum((filled(n).cast("int") for n in OPTIONAL), F.lit(0))
    quality = F.when(F.coalesce(name, F.lit("")) != "", 0.4).otherwise(0.0) + F.when(version.isNotNull(), 0.3).otherwise(0.0) + F.least(0.1 * some, F.lit(0.3))
    return F.struct(name.alias("product_name"), version.alias("version"), hint.alias("channel_hint"), F.least(quality, F.lit(1.0)).alias("quality"))


def unfenced(reply: Column) -> Column:
    """The lines of the fenced blocks named json, if a reply begins with a fence; else the reply itself. Ends are stripped. A cut at the fences and no fold, so a long reply takes time in proportion."""
    s = strip(reply)
    # what stands after a fence at the beginning of a line, up to the next one; without a line feed there are no lines in it
    parts = F.filter(F.split(F.concat(F.lit("\n"), s), "\n```"), lambda p: F.startswith(p, F.lit("json")) & F.contains(p, F.lit("\n")))
    return F.when(s.startswith("```"), F.array_join(F.transform(parts, lambda p: F.substr(p, F.locate("\n", p) + 1)), "\n")).otherwise(s)


def quote_findings(output: Column, canonical: Column, qtype: Column) -> Column:
    """Codes for quotes of six characters or more: one that the canonical text lacks fails, none at all is a warning for the kinds of questions that want one. Empty without an output or a canonical text."""
    o, c = strip(F.coalesce(output, F.lit(""))), strip(F.coalesce(canonical, F.lit("")))
    quotes = F.regexp_extract_all(o, F.lit(QUOTED), F.lit(1))
    wrong = F.filter(F.transform(quotes, lambda q: strip(q)), lambda q: (q != "") & ~F.contains(c, q))
    none = F.array().cast("array<string>")
    codes = F.when(F.size(quotes) == 0, F.when(F.coalesce(qtype, F.lit("definition")).isin(QUOTE_EXPECTED), F.array(F.lit("warn:grounding.no_canonical_quote"))).otherwise(none)).otherwise(F.transform(wrong, lambda q: F.lit("fail:grounding.invalid_quote")))
    return F.when((o == "") | (c == ""), none).otherwise(codes)


def four_stage_filter(examples: DataFrame, least: float = 7.0, least_korean: float = 6.0, most_violations: int = 2) -> DataFrame:
    """examples (ord, instruction, output, overall, korean, passed_checks, n_violations) with passed: good enough by all four, and the first by ord of those that are and have one instruction and output."""
    good = (F.col("overall") >= least) & (F.col("korean") >= least_korean) & F.col("passed_checks") & (F.col("n_violations") <= most_violations)
    key = F.md5(F.concat(F.coalesce("instruction", F.lit("")), F.coalesce("output", F.lit(""))))
    first = examples.filter(good).groupBy(key.alias("k")).agg(F.min("ord").alias("ord")).select("ord", F.lit(True).alias("passed"))
    return examples.join(first, "ord", "left").withColumn("passed", F.coalesce("passed", F.lit(False)))


def pass_rate(filtered: DataFrame) -> DataFrame:
    """One row: how many examples, how many pass and fail, and the percentage that passes."""
    return filtered.agg(F.count("*").alias("total"), F.count_if("passed").alias("n_passed"), F.count_if(~F.col("passed")).alias("n_failed"), F.round(100.0 * F.count_if("passed") / F.nullif(F.count("*"), F.lit(0)), 6).alias("pass_rate"))


def article_groups(articles: DataFrame, budget: int = TOKENS_A_GROUP) -> DataFrame:
    """articles (id, article_no, n_chars) with group_no: neighbours fill a group until the next one's tokens, half its characters, would pass the budget."""
    sized = articles.select("id", F.col("article_no").cast("int").alias("article_no"), F.floor(F.col("n_chars") / 2).cast("long").alias("tokens"))
    return packing.greedy_groups(sized, "id", "article_no", "tokens", budget, "group_no").select("id", "article_no", "group_no")
