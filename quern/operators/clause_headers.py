"""Headers of clauses among lines (id, line_no, line): noise, scores, kinds, and the articles of a segment."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import occurrences, strip

# Lines that are never headers (page numbers, image marks, digits, rules).
NOISE = [r"^\s*-\s*\d+\s*-\s*$", r"^\s*페이지\s*\d+\s*$", r"^<!--\s*image\s*-->$", r"^\s*\d+\s*$", r"^\s*[|─━═]+\s*$"]
# The kinds of headers.
NUMBERED = r"^(\d+-\d+)\.\s*(.{2,50}(?:특별약관|특약))\s*$"
SPECIAL = r"^(.{2,40}(?:특약|에\s*관한\s*특약))\s*$"
COVERAGE = r"^(.{2,40}담보)\s*$"
APPENDIX = [r"^[【\[](별표\s*\d+)[】\]]\s*(.*)$", r"^(별표\s*\d+)\s*[\.:\s]\s*(.*)$"]
ADDENDUM = r"^(부\s*칙)\s*$"
ARTICLE = r"^(제\s*\d+\s*조)\s*(\([^)]+\))?\s*$"
LEAST_SCORE = 3


def noise(line: Column) -> Column:
    s = strip(line)
    return (s == "") | s.rlike("|".join(f"(?:{p})" for p in NOISE))


def header_score(line: Column) -> Column:
    """Points for the endings and beginnings of headers, a number and a fitting length; fewer for many brackets, very short and long lines; -10 for noise."""
    s = strip(line)
    n = F.length(s)
    when = lambda c, points: F.when(c, points).otherwise(0)
    score = (
        when(s.endswith("특약") | s.contains("에 관한 특약"), 4) + when(s.endswith("특별약관"), 4) + when(s.endswith("담보"), 3) + when(s.startswith("별표") | s.contains("【별표"), 3)
        + when(s.isin("부칙", "부 칙"), 3) + when(s.rlike(r"^\d+-\d+\."), 2) + when(n.between(4, 40), 1) + when(s.startswith("##"), 1)
        - when(occurrences(s, r"[【】\[\]()（）]") > 0.3 * F.greatest(n, F.lit(1)), 2) - when(n < 3, 2) - when(n > 50, 1)
    )
    return F.when(noise(line), -10).otherwise(score)


def may_be_header(line: Column) -> Column:
    """Whether a line has what a header of any kind must have; a look for plain letters that spares most lines the patterns."""
    return F.contains(line, F.lit("특약")) | F.contains(line, F.lit("특별약관")) | F.contains(line, F.lit("담보")) | F.contains(line, F.lit("별표")) | (F.contains(line, F.lit("부")) & F.contains(line, F.lit("칙")))


def with_headers(lines: DataFrame, least: int = LEAST_SCORE) -> DataFrame:
    """lines with header (title, kind, score), null where a line is none."""
    s = F.regexp_replace(strip("line"), r"^##+[#\s]*", "")
    d = lines.withColumn("s", F.when(may_be_header(F.col("line")), s))
    score, numbered, joined = header_score(F.col("s")), F.col("s").rlike(NUMBERED), lambda p: strip(F.concat_ws(" ", F.regexp_extract("s", p, 1), F.regexp_extract("s", p, 2)))
    kind = F.when(numbered | F.col("s").rlike(SPECIAL), "special_clause").when(F.col("s").rlike(COVERAGE), "coverage").when(F.col("s").rlike(APPENDIX[0]) | F.col("s").rlike(APPENDIX[1]), "appendix").when(F.col("s").rlike(ADDENDUM), "addendum")
    title = F.when(numbered, F.regexp_extract("s", NUMBERED, 2)).when((F.col("kind") == "appendix") & F.col("s").rlike(APPENDIX[0]), joined(APPENDIX[0])).when(F.col("kind") == "appendix", joined(APPENDIX[1])).otherwise(F.col("s"))
    d = d.withColumn("kind", F.when(F.col("s").isNotNull(), kind)).withColumn("score", F.when(F.col("kind").isNotNull(), score))
    header = F.when(F.col("score") >= least, F.struct(title.alias("title"), F.col("kind").alias("kind"), (F.col("score") + F.when(numbered, 2).otherwise(0)).alias("score")))
    return d.select(*lines.columns, header.alias("header"))


def headers(lines: DataFrame, least: int = LEAST_SCORE) -> DataFrame:
    """id, line_no, title, kind and score of the lines of a known kind whose score is `least` or more; leading # signs are left out."""
    return with_headers(lines.filter(may_be_header(F.col("line"))), least).filter("header IS NOT NULL").select("id", "line_no", "header.title", "header.kind", "header.score")


def segments(lines: DataFrame) -> DataFrame:
    """Each line with the segment it is in: the last header at or before it; title and kind are null before the first."""
    w = Window.partitionBy("id").orderBy("line_no")
    last = F.last("header", ignorenulls=True).over(w)
    h = with_headers(lines).withColumn("segment", F.count("header").over(w)).withColumn("last", last)
    return h.select("id", "line_no", "line", "segment", F.col("last.title").alias("title"), F.col("last.kind").alias("kind"))


# From what token estimate on (half the characters) a special clause should have articles, below which a chunk is short, and how long a title is.
MANY_TOKENS, FEW_TOKENS, SHORT_TITLE, FULL_SCORE = 1000, 50, 3, 10


def chunks(lines: DataFrame) -> DataFrame:
    """id, chunk_id, kind, title, start_line, end_line, confidence (a tenth of the header's score, 1 at most), n_chars, n_articles and warnings of each segment; of a document without headers one chunk, "document". Lines before the first header are in none."""
    scored = with_headers(lines).withColumn("segment", F.count("header").over(Window.partitionBy("id").orderBy("line_no"))).select("id", "line_no", "line", "segment", "header.title", "header.kind", "header.score")
    d = scored.withColumn("n_headers", F.max("segment").over(Window.partitionBy("id"))).filter("segment > 0 OR n_headers = 0")
    text = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n")  # the lines of one segment
    g = d.groupBy("id", "segment").agg(
        F.coalesce(F.max("kind"), F.lit("document")).alias("kind"), F.coalesce(F.max("title"), F.lit("document")).alias("title"), F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"),
        F.least(F.lit(1.0), F.coalesce(F.max("score") / FULL_SCORE, F.lit(1.0))).alias("confidence"), F.length(strip(text)).alias("n_chars"), F.count_if(strip("line").rlike(ARTICLE)).alias("n_articles"),
    )
    tokens, whole = F.floor(F.col("n_chars") / 2), F.col("kind") == "document"
    w = F.filter(F.array(
        F.when((F.col("kind") == "special_clause") & (F.col("n_articles") == 0) & (tokens > MANY_TOKENS), "no_articles"), F.when(~whole & (F.length("title") < SHORT_TITLE), "short_title"),
        F.when(~whole & (tokens < FEW_TOKENS), "short_chunk"), F.when(whole, "no_headers"),
    ), lambda x: x.isNotNull())
    name = F.when(whole, F.concat(F.col("id").cast("string"), F.lit(":doc"))).otherwise(F.concat_ws(":", F.col("id").cast("string"), "kind", F.left("title", F.lit(20))))
    return g.select("id", name.alias("chunk_id"), "kind", "title", "start_line", "end_line", "confidence", "n_chars", "n_articles", w.alias("warnings"))


def articles(lines: DataFrame) -> DataFrame:
    """id, article_no, title, start_line, end_line and the start and end offsets in the text that the lines make, joined by line feeds; an article ends where the next begins."""
    w = Window.partitionBy("id").orderBy("line_no")
    at = lines.withColumn("start", F.coalesce(F.sum(F.length("line") + 1).over(w.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0).cast("long")))
    at = at.withColumn("stop", F.col("start") + F.length("line")).withColumn("last_line", F.max("line_no").over(Window.partitionBy("id"))).withColumn("last_stop", F.max("stop").over(Window.partitionBy("id")))
    a = at.filter(strip("line").rlike(ARTICLE))
    following = Window.partitionBy("id").orderBy("line_no")
    return a.select(
        "id", F.row_number().over(following).alias("article_no"), strip("line").alias("title"), F.col("line_no").alias("start_line"),
        F.coalesce(F.lead("line_no").over(following) - 1, F.col("last_line")).alias("end_line"), F.col("start").alias("start_offset"),
        F.coalesce(F.lead("start").over(following) - 1, F.col("last_stop")).alias("end_offset"),
    )


# The headers, in order, and the articles of the simple segmenter, what no header is, and its words for a whole document.
SIMPLE_HEADERS = {
    "special_clause": r"^\s*(\d+\-\d+\.\s*)?.{2,50}(특약|특별약관)\s*$",
    "coverage": r"^\s*.{2,40}담보\s*$",
    "appendix": r"^\s*【\s*별표\s*\d+\s*】",
    "addendum": r"^\s*부\s*칙\s*$",
}
SIMPLE_ARTICLE = r"^\s*(##\s*)?(제\s*\d+\s*조)\s*(\(.+?\))?"
SIMPLE_NOISE = r"^\s*(-\s*\d+\s*-|페이지\s*\d+|<!--\s*image\s*-->)\s*$"
WITH_ARTICLES, WHOLE = ("special_clause", "coverage"), "전체문서"


def simple_segments(lines: DataFrame, headers: dict[str, str] | None = None, article: str = SIMPLE_ARTICLE) -> DataFrame:
    """id, segment, kind, title, start_line, end_line, n_chars and n_articles of what begins at each header; of a document without any the whole, of kind "document". Articles are counted in special clauses, coverages and whole documents. A line is of the first kind that it matches; leading # signs are left out, but not of appendices."""
    s = strip("line")
    bare = F.when(s.startswith("##"), strip(F.regexp_replace(s, r"^#+", ""))).otherwise(s)
    of = lambda name, p: s.rlike(p) if name == "appendix" else bare.rlike(p) & ~bare.rlike(SIMPLE_NOISE) & ((F.length(bare) > 3) if name == "coverage" else F.lit(True))
    kind = None
    for name, p in (headers or SIMPLE_HEADERS).items():
        kind = F.when(of(name, p), name) if kind is None else kind.when(of(name, p), name)
    w = Window.partitionBy("id").orderBy("line_no")
    d = lines.select("id", "line_no", "line", kind.alias("kind"), F.when(kind == "appendix", s).otherwise(bare).alias("title"), s.rlike(article).cast("int").alias("is_article"))
    d = d.withColumn("segment", F.count("kind").over(w)).withColumn("n_headers", F.count("kind").over(Window.partitionBy("id"))).filter("segment > 0 OR n_headers = 0")
    # the length of the lines joined by line feeds, without white space at the ends
    g = d.groupBy("id", F.greatest("segment", F.lit(1)).alias("segment")).agg(
        F.coalesce(F.max("kind"), F.lit("document")).alias("kind"), F.when(F.max("n_headers") == 0, WHOLE).otherwise(F.min_by("title", "line_no")).alias("title"), F.min("line_no").alias("start_line"), F.max("line_no").alias("end_line"),
        F.length(strip(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("line_no", "line"))), lambda x: x["line"]), "\n"))).cast("long").alias("n_chars"), F.sum("is_article").alias("n_articles"),
    )
    return g.withColumn("n_articles", F.when(F.col("kind").isin(*WITH_ARTICLES, "document"), F.col("n_articles")).otherwise(0))


def segment_warnings(segments: DataFrame, most: int = 12_000) -> DataFrame:
    """segments with warnings: too long, a special clause of over 500 characters without articles, a title under three characters."""
    w = F.filter(F.array(
        F.when(F.col("n_chars") > most, "too_long"), F.when((F.col("kind") == "special_clause") & (F.col("n_articles") == 0) & (F.col("n_chars") > 500), "no_articles"), F.when(F.length("title") < 3, "short_title"),
    ), lambda x: x.isNotNull())
    return segments.withColumn("warnings", w)
