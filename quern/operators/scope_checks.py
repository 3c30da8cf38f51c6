"""Whether answers keep to the scope they were asked in, which scopes a question is about, and what a batch of answers holds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import strip

# Articles, wording that decides, and wording that leaves the scope.
ARTICLE = r"(제\s*\d+\s*조)"
DECISIVE = r"(반드시|항상|전부|무조건|확실히|명백히|지급됩니다|지급되지 않습니다|보장됩니다|보장되지 않습니다)"
EXTERNAL = r"(다른\s*(특약|약관|담보)|일반적으로|통상적으로|보험\s*상식|별도\s*확인|추가\s*문의)"
DECIDED = ["보장", "비보장"]
ERRORS = ["missing_quote", "unsupported_quote", "unknown_article", "out_of_scope_name", "unsupported_claim"]


def quoted(quote: Column, scope: Column, least: float = 0.5) -> Column:
    """Whether a quote stands in the scope but for white space, or shares at least that part of its distinct words with it."""
    bare = lambda c: F.regexp_replace(c, r"\s+", "")
    words = lambda c: F.array_distinct(F.filter(F.split(c, r"\s+"), lambda x: x != ""))
    mine = words(quote)
    return F.contains(bare(scope), bare(quote)) | (F.size(F.array_intersect(mine, words(scope))) >= least * F.size(mine))


# Fixed values of the validator: wording that refers beyond the scope, and wording that guesses.
BEYOND = [r"다른\s*(특약|약관|담보)", r"(별도의|추가)\s*(특약|약관|담보)", r"(주계약|보통약관).*확인", r"일반적으로|통상적으로|보통|대체로", r"보험\s*상식|일반\s*원칙", r"(다른|별도)\s*조항.*참조", r"(해당|이)\s*문서\s*(외|밖)"]
GUESSING = [r"(아마도|아마|추측|예상)", r"(~일\s*것|~로\s*보임|~인\s*듯)", r"(명확하지\s*않지만|확실하지\s*않지만).*단정"]
#: Characters of what texts and titles are joined by.
GRAM = 5
#: Titles of which a question across all scopes may hold a list.
MOST_TITLES = 10_000


def mentions(texts: DataFrame, titles: DataFrame) -> DataFrame:
    """id, title: each title (title, not empty) that stands in a text (id, text).

    Each title is looked up by its rarest run of GRAM characters among all titles' (a shorter one by itself), so that a word
    which all titles begin with brings no candidates; a text offers its distinct runs. An equi-join, then the test itself.
    """
    known = titles.select("title").filter("title <> ''").distinct()
    runs = lambda c, n: F.regexp_extract_all(c, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
    grams = known.select("title", F.explode(F.when(F.length("title") < GRAM, F.array("title")).otherwise(F.array_distinct(runs(F.col("title"), GRAM)))).alias("gram"))
    rarity = grams.groupBy("gram").agg(F.count("*").alias("n"))
    keyed = grams.hint("merge").join(rarity, "gram").groupBy("title").agg(F.min_by("gram", F.struct("n", "gram")).alias("gram"))
    lengths = {r["length"]: r["n"] for r in keyed.groupBy(F.length("gram").alias("length")).agg(F.count("*").alias("n")).collect()}  # 1 to GRAM
    if not lengths:
        return texts.select("id", F.lit("").alias("title")).limit(0)
    offered = texts.filter("text IS NOT NULL").select("id", "text", F.explode(F.array_distinct(F.flatten(F.array(*(runs(F.col("text"), n) for n in sorted(lengths)))))).alias("gram"))
    # the text itself is joined again for candidates only. Neither texts nor their runs are ever broadcast, however small their files are
    looked_up = F.broadcast(keyed) if sum(lengths.values()) <= MOST_TITLES else keyed.hint("merge")
    met = offered.select("id", "gram").join(looked_up, "gram").select("id", "title").distinct()
    return met.join(texts.select("id", "text").hint("merge"), "id").filter(F.contains("text", "title")).select("id", "title").distinct()


def violations(answers: DataFrame, evidence: DataFrame, titles: DataFrame) -> DataFrame:
    """answers (id, scope_title, scope_text, answer, decision, exclusions_checked) with `violations`, the sorted kinds, and valid (no error among them).

    evidence: id, quote, article. titles: all scope titles (title). Null texts count as empty.
    """
    text = lambda c: strip(F.coalesce(c, F.lit("")))
    cited = evidence.join(answers.select("id", "scope_text"), "id")
    absent = F.exists(F.regexp_extract_all(text("article"), F.lit(ARTICLE), F.lit(1)), lambda a: ~F.contains(F.coalesce("scope_text", F.lit("")), a))
    per = cited.groupBy("id").agg(F.count("*").alias("n"), F.max((text("quote") != "") & ~quoted(text("quote"), F.coalesce("scope_text", F.lit("")))).alias("unquoted"), F.max(absent).alias("unknown"))
    own = answers.select("id", "scope_title").distinct()
    named = mentions(answers.select("id", F.col("answer").alias("text")), titles).join(own, "id").filter(~F.col("title").eqNullSafe(F.col("scope_title"))).select("id").distinct()
    a = answers.join(per, "id", "left").join(named.withColumn("named", F.lit(True)), "id", "left")
    none = F.coalesce("n", F.lit(0)) == 0
    kinds = [
        (none, "missing_quote"), (F.col("unquoted"), "unsupported_quote"), (F.col("unknown"), "unknown_article"), (F.col("named"), "out_of_scope_name"),
        (text("answer").rlike(EXTERNAL), "external_reference"), (text("answer").rlike(DECISIVE) & none, "unsupported_claim"),
        (F.col("decision").isin(DECIDED) & ~F.coalesce("exclusions_checked", F.lit(False)), "exclusions_not_checked"),
    ]
    found = F.array_sort(F.filter(F.array(*(F.when(c, F.lit(k)) for c, k in kinds)), lambda x: x.isNotNull()))
    return a.withColumn("violations", found).withColumn("valid", ~F.arrays_overlap("violations", F.array(*map(F.lit, ERRORS)))).drop("n", "unquoted", "unknown", "named")


def validated(answers: DataFrame, evidence: DataFrame, titles: DataFrame) -> DataFrame:
    """answers (id, scope_title, scope_text, answer, decision, exclusions_checked) with problems, in a fixed order, valid, severity and action: "retry" where another scope is named or an article cited that the scope lacks, "accept_with_warning" for other problems, else "accept". evidence: id, article. titles: title."""
    text = lambda c: F.coalesce(c, F.lit(""))
    number = lambda c: F.regexp_extract(text(c), r"제\s*(\d+)\s*조", 1)
    numbers = F.regexp_extract_all(text("scope_text"), F.lit(r"제\s*(\d+)\s*조"), F.lit(1))
    cited = evidence.join(answers.select("id", numbers.alias("numbers")), "id")
    per = cited.groupBy("id").agg(F.count("*").alias("n"), F.max((number("article") != "") & ~F.array_contains("numbers", number("article"))).alias("foreign"))
    own = answers.select("id", "scope_title").distinct()
    named = mentions(answers.select("id", F.col("answer").alias("text")), titles).join(own, "id").filter(~F.col("title").eqNullSafe(F.col("scope_title"))).select("id", F.lit(True).alias("named")).distinct()
    a = answers.join(per, "id", "left").join(named, "id", "left")
    none = F.coalesce("n", F.lit(0)) == 0
    some = lambda patterns: text("answer").rlike("|".join(f"(?:{p})" for p in patterns))
    rules = [
        ("other_scope", F.col("named")), ("external_reference", some(BEYOND)), ("foreign_article", F.col("foreign")), ("speculation", some(GUESSING)),
        ("exclusions_not_checked", (F.col("decision") == DECIDED[0]) & ~F.coalesce("exclusions_checked", F.lit(False))), ("missing_evidence", F.col("decision").isin(DECIDED) & none),
    ]
    a = a.withColumn("problems", F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in rules)), lambda x: x.isNotNull())).drop("n", "foreign", "named")
    grave = F.arrays_overlap("problems", F.array(F.lit("other_scope"), F.lit("foreign_article")))
    clean = F.size("problems") == 0
    return a.withColumns({
        "valid": clean, "severity": F.when(clean, "none").when(grave, "error").otherwise("warning"), "action": F.when(clean, "accept").when(grave, "retry").otherwise("accept_with_warning"),
    })


def force_insufficient(checked: DataFrame) -> DataFrame:
    """What violations() gives, with the decision of invalid answers made insufficient and their confidence 0."""
    return checked.withColumn("decision", F.when(F.col("valid"), F.col("decision")).otherwise("insufficient")).withColumn("confidence", F.when(F.col("valid"), F.col("confidence")).otherwise(0.0))


# What a retry is told.
RETRY_HEAD = "이전 답변에서 다음 문제가 발견되었습니다:"
RETRY_RULES = ["", "다음 규칙을 지켜 다시 답변하세요:", "1. 반드시 <SCOPE> 텍스트에서만 근거를 인용하세요.", "2. 인용문(quote)은 원문 그대로 작성하세요.", "3. 다른 특약/약관을 언급하지 마세요.", "4. 근거가 없으면 '근거부족'으로 답하세요."]


def retry_prompt(problems: Column) -> Column:
    """What to ask again with, naming each problem (an array of texts); null where there is none."""
    listed = F.transform(problems, lambda p: F.concat(F.lit("- "), p))
    return F.when(F.size(problems) > 0, F.array_join(F.concat(F.array(F.lit(RETRY_HEAD)), listed, F.array(*map(F.lit, RETRY_RULES))), "\n"))


def routed(questions: DataFrame, titles: DataFrame, across: str = r"(비교|차이|모든\s*특약|전체)") -> DataFrame:
    """questions (id, question) with scopes: the sorted titles a question names; all titles if it names none but compares; none, which means every scope, otherwise."""
    known = titles.filter("title <> ''").select("title").distinct()
    if known.limit(MOST_TITLES + 1).count() > MOST_TITLES:
        raise ValueError(f"more than {MOST_TITLES} titles: a question across all of them would hold them all")
    every = known.agg(F.array_sort(F.collect_list("title")).alias("all"))  # one row of MOST_TITLES at most
    named = mentions(questions.select("id", F.col("question").alias("text")), known).groupBy("id").agg(F.array_sort(F.collect_set("title")).alias("named"))
    q = questions.hint("merge").join(named.hint("merge"), "id", "left").crossJoin(F.broadcast(every))
    none = F.array().cast("array<string>")
    return q.select("id", "question", F.when(F.size(F.coalesce("named", none)) > 0, F.col("named")).when(F.col("question").rlike(across), F.col("all")).otherwise(none).alias("scopes"))


def batch_summary(merged: DataFrame) -> DataFrame:
    """One row: how many answers, with warnings and with conflicts, and the sorted distinct conditions and exclusions of all. Only distinct ones are gathered."""
    none = F.array().cast("array<string>")
    size = lambda c: F.size(F.coalesce(c, none))
    counts = merged.agg(F.count("*").alias("n"), F.coalesce(F.sum(size("warnings")), F.lit(0)).alias("n_warnings"), F.count_if("conflict").alias("n_conflicts"))
    union = lambda c: merged.select(F.explode(c).alias("x")).distinct().agg(F.array_sort(F.collect_list("x")).alias(c))
    return counts.crossJoin(union("conditions")).crossJoin(union("exclusions"))  # one row each
