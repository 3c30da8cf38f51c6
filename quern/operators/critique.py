"""Compliance and critique of generated examples: what a text must not have, and scores from 1 to 10 with their mean."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import contains_any, literal_count, strip

# Personal data, words that don't belong, marks of formal speech, honorifics, and when these are due.
PERSONAL = [r"\d{2,4}[-]\d{2,4}[-]\d{2,4}", r"\d{3}-\d{2}-\d{4}", r"\d{2,3}-\d{3,4}-\d{4}", r"01[016]-\d{3,4}-\d{7}", r"[a-zA-Z0-9._%+-]+@[a-zA-Z0-9.-]+\.[a-zA-Z]{2,}"]
SLURS = ["씨발", "개새끼", "미친", "병신", "존나게", "놈", "좆", "미친놈", "쌉년", "한심"]
FORMAL = ["~입니다", "~니다", "~해야 합니다", "~하십시오"]
HONORIFICS, ASKING = ["님", "씨", "선생님", "교수님", "박사님"], ["질문", "문의"]
MOST_CHARACTERS = 4 * 2048
# Words that join sentences, particles, and what a mean score says, the first reached counting.
JOINING = ["그러나", "따라서", "그리고", "또한", "이 때문에"]
PARTICLES = ["은는", "이가", "을를", "의", "에", "에서", "으로", "까지"]
VERDICTS = [(9.0, "매우 우수한 품질을 보입니다."), (8.0, "우수한 품질을 보입니다."), (7.0, "양호한 품질을 보입니다."), (6.0, "일부 개선이 필요합니다."), (4.0, "상당한 개선이 필요합니다."), (float("-inf"), "전면적인 재작성이 필요합니다.")]
PASSING = 7.0


def tokens(text: Column) -> Column:
    """What stands between white space."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), r"(?U)\s+"), lambda x: x != "")


def compliance(text: Column, formal: list[str] = FORMAL, slurs: list[str] = SLURS) -> Column:
    """A struct of violations, in a fixed order, and passed: personal data, slurs and informal speech fail; missing honorifics and length don't. Null counts as empty."""
    t = F.coalesce(text, F.lit(""))
    polite = F.arrays_overlap(tokens(t), F.array(*map(F.lit, HONORIFICS))) | ~contains_any(t, ASKING)
    rules = [
        ("personal_data", t.rlike("|".join(f"(?:{p})" for p in PERSONAL))), ("slur", contains_any(t, slurs)), ("informal", ~contains_any(t, formal)),
        ("no_honorifics", ~polite), ("too_long", F.length(t) > MOST_CHARACTERS),
    ]
    found = F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in rules)), lambda x: x.isNotNull())
    return F.struct(found.alias("violations"), (~F.arrays_overlap(found, F.array(*map(F.lit, ["personal_data", "slur", "informal"])))).alias("passed"))


def coherence(text: Column, joining: list[str] = JOINING) -> Column:
    """3 under 50 characters, 5 without a full stop, else 3 and a half for each sentence with a joining word."""
    linked = F.size(F.filter(F.split(text, r"\."), lambda s: contains_any(s, joining)))
    return F.when(F.length(text) < 50, 3.0).when(~F.contains(text, F.lit(".")), 5.0).otherwise(F.least(F.lit(10.0), 3.0 + 0.5 * linked))


def shared(of: Column, among: Column) -> Column:
    """The share of distinct words of a text that another has."""
    words = F.array_distinct(tokens(of))
    return F.size(F.array_intersect(words, tokens(among))) / F.greatest(F.size(words), F.lit(1))


def fluency(text: Column, particles: list[str] = PARTICLES) -> Column:
    """4, up to 2 for particles, and up to 2 for full stops and other ends of sentences."""
    n = sum((F.contains(text, F.lit(p)).cast("int") for p in particles), F.lit(0))
    marks = sum((literal_count(text, F.lit(m)) for m in ".!?"), F.lit(0))
    return F.least(F.lit(10.0), 4.0 + n / len(particles) * 2.0 + F.least(F.lit(2.0), marks.cast("double")))


def clarity(text: Column) -> Column:
    """3 under 20 characters or without a sentence, else 8, or 6 where sentences are over 200 or under 10 characters on the mean."""
    sentences = F.filter(F.transform(F.split(text, r"\."), lambda s: strip(s)), lambda s: s != "")
    mean = F.aggregate(sentences, F.lit(0), lambda a, s: a + F.length(s)) / F.size(sentences)
    return F.when((F.length(text) < 20) | (F.size(sentences) == 0), 3.0).when((mean > 200) | (mean < 10), 6.0).otherwise(8.0)


def critique(examples: DataFrame, joining: list[str] = JOINING, particles: list[str] = PARTICLES) -> DataFrame:
    """examples (instruction, context, output) with coherence, accuracy, completeness, korean, clarity, overall, passed (overall from PASSING on) and verdict. Null texts count as empty."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    out = text("output")
    d = examples.withColumns({
        "coherence": coherence(out, joining), "accuracy": F.least(F.lit(10.0), 4.0 + 6.0 * shared(out, text("context"))),
        "completeness": F.when(F.length(out) < 100, 3.0).otherwise(F.least(F.lit(10.0), 3.0 + 7.0 * shared(text("instruction"), out))),
        "korean": fluency(out, particles), "clarity": clarity(out),
    })
    d = d.withColumn("overall", (F.col("coherence") + F.col("accuracy") + F.col("completeness") + F.col("korean") + F.col("clarity")) / 5)
    verdict = None
    for least, words in VERDICTS:
        c = F.col("overall") >= least
        verdict = F.when(c, words) if verdict is None else verdict.when(c, words)
    return d.withColumn("passed", F.col("overall") >= PASSING).withColumn("verdict", verdict)
