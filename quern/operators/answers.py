"""Checks on distilled records and the merging of answers from several scopes."""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import strip

# Wording that gives away reasoning, generalises or claims too much.
LEAKS = [r"\b생각(해보면|하면|해 봅시다)\b", r"\b추론\b", r"\b단계(별|적으로)\b", r"\b먼저\b.*\b다음\b", r"\blet'?s think\b", r"\bchain of thought\b", r"\bstep\s*by\s*step\b"]
GENERIC = [r"\b일반적으로\b", r"\b보통\b", r"\b대개\b", r"\b통상\b", r"\b대부분\b"]
CERTAIN = [r"\b반드시\b", r"\b무조건\b", r"\b항상\b", r"\b확실히\b"]
# Phrases an answer mustn't have, and how strong a decision is.
FORBIDDEN = ["보장됩니다", "지급됩니다", "확실합니다", "틀림없이", "반드시", "100%"]
PRIORITY = {"not_covered": 3, "conditional": 2, "covered": 1, "insufficient": 0}


def any_of(text: Column, patterns: list[str]) -> Column:
    """Whether a text matches one of the patterns. Its plain words, if a pattern begins with one, are looked for before."""
    found = text.rlike("(?iU)" + "|".join(f"(?:{p})" for p in patterns))
    words = [m[1] if (m := re.match(r"\\b\(?([가-힣]+)", p)) else None for p in patterns]
    latin = [p for p, w in zip(patterns, words, strict=True) if not w]
    held = [F.contains(text, F.lit(w)) for w in words if w] + ([text.rlike("(?iU)" + "|".join(p.replace("\\b", "") for p in latin))] if latin else [])
    return F.when(reduce(Column.__or__, held), found).otherwise(F.when(text.isNotNull(), False))


def leak(text: Column) -> Column:
    """The first of LEAKS that a text shows; null if none."""
    return F.coalesce(*(F.when(any_of(text, [p]), F.lit(p)) for p in LEAKS))


def token_set(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(text, F.lit("([A-Za-z0-9가-힣]{2,})"), F.lit(1)))


def grounded(output: Column, canonical: Column) -> Column:
    """Whether one of the phrases of four words at places 0, 3, 6, ... below 40 of output stands in canonical; outputs of fewer than 8 words count as grounded."""
    # no more than the first 44 words matter: what is behind them isn't cut into words
    words = F.regexp_extract_all(F.regexp_extract(output, r"(?s)^(?:.*?[A-Za-z0-9가-힣]{2,}+){0,44}+", 0), F.lit("([A-Za-z0-9가-힣]{2,})"), F.lit(1))
    last = F.least(F.size(words) - 3, F.lit(40)) - 1
    phrases = F.transform(F.sequence(F.lit(0), F.greatest(last, F.lit(0)), F.lit(3)), lambda i: F.array_join(F.slice(words, i + 1, 4), " "))
    return (F.size(words) < 8) | F.exists(phrases, lambda p: F.contains(canonical, p))


def findings(records: DataFrame) -> DataFrame:
    """records (id, instruction, canonical, summary, operational, output, product_id, version) with codes, in a fixed order, and ok (no failing code)."""
    text = lambda c: F.coalesce(F.col(c), F.lit(""))
    out, n = strip(text("output")), F.length(strip(text("output")))
    has = lambda c: strip(text(c)) != ""
    tokens = token_set(text("output"))
    share = lambda c: F.size(F.array_intersect(tokens, token_set(text(c)))) / F.greatest(F.size(tokens), F.lit(1))
    # the cheap conditions first: without a summary or operational text nothing is cut into words
    dominant = F.when(has("canonical") & (has("summary") | has("operational")), ((share("summary") > 0.25) | (share("operational") > 0.25)) & (share("canonical") < 0.18)).otherwise(False)
    rules = [
        ("fail:schema.instruction", ~has("instruction")), ("fail:schema.output", ~has("output")), ("fail:schema.canonical", ~has("canonical")),
        ("warn:meta.product_id", ~has("product_id")), ("warn:meta.version", ~has("version")),
        ("fail:quality.reasoning_leak", any_of(out, LEAKS)), ("warn:quality.too_short", (n > 0) & (n < 20)), ("warn:quality.too_long", n > 1200),
        ("warn:grounding.summary_operational_dominant", dominant),
        ("warn:grounding.weak", has("canonical") & has("output") & ~grounded(text("output"), text("canonical"))),
        ("warn:tone.generic", any_of(out, GENERIC)), ("warn:tone.certain", any_of(out, CERTAIN)),
    ]
    codes = F.filter(F.array(*(F.when(c, F.lit(code)) for code, c in rules)), lambda x: x.isNotNull())
    return records.withColumn("codes", codes).withColumn("ok", ~F.exists("codes", lambda x: x.startswith("fail:")))


def forbidden(text: Column) -> Column:
    return F.filter(F.array(*(F.lit(p) for p in FORBIDDEN)), lambda p: F.contains(text, p))


def merge(results: DataFrame) -> DataFrame:
    """One row for each doc_id and question of results (doc_id, question, ord, decision, n_evidence, exclusions_checked, n_exclusions, confidence): the final decision by priority, then confidence, then place; without evidence confidence is at most .55; covered with unchecked exclusions is conditional and at most .7. conflict: both covered and not."""
    unchecked = (F.col("decision") == "covered") & ~F.coalesce("exclusions_checked", F.lit(False))
    c = F.when(F.col("n_evidence") > 0, F.col("confidence")).otherwise(F.least("confidence", F.lit(0.55)))
    r = results.withColumn("confidence", F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(unchecked, F.least(c, F.lit(0.7))).otherwise(c))))
    r = r.withColumn("decision", F.when(unchecked, "conditional").otherwise(F.col("decision")))
    prio = F.coalesce(F.element_at(F.create_map(*(F.lit(x) for kv in PRIORITY.items() for x in kv)), F.col("decision")), F.lit(0))
    return r.groupBy("doc_id", "question").agg(
        F.max_by("decision", F.struct(prio, "confidence", -F.col("ord"))).alias("final_decision"), F.max_by("confidence", F.struct(prio, "confidence", -F.col("ord"))).alias("confidence"),
        F.count_if(F.col("n_evidence") == 0).alias("n_warnings"),
        (F.max(F.col("decision") == "covered") & F.max(F.col("decision") == "not_covered")).alias("conflict"), F.sum("n_exclusions").alias("n_exclusions"),
    )


# What is added where exclusions were not checked, and the parts of a merged answer.
UNCHECKED = "미지급/면책 조항 확인 필요"
PARTS = {"question": "## 질문", "decision": "## 판단", "main": "## 주요 근거", "quotes": "### 인용 근거", "conditions": "## 충족 필요 조건", "exclusions": "## 주의: 면책/미지급 사유", "others": "## 기타 특약/담보 판단"}
CLOSING = "*본 판단은 제공된 약관 텍스트만을 근거로 하며, 최종 보험금 지급 여부는 보험사의 심사를 따릅니다.*"
MOST_QUOTES = 3


def normalised(results: DataFrame) -> DataFrame:
    """results (scope_id, decision, evidence, exclusions_checked, conditions, confidence) with warnings: without evidence confidence is at most .55; covered with unchecked exclusions becomes conditional with a condition more, at most .7; confidence is from 0 to 1."""
    bare, unchecked = F.size(F.coalesce("evidence", F.array())) <= 0, (F.col("decision") == "covered") & ~F.coalesce("exclusions_checked", F.lit(False))
    c = F.when(bare, F.least("confidence", F.lit(0.55))).otherwise(F.col("confidence"))
    conditions = F.coalesce("conditions", F.array().cast("array<string>"))
    warned = F.filter(F.array(F.when(bare, F.concat(F.lit("Missing evidence: "), "scope_id")), F.when(unchecked, F.concat(F.lit("Covered without exclusions_checked → downgrade: "), "scope_id"))), lambda x: x.isNotNull())
    return results.withColumns({
        "confidence": F.greatest(F.lit(0.0), F.least(F.lit(1.0), F.when(unchecked, F.least(c, F.lit(0.7))).otherwise(c))), "warnings": warned,
        "conditions": F.when(unchecked, F.concat(conditions, F.array(F.lit(UNCHECKED)))).otherwise(conditions), "decision": F.when(unchecked, "conditional").otherwise(F.col("decision")),
    })


def merged(results: DataFrame) -> DataFrame:
    """One row for each doc_id and question of results (doc_id, question, ord, scope_id, scope_title, decision, answer, evidence array<struct<article, quote>>, exclusions_checked, exclusions array<string>, conditions array<string>, confidence): final_decision, confidence, warnings by ord, conflicts (decision_conflict, exclusion_found), conditions and exclusions (sorted, distinct) and the answer as Markdown. The scopes asked one question are gathered, by priority, confidence and ord."""
    none = F.array().cast("array<string>")
    prio = F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in PRIORITY.items() for x in kv)), F.col("decision")), F.lit(0))
    n = normalised(results).withColumn("exclusions", F.coalesce("exclusions", none))
    x = F.struct((-prio).alias("p"), (-F.col("confidence")).alias("c"), "ord", "scope_title", "decision", "confidence", "answer", "evidence", "conditions", "exclusions", "warnings")
    g = n.groupBy("doc_id", "question").agg(F.sort_array(F.collect_list(x)).alias("all"))
    distinct = lambda c: F.sort_array(F.array_distinct(F.flatten(F.transform("all", lambda r: r[c]))))
    has = lambda d: F.exists("all", lambda r: r["decision"] == d)
    g = g.withColumns({
        "warnings": F.flatten(F.transform(F.sort_array(F.transform("all", lambda r: F.struct(r["ord"].alias("ord"), r["warnings"].alias("warnings")))), lambda r: r["warnings"])), "conditions": distinct("conditions"), "exclusions": distinct("exclusions"), "top": F.get("all", F.lit(0)),
        "conflicts": F.filter(F.array(F.when(has("covered") & has("not_covered"), "decision_conflict"), F.when(F.exists("all", lambda r: F.size(r["exclusions"]) > 0), "exclusion_found")), lambda c: c.isNotNull()),
    })
    percent = lambda c: F.format_string("%.0f%%", 100 * c)
    items = lambda head, c: F.when(F.size(c) > 0, F.concat(F.lit(f"\n{head}\n"), F.array_join(F.transform(c, lambda v: F.concat(F.lit("- "), v)), "\n")))
    quotes = F.transform(F.slice(F.coalesce("top.evidence", F.array()), 1, MOST_QUOTES), lambda e: F.concat(F.coalesce(e["article"], F.lit("")), F.lit(': "'), F.coalesce(e["quote"], F.lit("")), F.lit('"')))
    others = F.transform(F.slice("all", F.lit(2), F.size("all")), lambda r: F.concat(F.lit("**"), r["scope_title"], F.lit("**: "), r["decision"], F.lit(" (신뢰도: "), percent(r["confidence"]), F.lit(")")))
    text = F.concat_ws(
        "\n", F.concat(F.lit(PARTS["question"] + "\n"), "question", F.lit("\n")), F.concat(F.lit(PARTS["decision"] + "\n**"), "top.decision", F.lit("**\n")),
        F.concat(F.lit(PARTS["main"] + "\n**"), "top.scope_title", F.lit("** (신뢰도: "), percent(F.col("top.confidence")), F.lit(")\n")), strip(F.coalesce("top.answer", F.lit(""))),
        items(PARTS["quotes"], quotes), items(PARTS["conditions"], F.col("conditions")), items(PARTS["exclusions"], F.col("exclusions")), items(PARTS["others"], others), F.lit("\n---\n" + CLOSING),
    )
    return g.select("doc_id", "question", F.col("top.decision").alias("final_decision"), F.col("top.confidence").alias("confidence"), "warnings", "conflicts", "conditions", "exclusions", text.alias("answer"))


def pii(text: Column) -> Column:
    """Which personal data a text shows: e-mail, telephone, resident number, card, IP address."""
    rules = [("email", r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"), ("phone", r"01[016789]-?[0-9]{3,4}-?[0-9]{4}"), ("resident", r"[0-9]{6}-[1-4][0-9]{6}"), ("card", r"[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}"), ("ip", r"[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}\.[0-9]{1,3}")]
    return F.filter(F.array(*(F.when(text.rlike(p), F.lit(k)) for k, p in rules)), lambda x: x.isNotNull())


def vocabulary(documents: DataFrame) -> DataFrame:
    """word, df, idf of documents (id, words array): idf is documents / (df + 1)."""
    n = documents.agg(F.count("*").alias("n"))
    df = documents.select(F.explode(F.array_distinct("words")).alias("word")).groupBy("word").agg(F.count("*").alias("df"))
    return df.crossJoin(F.broadcast(n)).select("word", "df", F.round(F.col("n") / (F.col("df") + 1), 6).alias("idf"))  # n is one row
