"""Labels, roles, query types, channels and routes of documents, and their evaluation."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.functions.text import contains_any, ladder, occurrences

# Rules for labels, roles and query types.
SOURCE_RULES = [("(약관|terms)", "terms_and_conditions"), ("(사업방법서|business)", "business_method"), ("(요약서|summary)", "product_summary"), ("(금감원|fss|보도자료|press)", "fss_release"), ("(판례|precedent|판결)", "court_precedent")]
CONTENT_RULES = [("(보험.*약관|약관.*보험)", "terms_and_conditions"), ("(보험료.*산출|산출.*보험료)", "business_method"), ("(청구.*절차|절차.*청구)", "claims_process")]
ROLE_WORDS = [("canonical", ["약관", "보통약관", "특별약관"]), ("paraphrase", ["상품요약서", "요약서"]), ("operational", ["사업방법서"])]
OPERATION_WORDS = ["절차", "방법", "처리", "운영", "심사", "프로세스"]
EXPLANATION_WORDS = ["쉽게", "요약", "설명", "간단히", "핵심"]
# Channels with priority, primary words, synonyms and words that count against them.
CHANNELS = [
    ("제휴", 1, ["제휴", "제휴사"], ["파트너", "협력사", "제휴상품", "제휴채널", "제휴보험"], ["제휴은행", "제휴카드", "제휴할인"]),
    ("TM", 2, ["TM", "텔레마케팅"], ["전화판매", "전화영업", "아웃바운드", "인바운드"], ["ATM", "TMS"]),
    ("홈쇼핑", 3, ["홈쇼핑"], ["TV홈쇼핑", "케이블홈쇼핑", "홈쇼핑채널", "홈쇼핑몰"], []),
    ("콜센터", 4, ["콜센터"], ["고객센터", "상담센터", "고객상담", "상담원"], ["콜센터번호"]),
    ("방송", 5, ["방송"], ["TV", "텔레비전", "방송채널", "라디오"], ["방송통신", "방송법"]),
]
HEADER, FOOTER = 1000, 500


def document_label(path: Column, text: Column) -> Column:
    """Of the path's rules, then the text's, the first that matches; case doesn't matter."""
    rules = [(F.coalesce(c, F.lit("")).rlike(f"(?iu){p}"), label) for c, part in ((path, SOURCE_RULES), (text, CONTENT_RULES)) for p, label in part]
    return ladder(rules, "general")


def document_role(name: Column) -> Column:
    return ladder([(contains_any(name, words), role) for role, words in ROLE_WORDS], "canonical")


def query_type(q: Column) -> Column:
    return ladder([(contains_any(F.lower(q), OPERATION_WORDS), "operation"), (contains_any(F.lower(q), EXPLANATION_WORDS), "explanation")], "definition")


# What makes a clause risky, each with its flag and points.
EXCLUSION, PAYMENT, APPENDIX, ADDENDUM = ["지급하지", "면책", "제외"], ["지급사유", "지급"], ["별표", "부표"], ["부칙"]
RISKS = [("exclusion_clause_present", 5), ("conflict_pair_present", 5), ("appendix_table_present", 2), ("addendum_present", 1)]


def clause_risk(text: Column) -> tuple[Column, Column]:
    """Score and tier of a clause: exclusions 5, payment beside exclusion 5, appendix 2, addendum 1; L2 from 9, L1 from 5."""
    points = F.create_map(*(F.lit(x) for kv in RISKS for x in kv))
    score = F.aggregate(risk_flags(text), F.lit(0), lambda a, f: a + F.element_at(points, f))
    return score, F.when(score >= 9, "L2").when(score >= 5, "L1").otherwise("L0")


def risk_flags(text: Column) -> Column:
    """What a clause, or the titles of several joined by spaces, shows, in a fixed order. Null shows nothing."""
    t = F.coalesce(text, F.lit(""))
    has = (contains_any(t, EXCLUSION), contains_any(t, PAYMENT) & contains_any(t, EXCLUSION[:2]), contains_any(t, APPENDIX), contains_any(t, ADDENDUM))
    return F.filter(F.array(*(F.when(c, F.lit(name)) for c, (name, _) in zip(has, RISKS, strict=True))), lambda x: x.isNotNull())


def channel_candidates(documents: DataFrame) -> DataFrame:
    """id, channel, priority, n_keywords, location and confidence of every channel whose words a text has. One pass over a text; a row leaves for each match only."""

    def one(name: str, priority: int, primary: list[str], synonyms: list[str], negative: list[str]) -> Column:
        # a primary word of which another word is the beginning may count twice, as a list of searches would
        text = F.col("text")
        words = [*primary, *synonyms]
        pattern = "(?iu)" + "|".join(words)
        n = sum((occurrences(text, f"(?iu){w}") for w in words[1:]), occurrences(text, f"(?iu){words[0]}"))
        place = F.when(F.left(text, F.lit(HEADER)).rlike(pattern), "header").when((F.length(text) > FOOTER) & F.right(text, F.lit(FOOTER)).rlike(pattern), "footer").otherwise("body")
        against = text.rlike("(?iu)" + "|".join(negative)) if negative else F.lit(False)
        # in hundredths, so that equal confidences are equal numbers
        weight = F.when(place == "header", 35).when(place == "footer", 5).otherwise(10)
        confidence = F.greatest(F.lit(0), F.least(F.lit(100), 30 + weight + F.least(n, F.lit(5)) * 6 - F.when(against, 35).otherwise(0))) / 100
        # the other searches run only where this one finds something
        return F.when(text.rlike(pattern), F.struct(F.lit(name).alias("channel"), F.lit(priority).alias("priority"), n.alias("n_keywords"), place.alias("location"), confidence.alias("confidence")))

    found = F.filter(F.array(*(one(*c) for c in CHANNELS)), lambda x: x.isNotNull())
    any_word = "(?iu)" + "|".join(w for c in CHANNELS for w in (*c[2], *c[3]))
    return documents.filter(F.col("text").rlike(any_word)).select("id", F.explode(found).alias("x")).select("id", "x.*")


def filename_channel(name: Column) -> Column:
    """The first channel by priority of which a primary word stands alone in brackets."""
    return ladder([(name.rlike("(?iu)[(（](" + "|".join(c[2]) + ")[)）]"), c[0]) for c in CHANNELS], "")


def best_channel(candidates: DataFrame) -> DataFrame:
    """Per id the channel with the largest score, then the smallest priority; scores are capped at 1."""
    r = candidates.groupBy("id").agg(F.max_by(F.struct("channel", F.least("score", F.lit(1.0)).alias("score")), F.struct(F.least("score", F.lit(1.0)), -F.col("priority"))).alias("x"))
    return r.select("id", "x.channel", F.col("x.score").alias("confidence"))


def route(confidence: Column, auto: float = 0.6, review: float = 0.4) -> Column:
    return F.when(confidence >= auto, "auto").when(confidence >= review, "review").otherwise("unclassified")


def route_counts(routed: DataFrame) -> DataFrame:
    """Per route: how many, and what percentage of all."""
    return routed.groupBy("route").agg(F.count("*").alias("n")).withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


def class_scores(pairs: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """Precision, recall, F1 and support of each true class of pairs (actual, predicted), "unclassified" not being one, per keys."""
    keys = keys or []
    counted = pairs.groupBy(*keys, "actual", "predicted").agg(F.count("*").alias("n"))
    rows = counted.select(*keys, F.explode(F.array(F.struct(F.col("actual").alias("label"), F.col("n").alias("t"), F.lit(0).cast("long").alias("p"), F.when(F.col("actual") == F.col("predicted"), F.col("n")).otherwise(0).alias("tp")), F.struct(F.col("predicted").alias("label"), F.lit(0).cast("long").alias("t"), F.col("n").alias("p"), F.lit(0).cast("long").alias("tp")))).alias("x")).select(*keys, "x.*")
    s = rows.groupBy(*keys, "label").agg(F.sum("t").alias("support"), F.sum("p").alias("p"), F.sum("tp").alias("tp")).filter("support > 0 AND label <> 'unclassified'")
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    s = s.withColumn("precision", ratio(F.col("tp"), F.col("p"))).withColumn("recall", ratio(F.col("tp"), F.col("support")))
    f1 = ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
    return s.select(*keys, "label", "support", F.round("precision", 6).alias("precision"), F.round("recall", 6).alias("recall"), F.round(f1, 6).alias("f1"))


def confusion(pairs: DataFrame) -> DataFrame:
    """actual, predicted, n for all pairs of labels, with zeros."""
    labels = pairs.select(F.explode(F.array("actual", "predicted")).alias("label")).distinct()
    grid = labels.select(F.col("label").alias("actual")).crossJoin(labels.select(F.col("label").alias("predicted")))  # labels are few, rows are counted before
    return grid.join(pairs.groupBy("actual", "predicted").agg(F.count("*").alias("n")), ["actual", "predicted"], "left").select("actual", "predicted", F.coalesce("n", F.lit(0).cast("long")).alias("n"))


def threshold_sweep(scored: DataFrame, thresholds: list[float]) -> DataFrame:
    """Macro F1 at each threshold of scored (actual, predicted, confidence): below it a prediction is "unclassified". All thresholds in one pass."""
    grid = F.explode(F.array(*(F.lit(float(t)) for t in thresholds)))
    at = scored.withColumn("threshold", grid).select("threshold", "actual", F.when(F.col("confidence") >= F.col("threshold"), F.col("predicted")).otherwise("unclassified").alias("predicted"))
    return class_scores(at, ["threshold"]).groupBy("threshold").agg(F.round(F.avg("f1"), 6).alias("macro_f1"))


def macro_scores(scores: DataFrame) -> DataFrame:
    """One row: the means of what class_scores gives over its classes."""
    return scores.agg(*(F.round(F.avg(c), 6).alias(f"macro_{c}") for c in ("precision", "recall", "f1")))


def best_threshold(sweep: DataFrame) -> DataFrame:
    """One row: the threshold of the largest macro F1, the lowest of equals, and what to make of it."""
    best = sweep.agg(F.max_by(F.struct("threshold", "macro_f1"), F.struct("macro_f1", -F.col("threshold"))).alias("x")).select("x.*")
    return best.withColumn("verdict", F.when(F.col("macro_f1") >= 0.8, "good").when(F.col("macro_f1") >= 0.6, "fair").otherwise("poor"))


def needs_review(mixed: Column, confidence: Column, channel: Column, below: float = 0.5, default: str = "일반") -> Column:
    """Whether a person should look: several channels, little confidence, or no channel but the default."""
    return F.coalesce(mixed, F.lit(False)) | F.coalesce(confidence < below, F.lit(True)) | F.coalesce(channel == default, F.lit(True))


# How much each source of an ensemble counts, from what confidence on a channel is taken or reviewed, and parts that a configuration must have.
WEIGHTS = {"content": 0.6, "metadata": 0.3, "filename": 0.1}
AUTO, REVIEW, LAST_PRIORITY = 0.6, 0.4, 99
CONFIDENCE_PARTS = {"location": ["header", "body", "footer"], "frequency": ["coefficient", "max"], "penalty": ["negative"]}


def config_problems(config: dict) -> list[str]:
    """What speaks against a configuration (auto, review, weights, confidence, channels): thresholds out of range or order, weights that miss a source or don't sum to 1, and missing parts."""
    inside = lambda x: isinstance(x, (int, float)) and 0 <= x <= 1
    out = [f"{k} out of range" for k in ("auto", "review") if not inside(config.get(k))]
    if not out and config["auto"] <= config["review"]:
        out.append("auto must be above review")
    weights = config.get("weights", {})
    out += [f"weights.{k} missing" for k in WEIGHTS if k not in weights]
    if abs(sum(weights.values()) - 1) > 0.01:
        out.append("weights must sum to 1")
    parts = config.get("confidence", {})
    if not inside(parts.get("base")):
        out.append("confidence.base missing or out of range")
    out += [f"confidence.{k}.{x} missing" for k, need in CONFIDENCE_PARTS.items() for x in need if x not in parts.get(k, {})]
    return out + [f"channels.{c}.{k} out of range" for c, own in sorted(config.get("channels", {}).items()) for k in ("auto", "review") if k in own and not inside(own[k])]


def ensemble(documents: DataFrame, weights: dict[str, float] | None = None, thresholds: dict[str, tuple[float, float]] | None = None) -> DataFrame:
    """id, channel, confidence, route of documents (id, text, file_name, channel_hint, metadata_quality): of each channel that content, metadata or file name suggest the weighted sum of their confidences; the largest counts, of equals the smallest priority. Without a suggestion the channel is null and the route unclassified. thresholds: auto and review for channels that have their own."""
    w = weights or WEIGHTS
    known = F.create_map(*(F.lit(x) for name, n, *_ in CHANNELS for x in (name, n)))
    content = channel_candidates(documents).select("id", "channel", (F.col("confidence").cast("decimal(3,2)") * F.lit(Decimal(str(w["content"])))).cast("double").alias("score"))
    hint = documents.filter(F.coalesce("channel_hint", F.lit("")) != "").select("id", F.col("channel_hint").alias("channel"), (F.coalesce("metadata_quality", F.lit(0.0)) * w["metadata"]).alias("score"))
    named = documents.select("id", filename_channel(F.col("file_name")).alias("channel"), F.lit(w["filename"]).alias("score")).filter("channel <> ''")
    both = content.unionByName(hint).unionByName(named).groupBy("id", "channel").agg(F.sum("score").alias("score"))
    best = best_channel(both.withColumn("priority", F.coalesce(F.try_element_at(known, F.col("channel")), F.lit(LAST_PRIORITY))))
    auto, review = F.lit(AUTO), F.lit(REVIEW)
    for name, (a, r) in (thresholds or {}).items():
        auto, review = F.when(F.col("channel") == name, a).otherwise(auto), F.when(F.col("channel") == name, r).otherwise(review)
    d = documents.select("id").join(best, "id", "left").withColumn("confidence", F.coalesce("confidence", F.lit(0.0)))
    return d.withColumn("route", F.when(F.col("channel").isNull(), "unclassified").when(F.col("confidence") >= auto, "auto").when(F.col("confidence") >= review, "review").otherwise("unclassified"))


def channel_counts(routed: DataFrame) -> DataFrame:
    """channel, n, percent of all rows, mean_confidence of what is taken or reviewed, from routed (channel, confidence, route)."""
    taken = F.col("route").isin("auto", "review") & F.col("channel").isNotNull()
    c = routed.groupBy(F.when(taken, F.col("channel")).alias("channel")).agg(F.count("*").alias("n"), F.round(F.avg("confidence"), 6).alias("mean_confidence"))
    return c.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6)).filter("channel IS NOT NULL")  # a row a channel
