"""Channels of documents by a table of rules: metadata before file name, header, body and footer.

Rules are rows (channel, kind, word, priority): kind is "keyword" (a word of the text), "exclude" (a word that rules the
channel out), or "filename" (a pattern of file names). All words of a text are found in one scan with one pattern: at each
place the longest word that begins there, from which the shorter ones that begin it follow. The rules, which are counted
before they are collected, become one expression; documents are only projected.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import strip

# How much a match tells by its place, and the sizes of header and footer in characters.
CONFIDENCE = {"metadata": 1.0, "filename": 0.95, "header": 0.9, "body": 0.7, "footer": 0.6}
HEADER, FOOTER = 1000, 300
DEFAULT, MIXED_FROM = "일반", 0.3
STRATEGIES = ("frequency", "priority", "manual")
MOST_RULES = 10_000


@dataclass
class Rules:
    """channels: (name, priority) in order of priority, then name; words: by word the places in `channels` it stands for and those it rules out; patterns: by place the file name pattern."""

    channels: list[tuple[str, int]]
    words: dict[str, tuple[list[int], list[int]]]
    patterns: dict[int, str]

    @property
    def pattern(self) -> str:
        """Finds, at every place of a text, the longest word that begins there."""
        quoted = ("\\Q" + w.replace("\\E", "\\E\\\\E\\Q") + "\\E" for w in sorted(self.words, key=lambda w: (-len(w), w)))
        # most places are passed by their first letter
        first = "".join(f"\\x{{{ord(c):x}}}" for c in sorted({w[0] for w in self.words}))
        return f"(?=[{first}])(?=({'|'.join(quoted)}))"

    def begun_by(self, word: str) -> tuple[list[int], list[int]]:
        """What a word and all words that begin it stand for and rule out."""
        own = [self.words[word[:n]] for n in range(1, len(word) + 1) if word[:n] in self.words]
        return tuple(sorted({i for x in own for i in x[k]}) for k in (0, 1))


def compiled(rules: DataFrame) -> Rules:
    """The rules of a table; more than MOST_RULES are refused, as they'd not fit an expression."""
    rows = rules.select("channel", "kind", "word", "priority").filter("channel IS NOT NULL AND word <> ''").distinct().limit(MOST_RULES + 1).collect()
    if len(rows) > MOST_RULES:
        raise ValueError(f"more than {MOST_RULES} rules")
    least: dict[str, int] = {}
    for r in rows:
        least[r.channel] = min(least.get(r.channel, 99), 99 if r.priority is None else r.priority)
    channels = sorted(least.items(), key=lambda c: (c[1], c[0]))
    place = {c: i for i, (c, _) in enumerate(channels)}
    words: dict[str, tuple[list[int], list[int]]] = {}
    patterns: dict[int, list[str]] = {}
    for r in sorted(rows, key=lambda r: (r.channel, r.kind, r.word)):
        if r.kind == "filename":
            patterns.setdefault(place[r.channel], []).append(r.word)
        elif r.kind in ("keyword", "exclude"):
            words.setdefault(r.word, ([], []))[r.kind == "exclude"].append(place[r.channel])
        else:
            raise ValueError(f"unknown kind of rule: {r.kind}")
    return Rules(channels, words, {i: "|".join(p) for i, p in patterns.items()})


def regions(text: Column) -> dict[str, Column]:
    """The first HEADER and the last FOOTER characters, and what is between if there is anything; a text of up to FOOTER characters has no footer."""
    n = F.length(text)
    return {
        "header": F.left(text, F.lit(HEADER)),
        "body": F.when(n > HEADER + FOOTER, F.substring(text, F.lit(HEADER + 1), n - HEADER - FOOTER)).otherwise(""),
        "footer": F.when(n > FOOTER, F.right(text, F.lit(FOOTER))).otherwise(""),
    }


def classify(documents: DataFrame, rules: Rules, strategy: str = "frequency") -> DataFrame:
    """documents (metadata array<string>, file_name, text, and any columns) with channel, confidence, source, mixed and candidates.

    A channel counts with the most telling place that names it: a metadata value that holds its name (the first such
    channel of the first such value), the file name, or the first region of the text that has one of its words, if no word
    that excludes it is in the text. The surest channel comes first, of equals that of the smaller priority; mixed tells
    whether the second is MIXED_FROM as sure at least. strategy "priority" names the candidate of the smallest priority
    instead; the others name the surest. Nothing found: DEFAULT, 0, "none".
    """
    if strategy not in STRATEGIES:
        raise ValueError(f"strategy must be one of {STRATEGIES}")
    names = [c for c, _ in rules.channels]
    text = F.coalesce(F.col("text"), F.lit(""))
    none = F.array().cast("array<int>")
    d = documents
    # the words of each region as one array; which channels they mean is looked up by word
    if rules.words:
        lookup = lambda k: F.create_map(*(x for w in rules.words for x in (F.lit(w), F.array(*map(F.lit, rules.begun_by(w)[k])).cast("array<int>"))))
        meant = lambda found, k: F.array_distinct(F.flatten(F.transform(found, lambda w: F.element_at(lookup(k), w))))
        scan = lambda part: F.array_distinct(F.regexp_extract_all(part, F.lit(rules.pattern), 1))
        d = d.withColumns({f"__{r}": scan(part) for r, part in regions(text).items()} | {"__all": scan(text) if any(x[1] for x in rules.words.values()) else F.array().cast("array<string>")})
        d = d.withColumns({f"__{r}": meant(F.col(f"__{r}"), 0) for r in ("header", "body", "footer")} | {"__out": meant(F.col("__all"), 1)}).drop("__all")
    else:
        d = d.withColumns({f"__{r}": none for r in ("header", "body", "footer", "out")})
    named = F.transform(F.coalesce("metadata", F.array().cast("array<string>")), lambda v: F.coalesce(*(F.when(F.contains(strip(v), F.lit(c)), i) for i, c in enumerate(names)), F.lit(-1)) if names else F.lit(-1))
    d = d.withColumn("__named", F.coalesce(F.get(F.filter(named, lambda i: i >= 0), F.lit(0)), F.lit(-1)))

    def one(i: int) -> Column:
        """The place that tells most of channel i."""
        in_region = lambda r: F.array_contains(f"__{r}", i) & ~F.array_contains("__out", i)
        cases = F.when(F.col("__named") == i, "metadata")
        if i in rules.patterns:
            cases = cases.when(F.col("file_name").rlike(rules.patterns[i]), "filename")
        for r in ("header", "body", "footer"):
            cases = cases.when(in_region(r), r)
        return cases

    sure = F.create_map(*(F.lit(x) for kv in CONFIDENCE.items() for x in kv))
    found = F.filter(F.array(*(F.struct(one(i).alias("source"), F.lit(i).alias("place"), F.lit(c).alias("channel")) for i, c in enumerate(names))), lambda x: x["source"].isNotNull()) if names else F.array().cast("array<struct<source:string,place:int,channel:string>>")
    # channels stand in order of priority, so the place settles equal confidences
    ranked = F.array_sort(F.transform(found, lambda x: F.struct((-F.element_at(sure, x["source"])).alias("minus"), x["place"].alias("place"), x["channel"].alias("channel"), x["source"].alias("source"))))
    d = d.withColumn("__ranked", ranked)
    top, second = (F.get("__ranked", F.lit(i)) for i in (0, 1))
    chosen = F.array_min(F.transform("__ranked", lambda x: F.struct(x["place"], x["channel"])))["channel"] if strategy == "priority" else top["channel"]
    return d.select(
        *documents.columns, F.coalesce(chosen, F.lit(DEFAULT)).alias("channel"), F.coalesce(-top["minus"], F.lit(0.0)).alias("confidence"), F.coalesce(top["source"], F.lit("none")).alias("source"),
        F.coalesce(second["minus"] / top["minus"] >= MIXED_FROM, F.lit(False)).alias("mixed"), F.transform("__ranked", lambda x: x["channel"]).alias("candidates"),
    )


def region_counts(classified: DataFrame) -> DataFrame:
    """channel, source, n, mixed: how many documents each channel got by which place."""
    return classified.groupBy("channel", "source").agg(F.count("*").alias("n"), F.count_if("mixed").alias("mixed"))
