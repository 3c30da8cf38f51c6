"""Scalar text functions as Spark columns. Null texts give null unless said otherwise."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def squash(c: Column) -> Column:
    """Without white space at both ends, and any run of it within made one space."""
    # most texts are so already, which one search tells
    return F.when(c.rlike(r"(?U)^\s|\s$|\s\s|[^\S ]"), F.regexp_replace(F.regexp_replace(c, r"(?U)^\s+|\s+$", ""), r"(?U)\s+", " ")).otherwise(c)


#: What Unicode takes for white space.
SPACES = "\t\n\x0b\x0c\r \x85\xa0\u1680" + "".join(map(chr, range(0x2000, 0x200B))) + "\u2028\u2029\u202f\u205f\u3000"


def strip(c: Column) -> Column:
    return F.trim(c, F.lit(SPACES))


def word_tokens(c: Column) -> Column:
    """Lower-case runs of letters, digits and underscores."""
    return F.regexp_extract_all(F.lower(c), F.lit(r"([\p{L}\p{N}_]+)"), F.lit(1))


def occurrences(c: Column, pattern: str) -> Column:
    return F.regexp_count(c, F.lit(pattern))


def literal_count(c: Column, part: Column) -> Column:
    """How often part stands in c without overlap; 0 for an empty part."""
    return F.when(F.length(part) > 0, (F.length(c) - F.length(F.replace(c, part, F.lit("")))) / F.length(part)).otherwise(F.lit(0.0)).cast("long")


def contains_any(c: Column, words: list[str]) -> Column:
    out = F.lit(False)
    for w in words:
        out = out | c.contains(w)
    return out


def ladder(rules: list[tuple[Column, str]], default: str) -> Column:
    """The value of the first condition that holds."""
    out = None
    for condition, value in rules:
        out = F.when(condition, value) if out is None else out.when(condition, value)
    return F.lit(default) if out is None else out.otherwise(default)


def sane(c: Column) -> Column:
    """Whether a text isn't garbled: at most 5 % replacement characters, 2 % control characters and, from ten characters on, 20 % private-use characters; none of them in texts of up to two."""
    n = F.length(c)
    bad = occurrences(c, "�")
    control = occurrences(c, r"[\x00-\x08\x0b\x0c\x0e-\x1f]")
    private = occurrences(c, r"[-]")
    return F.when(n <= 2, (bad + control + private) == 0).otherwise((bad <= 0.05 * n) & (control <= 0.02 * n) & ((n < 10) | (private <= 0.2 * n)))


# Fixed values below: what is repaired, and in which order.
def clean(c: Column) -> Column:
    """Repairs in a fixed order: control characters, runs of punctuation, white space, and the ends."""
    for pattern, by in (
        (r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", ""), (r"[!@#$%^&*()]{3,}", ""), (r"\.{4,}", "..."), (r"-{4,}", "---"), (r"_{4,}", "___"),
        (r"~{3,}", "~~"), (r" {2,}", " "), (r"\n{3,}", "\n\n"), (r" +\n", "\n"), (r"\n +", "\n"),
    ):
        c = F.regexp_replace(c, pattern, by)
    return strip(c)


def version(c: Column) -> Column:
    """YYYYMM of the first year and month in a text, else null."""
    found = F.regexp_replace(F.regexp_extract(c, r"(\d{4}[-.]?\d{2})", 1), "[-.]", "")
    return F.when(found != "", found)


def duration(seconds: Column) -> Column:
    """1h 2m 3s, without leading zero parts."""
    s = seconds.cast("long")
    h, m, r = F.floor(s / 3600), F.floor(s / 60) % 60, s % 60
    return F.when(h > 0, F.format_string("%dh %dm %ds", h, m, r)).when(m > 0, F.format_string("%dm %ds", m, r)).otherwise(F.format_string("%ds", r))


def path_parts(path: Column) -> Column:
    """A struct of the name, stem, suffix (with its dot, lower-case) and parent's name of a path; a name that begins with its only dot has no suffix."""
    name = F.element_at(F.split(path, "/"), -1)
    suffix = F.regexp_extract(name, r"^.+(\.[^.]+)$", 1)
    return F.struct(name.alias("name"), F.left(name, F.length(name) - F.length(suffix)).alias("stem"), F.lower(suffix).alias("suffix"), F.regexp_extract(path, r"([^/]+)/[^/]*$", 1).alias("parent"))


def pruned(c: Column) -> Column:
    """Null for texts without anything but white space."""
    return F.when(strip(c) != "", c)
