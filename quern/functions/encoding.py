"""Repair of texts that were decoded wrongly: UTF-8 read as a single-byte or Korean encoding.

Most texts need no look: a native test lets only suspects through to the Arrow function, which sees null for all others.
Suspects hold a sign of misreading or a character that may not be in composed form, which starts at U+0300.
"""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Signs of UTF-8 read as something else, and the encodings it may have been read as, in order.
SIGNS = ["â€", "Ã", "ì", "í", "ë", "ê", "�"]
READ_AS = ["cp1252", "latin1", "cp949", "euc-kr"]


def misread(text: str) -> bool:
    return any(s in text for s in SIGNS)


def reread(text: str) -> str:
    """The text in composed form; if it shows a sign of misreading, the longest of what it gives as UTF-8 after undoing each encoding, among those without any sign. What none of them explains stays."""
    text = unicodedata.normalize("NFC", text)
    if not misread(text):
        return text
    best, most = text, 0
    for name in READ_AS:
        try:
            fixed = text.encode(name).decode("utf-8")
        except UnicodeError:
            continue
        if len(fixed) > most and not misread(fixed):
            best, most = fixed, len(fixed)
    return best


def reread_all(texts: pd.Series) -> pd.Series:
    return texts.map(reread, na_action="ignore")


def suspect(text: Column) -> Column:
    return text.rlike("[^\\x{0}-\\x{2FF}]|" + "|".join(SIGNS))


def repaired(text: Column) -> Column:
    """The text repaired where it can be; null stays null."""
    return F.coalesce(F.pandas_udf(reread_all, "string")(F.when(suspect(text), text)), text)


def repair(documents: DataFrame, text: str = "text") -> DataFrame:
    """documents with `text` repaired and encoding, "valid", "fixed" or "unfixable": whether it needed no change, was changed, or still shows a sign of misreading that nothing explains. Null is valid."""
    before = "__before"
    d = documents.withColumnRenamed(text, before).withColumn(text, repaired(F.col(before)))
    signs = F.coalesce(F.col(text).rlike("|".join(SIGNS)), F.lit(False))
    state = F.when(~F.col(text).eqNullSafe(F.col(before)), "fixed").when(signs, "unfixable").otherwise("valid")
    return d.withColumn("encoding", state).select(*documents.columns, "encoding")


def repair_counts(repaired_documents: DataFrame) -> DataFrame:
    """encoding, n: how many texts are valid, fixed and unfixable."""
    return repaired_documents.groupBy("encoding").agg(F.count("*").alias("n"))
