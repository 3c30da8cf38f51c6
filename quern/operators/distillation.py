"""What a student is trained on: a teacher's final answer with the contexts it used, and the expert for a kind of question."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Contexts in order with their headings, and the experts of kinds of questions.
HEADINGS = {"canonical": "[약관]", "summary": "[상품요약서]", "operational": "[사업방법서]"}
EXPERTS = {"definition": 0, "explanation": 1, "operation": 2, "multimodal": 3, "router": 4}


def expert(kind: Column) -> Column:
    """The number of the expert for a kind of question; 0 for unknown kinds and null."""
    return F.coalesce(F.try_element_at(F.create_map(*(F.lit(x) for kv in EXPERTS.items() for x in kv)), kind), F.lit(0))


def to_student(teacher: DataFrame) -> DataFrame:
    """teacher (id, instruction, canonical, summary, operational, answer, sources array<string>) as id, instruction, context, output: the contexts that are named as sources and not empty, each under its heading, a blank line between. Null sources mean the canonical text."""
    sources = F.coalesce("sources", F.array(F.lit("canonical")))
    parts = (F.when(F.array_contains(sources, name) & (F.coalesce(F.col(name), F.lit("")) != ""), F.concat(F.lit(f"{head}\n"), F.col(name))) for name, head in HEADINGS.items())
    return teacher.select("id", "instruction", F.concat_ws("\n\n", *parts).alias("context"), F.coalesce("answer", F.lit("")).alias("output"))
