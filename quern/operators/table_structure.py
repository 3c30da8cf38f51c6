"""The structure of tables of cells (id, table_no, row, col, rowspan, colspan, text, ocr_text, reliability): header rows, spans, consistency and what to reprocess."""

from __future__ import annotations

from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.functions.text import strip
from quern.operators import tables

TABLE = ["id", "table_no"]
# What is left out of an amount, a share or an age before asking whether it is a number.
UNITS = [",", ".", "원", "만", "천", "억", "%", "세", "년"]
# Reasons of a failed gate with what each makes redo and how urgent it is (1 first).
REASONS = [
    ("low_fill_rate", "full", 2), ("low_avg_reliability", "ocr_only", 3), ("header_detection_failed", "structure_only", 2), ("structure_validation_failed", "structure_only", 1),
    ("ocr_bbox_missing", "ocr_only", 3), ("merged_cell_error", "structure_only", 2), ("pattern_validation_failed", "ocr_only", 4), ("excessive_low_conf_cells", "full", 1),
]
MOST_ATTEMPTS = 3


def numeric_cell(text: Column) -> Column:
    """Whether only digits are left without the units."""
    return F.translate(text, "".join(UNITS), "").rlike(r"^\p{Nd}+$")


def row_score(fill: Column, rel: Column, numeric: Column, chars: Column, filled: Column) -> Column:
    """A quarter each of the share of filled cells and the mean reliability, 0.3 of the share of filled cells that are no numbers, and 0.2 for short texts."""
    n = F.greatest(F.lit(1), filled)
    mean = chars / n
    return 0.25 * fill + 0.25 * rel + 0.3 * (1 - numeric / n) + 0.2 * F.when(mean < 20, 1.0).when(mean < 50, 0.5).otherwise(0.2)


def content() -> Column:
    return strip(F.coalesce(F.when(F.col("text") != "", F.col("text")), F.col("ocr_text"), F.lit("")))


def header_scores(cells: DataFrame) -> DataFrame:
    """Per row: its score as a header."""
    rows = cells.select(*TABLE, "row", content().alias("content"), tables.is_filled(cells).cast("int").alias("filled"), F.coalesce("reliability", F.lit(0.0)).alias("reliability")).groupBy(*TABLE, "row").agg(
        F.avg("filled").alias("fill"), F.avg("reliability").alias("rel"), F.sum("filled").alias("filled"), F.count_if(numeric_cell(F.col("content"))).alias("numeric"), F.sum(F.length("content")).alias("chars"),
    )
    return rows.select(*TABLE, "row", row_score(*map(F.col, ("fill", "rel", "numeric", "chars", "filled"))).alias("score"))


def header_sums() -> list[Column]:
    """Of the scores of a table's rows: those of rows 0 and 1, and the best with its row, the first of equals."""
    of = lambda k: F.max(F.when(F.col("row") == k, F.col("score")))
    return [of(0).alias("s0"), of(1).alias("s1"), F.max_by(F.struct("row", "score"), F.struct("score", -F.col("row"))).alias("best")]


def header() -> list[Column]:
    """rows, confidence and multi_level of the header, of what header_sums gathers."""
    multi = (F.col("s0") >= 0.5) & F.coalesce(F.col("s1") >= 0.6, F.lit(False))
    rows = (
        F.when(multi, F.array(F.lit(0), F.lit(1))).when(F.col("s0") >= 0.5, F.array(F.lit(0))).when(F.col("best.score") >= 0.5, F.array(F.col("best.row").cast("int")))
        .when(F.col("s0").isNotNull(), F.array(F.lit(0))).otherwise(F.array().cast("array<int>"))
    )
    confidence = F.when(F.col("s0") >= 0.5, F.col("s0")).when(F.col("best.score") >= 0.5, F.col("best.score")).otherwise(0.3)
    return [rows.alias("rows"), confidence.alias("confidence"), F.coalesce(multi, F.lit(False)).alias("multi_level")]


def header_rows(scores: DataFrame) -> DataFrame:
    """Per table: the header's rows and its confidence. Row 0 from 0.5 on, with row 1 from 0.6 on; else the best row from 0.5 on, the first of equals; else row 0 by default."""
    return scores.groupBy(*TABLE).agg(*header_sums()).select(*TABLE, *header())


def expand_spans(cells: DataFrame) -> DataFrame:
    """A row for each place that a cell covers, with the row and col of the cell it comes from and whether it is that one."""
    upto = lambda c: F.sequence(F.lit(0), F.greatest(F.coalesce(c, F.lit(1)), F.lit(1)) - 1)
    c = cells.withColumnsRenamed({"row": "origin_row", "col": "origin_col"}).withColumn("dr", F.explode(upto(F.col("rowspan")))).withColumn("dc", F.explode(upto(F.col("colspan"))))
    c = c.withColumn("row", F.col("origin_row") + F.col("dr")).withColumn("col", F.col("origin_col") + F.col("dc"))
    return c.withColumn("is_origin", (F.col("dr") == 0) & (F.col("dc") == 0)).drop("dr", "dc")


NAMES = ["inconsistent_column_count", "duplicate_cell_position", "has_merged_cells"]


def problems() -> list[Column]:
    """Of a table's rows: whether they cover unequal numbers of columns, whether two cells begin in one place, and whether any cell spans more."""
    return [x.alias(k) for x, k in zip((F.min("n_places") != F.max("n_places"), F.max("begun") > 1, F.max("merged")), NAMES, strict=True)]


def spans() -> Column:
    return (F.coalesce("rowspan", F.lit(1)) > 1) | (F.coalesce("colspan", F.lit(1)) > 1)


def structure_problems(cells: DataFrame) -> DataFrame:
    """Per table: whether rows cover unequal numbers of columns, whether two cells begin in one place, and whether any cell spans more."""
    wide = cells.select(*TABLE, "row", "col", "colspan", spans().alias("merged")).withColumn("rowspan", F.lit(1))
    # a row for each place that is covered: how many cover it, how many cells begin there
    places = expand_spans(wide).groupBy(*TABLE, "row", "col").agg(F.count_if("is_origin").alias("begun"), F.max("merged").alias("merged"))
    return places.groupBy(*TABLE, "row").agg(F.count("col").alias("n_places"), F.max("begun").alias("begun"), F.max("merged").alias("merged")).groupBy(*TABLE).agg(*problems())


def reprocess(gated: DataFrame) -> DataFrame:
    """gated (passed, reasons array<string>, attempts) with again (whether to reprocess), level and priority: the widest level and the most urgent of known reasons; by hand after MOST_ATTEMPTS."""
    level = F.create_map(*(F.lit(x) for name, of, _ in REASONS for x in (name, {"full": 3, "structure_only": 2, "ocr_only": 1}[of])))
    urgency = F.create_map(*(F.lit(x) for name, _, n in REASONS for x in (name, n)))
    known = F.filter(F.coalesce("reasons", F.array().cast("array<string>")), lambda r: F.map_contains_key(level, r))
    widest, first = F.array_max(F.transform(known, lambda r: F.element_at(level, r))), F.array_min(F.transform(known, lambda r: F.element_at(urgency, r)))
    by_hand = F.coalesce("attempts", F.lit(0)) >= MOST_ATTEMPTS
    return gated.select(
        "*", (~F.col("passed")).alias("again"),
        F.when(F.col("passed"), "full").when(by_hand, "manual").when(widest == 2, "structure_only").when(widest == 1, "ocr_only").otherwise("full").alias("level"),
        F.when(F.col("passed"), 5).when(by_hand, 1).otherwise(F.coalesce(first, F.lit(3))).alias("priority"),
    )


def assess(cells: DataFrame, attempts: DataFrame | None = None, parts: int = 0) -> DataFrame:
    """Per table of cells: the gate's metrics, verdict, grade, action and reasons; the header's rows, its confidence and the structure's problems; and whether, how and how urgently to reprocess. Cells without a reliability get one. attempts: id, table_no and how often a table was reprocessed before. parts: cells have a part below that, and a row's reliabilities are added up by part, on which the best of rows with equal means may depend."""
    known = F.coalesce("reliability", F.round(tables.reliability(F.col("text"), F.col("ocr_text")), 4))
    c = cells.select(*TABLE, "row", "col", F.lit(1).alias("rowspan"), "colspan", content().alias("content"), tables.is_filled(cells).cast("int").alias("filled"), known.alias("rel"), spans().alias("merged"), (F.col("part") if parts else F.lit(0)).alias("part"))
    # cells are read once: places, rows and tables are summed up one after another
    own = lambda x: F.when(F.col("is_origin"), x)
    of = [f"rel{k}" for k in range(parts or 1)]
    sums = ["n_cells", "filled", "numeric", "chars", "low", "lower"]
    places = expand_spans(c).groupBy(*TABLE, "row", "col").agg(
        F.count_if("is_origin").alias("n_cells"), F.max("merged").alias("merged"), F.sum(own(F.col("filled"))).alias("filled"), *(F.sum(own(F.when(F.col("part") == k, F.col("rel")))).alias(x) for k, x in enumerate(of)),
        F.count_if(own(numeric_cell(F.col("content")))).alias("numeric"), F.sum(own(F.length("content"))).alias("chars"), F.count_if(own(F.col("rel") < 0.60)).alias("low"), F.count_if(own(F.col("rel") < 0.55)).alias("lower"),
    )
    lines = places.groupBy(*TABLE, "row").agg(F.count("col").alias("n_places"), F.max("n_cells").alias("begun"), F.max("merged").alias("merged"), *(F.sum(x).alias(x) for x in sums), reduce(add, (F.coalesce(F.sum(x), F.lit(0.0)) for x in of)).alias("rel"))
    lines = lines.withColumn("score", row_score(F.col("filled") / F.col("n_cells"), F.col("rel") / F.col("n_cells"), F.col("numeric"), F.col("chars"), F.col("filled")))
    head = lambda x: F.sum(F.when(F.col("row") == 0, F.col(x))) / F.sum(F.when(F.col("row") == 0, F.col("n_cells")))
    t = lines.groupBy(*TABLE).agg(
        *header_sums(), *problems(), *(F.sum(x).alias(x) for x in (*sums, "rel")), ((head("filled") >= 0.5) & (tables.settled(head("rel")) >= 0.75)).alias("header_ok")
    ).withColumnRenamed("n_cells", "n")
    low = tables.by_size(F.col("low"), F.col("low"), F.col("lower"))
    rates = {"fill_rate": F.col("filled"), "avg_reliability": F.col("rel"), "low_conf_ratio": low}
    t = t.select(*TABLE, "n", *(F.round(x / F.col("n"), 4).alias(k) for k, x in rates.items()), "header_ok", *(x.alias(k) for x, k in zip(header(), ("header_rows", "header_confidence", "multi_level"), strict=True)), *NAMES)
    reasons = F.filter(F.array(
        F.when(F.col("fill_rate") < tables.by_size(0.70, 0.60, 0.55), "low_fill_rate"), F.when(F.col("avg_reliability") < tables.by_size(0.75, 0.70, 0.65), "low_avg_reliability"),
        F.when(F.col("low_conf_ratio") > tables.by_size(0.20, 0.25, 0.30), "high_low_conf_ratio"), F.when(~F.col("header_ok") | F.col("header_ok").isNull(), "header_validation_failed"),
    ), lambda x: x.isNotNull())
    t = tables.verdict(t).withColumn("reasons", reasons).withColumn("header_ok", F.coalesce("header_ok", F.lit(False)))
    issues = F.filter(F.array(F.when(F.size("header_rows") == 0, "header_detection_failed"), *(F.when(F.col(k), k) for k in NAMES[:2])), lambda x: x.isNotNull())
    t = t.withColumn("issues", issues).withColumn("structure_valid", F.size("issues") == 0).drop(*NAMES[:2])
    t = t.join(attempts.select(*TABLE, "attempts"), TABLE, "left") if attempts is not None else t.withColumn("attempts", F.lit(0))
    # what the gate and the structure found, as the reasons that reprocessing knows
    same = {"high_low_conf_ratio": "excessive_low_conf_cells", "header_validation_failed": "header_detection_failed", "inconsistent_column_count": "structure_validation_failed", "duplicate_cell_position": "structure_validation_failed"}
    renamed = F.create_map(*(F.lit(x) for kv in same.items() for x in kv))
    found = F.transform(F.concat("reasons", "issues"), lambda r: F.coalesce(F.try_element_at(renamed, r), r))
    return reprocess(t.withColumns({"gate_reasons": F.col("reasons"), "reasons": F.array_distinct(found)}))
