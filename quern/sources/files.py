"""Reading and writing records: JSON lines, YAML, raw files and parquet."""

from __future__ import annotations

import html
import json
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def read_jsonl(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Lines as records of a given schema; blank lines are skipped, broken ones kept as text in __broken."""
    lines = spark.read.text(path).filter(F.trim("value") != "")
    parsed = F.from_json("value", schema + ", __broken string", {"columnNameOfCorruptRecord": "__broken"})
    return lines.select(parsed.alias("r")).select("r.*")


def write_jsonl(records: DataFrame, path: str) -> None:
    records.select(F.to_json(F.struct("*")).alias("value")).write.text(path)


def write_splits(records: DataFrame, path: str) -> None:
    """One folder of JSON lines for each value of split."""
    records.select("split", F.to_json(F.struct(*[c for c in records.columns if c != "split"])).alias("value")).write.partitionBy("split").text(path)


def write_formats(records: DataFrame, path: str, formats: dict[str, Column]) -> None:
    """The records in several formats, each a folder of JSON lines."""
    for name, column in formats.items():
        records.select(F.to_json(column).alias("value")).write.text(f"{path}/{name}")


def list_files(spark: SparkSession, folder: str, extensions: tuple[str, ...] = ("pdf", "hwp", "hwpx")) -> DataFrame:
    """path, length, modified of the files below folder; contents aren't read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{" + ",".join(extensions) + "}").load(folder)
    return files.select("path", "length", F.col("modificationTime").alias("modified"))


def matching(files: DataFrame, pattern: str) -> DataFrame:
    """The files (path) whose name a shell pattern matches: * any characters, ? one, [abc] one of some, [!abc] none of them."""
    name = F.element_at(F.split("path", "/"), -1)
    parts, i = "", 0
    while i < len(pattern):
        c = pattern[i]
        if c == "[" and (j := pattern.find("]", i + 2)) > 0:
            parts, i = parts + "[" + ("^" if pattern[i + 1] == "!" else "") + pattern[i + 1 + (pattern[i + 1] == "!") : j].replace("\\", "\\\\").replace("[", "\\[").replace("&", "\\&") + "]", j
        else:
            parts += {"*": ".*", "?": "."}.get(c, "\\Q" + c + "\\E")
        i += 1
    return files.filter(name.rlike(f"(?s)^{parts}$"))


# Which parser takes files of a suffix, and what their first bytes may be.
PARSERS = {".pdf": ("pdf", ["pdf"]), ".hwp": ("hwp", ["ole2", "zip"]), ".hwpx": ("hwpx", ["zip"])}


def dispatch(path: Column, content: str = "content") -> Column:
    """A struct of the parser for a file by its suffix, and an error: no parser takes the suffix, or the first bytes are another format's."""
    suffix, kind = F.lower(F.regexp_extract(path, r"[^/](\.[^./]*)$", 1)), file_format(content)
    parser, fits = F.lit(None).cast("string"), F.lit(False)
    for s, (name, kinds) in PARSERS.items():
        parser, fits = F.when(suffix == s, name).otherwise(parser), F.when(suffix == s, kind.isin(kinds)).otherwise(fits)
    error = F.when(parser.isNull(), F.concat(F.lit("unsupported format: "), suffix)).when(~fits, F.concat(F.lit("content is "), kind))
    return F.struct(parser.alias("parser"), error.alias("error"))


def not_yet_written(records: DataFrame, key: str, existing: DataFrame, overwrite: bool = False) -> DataFrame:
    """The records whose output isn't there yet: existing holds the keys of outputs. All of them to overwrite."""
    return records if overwrite else records.join(existing.select(key).distinct(), key, "left_anti")


def file_format(content: str = "content") -> Column:
    """ole2, zip, pdf or unknown by the first bytes."""
    head = F.hex(F.substring(content, 1, 8))
    return F.when(head.startswith("D0CF11E0A1B11AE1"), "ole2").when(head.startswith("504B0304"), "zip").when(head.startswith("25504446"), "pdf").otherwise("unknown")


def pdf_problems(content: str = "content") -> Column:
    """What speaks against a file as PDF: no header in the first 1024 bytes, size out of 100 bytes to 200 MB, no end marker."""
    n = F.length(content)
    text = lambda c: F.decode(c, "ISO-8859-1")
    rules = [("no_header", ~F.contains(text(F.substring(content, 1, 1024)), F.lit("%PDF-"))), ("too_small", n < 100), ("too_large", n > 200_000_000), ("no_end", ~F.contains(text(F.substring(F.col(content), F.greatest(n - 1023, F.lit(1)), F.lit(1024))), F.lit("%%EOF")))]
    return F.filter(F.array(*(F.when(c, F.lit(k)) for k, c in rules)), lambda x: x.isNotNull())


def read_yaml(spark: SparkSession, path: str) -> DataFrame:
    """path, ord, record (as JSON) of the items of YAML files; a single value counts as a list of one. Needs the yaml library on the executors."""

    def items(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        import yaml

        for pdf in batches:
            rows = []
            for p, content in zip(pdf["path"], pdf["content"], strict=True):
                found = yaml.safe_load(bytes(content).decode())
                for i, x in enumerate(found if isinstance(found, list) else [found] if found is not None else []):
                    rows.append((p, i, json.dumps(x, ensure_ascii=False, default=str, sort_keys=True)))
            yield pd.DataFrame(rows, columns=["path", "ord", "record"])

    return spark.read.format("binaryFile").load(path).select("path", "content").mapInPandas(items, "path string, ord int, record string")


def timeout_s(size_bytes: Column, pages: Column | None = None) -> Column:
    """Seconds a file may take: 300, 600, 1200 or 1800 by size, half a second a page, from 120 to 3600."""
    mib = size_bytes / F.lit(1 << 20)
    tier = F.when(mib <= 10, 300).when(mib <= 50, 600).when(mib <= 100, 1200).otherwise(1800)
    more = F.floor(F.coalesce(pages, F.lit(0)) * 0.5) if pages is not None else F.lit(0)
    return F.greatest(F.lit(120), F.least(F.lit(3600), tier + more)).cast("int")


def page_ranges(pages: Column, chunk: int = 50) -> Column:
    """first and last page of each chunk."""
    return F.transform(F.filter(F.sequence(F.lit(1), F.greatest(pages, F.lit(1)), F.lit(chunk)), lambda s: s <= pages), lambda s: F.struct(s.alias("first"), F.least(s + chunk - 1, pages).alias("last")))


def write_by_route(routed: DataFrame, folder: str) -> DataFrame:
    """Write rows (route, ...) as JSON lines, a folder a route, and return how many each has. The rows are written once and counted from what was written."""
    routed.write.mode("overwrite").partitionBy("route").json(folder)
    return routed.sparkSession.read.json(folder).groupBy("route").agg(F.count("*").alias("n"))


def markdown_report(title: str, row: dict) -> str:
    """One row of figures as a Markdown table, for a report."""
    return "\n".join([f"# {title}", "", "| figure | value |", "| --- | --- |", *(f"| {k} | {round(v, 4) if isinstance(v, float) else v} |" for k, v in row.items())])


def within(path: Column, length: Column, root: str, most: int = 50 << 20) -> Column:
    """Whether a path lies below root, without steps up, and its file isn't larger than `most` bytes."""
    return path.startswith(root.rstrip("/") + "/") & ~path.rlike(r"(^|/)\.\.(/|$)") & (length <= most)


def report(title: str, row: dict, form: str = "markdown") -> str:
    """One row of figures as a report: "markdown", "json" or "html"."""
    if form == "markdown":
        return markdown_report(title, row)
    if form == "json":
        return json.dumps({"title": title, "figures": row}, ensure_ascii=False, default=str, indent=2)
    if form != "html":
        raise ValueError("form must be markdown, json or html")
    cell = lambda v: html.escape(f"{v:.4f}" if isinstance(v, float) else str(v))
    lines = "\n".join(f"<tr><td>{cell(k)}</td><td>{cell(v)}</td></tr>" for k, v in row.items())
    return f"<!DOCTYPE html>\n<html><head><meta charset=\"utf-8\"><title>{html.escape(title)}</title></head><body>\n<h1>{html.escape(title)}</h1>\n<table>\n{lines}\n</table>\n</body></html>"
