"""Functions callable from SQL: text functions as SQL expressions, which Catalyst inlines, and the clause segmenter as a table function.

    register(spark)
    spark.sql("SELECT squash(text), n_words(text) FROM documents")
    spark.sql("SELECT * FROM clause_segments(TABLE(lines) PARTITION BY id ORDER BY (line_no))")
"""

from __future__ import annotations

import json
import re
from collections.abc import Iterator

from pyspark.sql import Row, SparkSession
from pyspark.sql.functions import udtf

from quern.operators.clause_headers import SIMPLE_ARTICLE, SIMPLE_HEADERS, SIMPLE_NOISE, WHOLE, WITH_ARTICLES

#: Name, parameters, type and expression of each scalar.
SCALARS = {
    "squash": ("x STRING", "STRING", r"regexp_replace(regexp_replace(x, r'(?U)^\s+|\s+$', ''), r'(?U)\s+', ' ')"),
    "n_words": ("x STRING", "INT", r"size(regexp_extract_all(x, r'[\p{L}\p{N}_]+', 0))"),
    "content_key": ("x STRING", "STRING", r"md5(regexp_replace(regexp_replace(x, r'(?U)^\s+|\s+$', ''), r'(?U)\s+', ' '))"),
    "special_share": ("x STRING", "DOUBLE", r"CASE WHEN length(x) > 0 THEN regexp_count(x, r'(?U)[^\w\s]') / length(x) ELSE 0D END"),
    "file_suffix": ("x STRING", "STRING", r"lower(regexp_extract(x, r'[^/.](\.[^./]*)$', 1))"),
    "routed": ("confidence DOUBLE, auto DOUBLE, review DOUBLE", "STRING", "CASE WHEN confidence >= auto THEN 'auto' WHEN confidence >= review THEN 'review' ELSE 'unclassified' END"),
}
SEGMENT = "id long, segment int, kind string, title string, start_line int, end_line int, n_articles int"


class ClauseSegments:
    """Segments of one document's lines, in order: a row for what begins at each header. It holds the open segment only, not the lines. headers: a JSON object of patterns by kind, and article a pattern, instead of the fixed ones."""

    def __init__(self):
        self.open, self.n, self.id, self.seen, self.articles = None, 0, None, None, 0

    def eval(self, row: Row, headers: str = "", article: str = "") -> Iterator[tuple]:
        if self.seen is None:
            self.patterns = {k: re.compile(p) for k, p in (json.loads(headers) if headers else SIMPLE_HEADERS).items()}
            self.article, self.noise = re.compile(article or SIMPLE_ARTICLE), re.compile(SIMPLE_NOISE)
            self.id, self.first = row["id"], row["line_no"]
        s = row["line"].strip()
        bare = s.lstrip("#").strip() if s.startswith("##") else s
        for kind, p in self.patterns.items():
            found = p.search(s) if kind == "appendix" else p.search(bare) and not self.noise.search(bare) and (kind != "coverage" or len(bare) > 3)
            if found:
                if self.open:
                    yield self.closed(row["line_no"] - 1)
                self.n += 1
                self.open, self.articles = (kind, s if kind == "appendix" else bare, row["line_no"]), 0
                break
        self.articles += bool(self.article.search(s))
        self.seen = row["line_no"]

    def closed(self, end: int) -> tuple:
        kind, title, start = self.open
        return self.id, self.n, kind, title, start, end, self.articles if kind in WITH_ARTICLES else 0

    def terminate(self) -> Iterator[tuple]:
        if self.open:
            yield self.closed(self.seen)
        elif self.seen is not None:
            yield self.id, 1, "document", WHOLE, self.first, self.seen, self.articles


def register(spark: SparkSession) -> None:
    """Make all of these callable from spark.sql() in this session."""
    for name, (parameters, kind, expression) in SCALARS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {name}({parameters}) RETURNS {kind} RETURN {expression}")
    spark.udtf.register("clause_segments", udtf(ClauseSegments, returnType=SEGMENT))
