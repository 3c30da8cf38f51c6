"""What the modules of queries share: the register of queries and their SQL, the tables, and the ledger made of events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict = {}
ORACLE_SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLE_SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def examples(spark: SparkSession, d: str) -> DataFrame:
    """Documents as training examples: the first line is the instruction, the whole text the output."""
    return table(spark, d, "documents").select(F.col("doc_id").alias("ord"), F.lit("").alias("instruction"), F.lit("").alias("input"), F.col("text").alias("output"), "source")


def texts(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", "source")


def work(spark: SparkSession, d: str) -> DataFrame:
    """Events as a ledger: a user's events are a file's."""
    name = F.create_map(*(F.lit(x) for kv in {"click": "queued", "signup": "queued", "view": "start", "purchase": "done", "error": "fail"}.items() for x in kv))
    return table(spark, d, "events").select("event_id", F.col("user_id").alias("key"), "ts", F.element_at(name, F.col("event_type")).alias("event"), F.col("value").alias("elapsed"), F.concat(F.lit("E"), (F.col("event_id") % 5).cast("string")).alias("error"))


WORK = "WITH work AS (SELECT event_id, user_id AS key, ts, CASE event_type WHEN 'view' THEN 'start' WHEN 'purchase' THEN 'done' WHEN 'error' THEN 'fail' ELSE 'queued' END AS event, value AS elapsed, 'E' || (event_id % 5) AS error FROM events)"
SQUASH = "regexp_replace(trim(text, E' \\t\\n\\r'), '\\s+', ' ', 'g')"

#: Cells of the tables in documents, their reliability, the gate of tables, and search by brute force.
CELLS = """WITH l AS (SELECT doc_id, line_no - 1 AS line_no, list_filter(list_transform(string_split(line, ' | '), lambda x: trim(x, E' \\t\\n\\r')), lambda x: x <> '') AS parts FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, generate_subscripts(string_split(text, chr(10)), 1) AS line_no FROM documents)),
k AS (SELECT *, line_no - row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS run FROM l WHERE len(parts) >= 2),
g AS (SELECT *, count(*) OVER (PARTITION BY doc_id, run) AS n, row_number() OVER (PARTITION BY doc_id, run ORDER BY line_no) - 1 AS row FROM k),
t AS (SELECT doc_id, dense_rank() OVER (PARTITION BY doc_id ORDER BY run) - 1 AS table_no, row, parts FROM g WHERE n >= 2),
cells AS (SELECT doc_id AS id, table_no, row, unnest(range(len(parts))) AS col, unnest(parts) AS text FROM t)"""
RELIABLE = """, r AS (SELECT *, CASE WHEN text = '' THEN 0 ELSE greatest(0, least(1, 0.45 + 0.3 * (length(regexp_replace(text, '[^\\p{L}\\p{N}]', '', 'g')) + 0.5 * length(regexp_replace(text, '[^ ]', '', 'g'))) / length(text)
 + 0.2 * CASE WHEN regexp_matches(text, '^([\\d,]+(\\.\\d+)?원?|\\d{4}[-./]\\d{1,2}[-./]\\d{1,2}|\\d{4}[-./]\\d{1,2}|\\d+(\\.\\d+)?%|\\d{1,3}세?|\\d{2,3}-\\d{3,4}-\\d{4})$') THEN 1.0 WHEN regexp_matches(text, '\\d') THEN 0.6 ELSE 0.5 END
 - CASE WHEN length(text) <= 1 THEN 0.15 ELSE 0 END)) END AS reliability FROM cells)"""
GATED = """, z AS (SELECT *, count(*) OVER (PARTITION BY id, table_no) AS n FROM r),
m AS (SELECT id, table_no, n, round(avg((text <> '')::INT), 4) AS fill_rate, round(avg(reliability), 4) AS avg_reliability, round(avg((reliability < CASE WHEN n < 50 THEN 0.60 ELSE 0.55 END)::INT), 4) AS low_conf_ratio,
 avg(CASE WHEN row = 0 THEN (text <> '')::INT END) >= 0.5 AND avg(CASE WHEN row = 0 THEN reliability END) >= 0.75 AS header_ok FROM z GROUP BY ALL),
gated AS (SELECT id, table_no, fill_rate, low_conf_ratio, header_ok, fill_rate >= CASE WHEN n < 10 THEN 0.70 WHEN n < 50 THEN 0.60 ELSE 0.55 END AND avg_reliability >= CASE WHEN n < 10 THEN 0.75 WHEN n < 50 THEN 0.70 ELSE 0.65 END AND low_conf_ratio <= CASE WHEN n < 10 THEN 0.20 WHEN n < 50 THEN 0.25 ELSE 0.30 END AND header_ok AS passed FROM m)"""
VECTOR_SEARCH = "WITH v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), q AS (SELECT vec_id AS query_id, e AS f FROM v WHERE vec_id % 20 = 0), s AS (SELECT query_id, vec_id, list_dot_product(e, f) / sqrt(list_dot_product(e, e)) / sqrt(list_dot_product(f, f)) AS score FROM q, v) SELECT query_id, vec_id, round(score, 6) AS score, rank FROM (SELECT *, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s) WHERE rank <= 3"

#: Structural similarity of the first examples of classes, and their membership.
STRUCTURAL = """WITH RECURSIVE o AS (SELECT doc_id, source, length(text) AS n, list_sort(list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')[1:10])) AS w FROM documents),
f AS (SELECT min(doc_id) AS doc_id, source, n, w FROM o GROUP BY source, n, w),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, (0.6 + 0.2 + CASE WHEN a.n = 0 AND b.n = 0 THEN 0.1 WHEN a.n > 0 AND b.n > 0 THEN 0.1 * (1 - abs(a.n - b.n) / greatest(a.n, b.n)) ELSE 0 END
  + 0.3 * len(list_intersect(a.w, b.w)) / greatest(1, len(list_distinct(list_concat(a.w, b.w))))) / 1.2 AS s
  FROM f a JOIN f b ON a.source = b.source AND a.doc_id < b.doc_id),
pairs AS (SELECT a, b, s FROM p WHERE s >= 0.85),
classes AS (SELECT doc_id AS ord, CASE WHEN len(w) > 0 THEN min(doc_id) OVER (PARTITION BY source, n, w) ELSE doc_id END AS class FROM o)"""
#: Keep-first in turn: the first examples of classes in order, with the list of what has gone so far.
GREEDY = """, e AS (SELECT ord, row_number() OVER (ORDER BY ord) AS k FROM classes WHERE ord = class), hits AS (SELECT a, list(b) AS bs FROM pairs GROUP BY a), m AS (SELECT e.k, e.ord, coalesce(bs, []) AS bs FROM e LEFT JOIN hits ON a = ord),
g(k, ord, kept, gone) AS (SELECT k, ord, true, bs FROM m WHERE k = 1 UNION ALL SELECT m.k, m.ord, NOT list_contains(gone, m.ord), CASE WHEN list_contains(gone, m.ord) OR len(m.bs) = 0 THEN gone ELSE list_concat(gone, m.bs) END FROM g JOIN m ON m.k = g.k + 1) SELECT ord FROM g WHERE kept"""

#: Channels that texts name: of the rules' words the test tables hold two Latin ones.
CHANNEL = """WITH m AS (SELECT doc_id, text, length(text) - length(replace(lower(text), 'tm', 'x')) AS n FROM documents WHERE regexp_matches(text, '(?i)tm')),
tv AS (SELECT doc_id, text, len(regexp_extract_all(text, '(?i)tv')) AS n FROM documents WHERE regexp_matches(text, '(?i)tv')),
c AS (SELECT doc_id AS id, 'TM' AS channel, 2 AS priority, greatest(0, least(1, 0.3 + CASE WHEN regexp_matches(left(text, 1000), '(?i)tm') THEN 0.35 WHEN length(text) > 500 AND regexp_matches(right(text, 500), '(?i)tm') THEN 0.05 ELSE 0.1 END + least(n * 0.06, 0.3) - CASE WHEN regexp_matches(text, '(?i)atm|tms') THEN 0.35 ELSE 0 END)) * 0.6 AS s FROM m
 UNION ALL SELECT doc_id, '방송', 5, greatest(0, least(1, 0.3 + CASE WHEN regexp_matches(left(text, 1000), '(?i)tv') THEN 0.35 WHEN length(text) > 500 AND regexp_matches(right(text, 500), '(?i)tv') THEN 0.05 ELSE 0.1 END + least(n * 0.06, 0.3))) * 0.6 FROM tv),
b AS (SELECT *, row_number() OVER (PARTITION BY id ORDER BY s DESC, priority) AS r FROM c)"""
