"""Queries over the driver's tables whose operators keep state on streams, order whole tables, join by place, or index."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from quern.functions import encoding, sql
from quern.operators import clause_headers, ordered, rule_classifier, spatial, table_chunks, vector_index
from quern.operators.dedup import shared_folder
from quern.plans.common import CELLS, GATED, RELIABLE, SQUASH, VECTOR_SEARCH, WORK, query, table, texts, work
from quern.streaming import keyed_state, run_metrics

KINDS = ["queued", "start", "done", "fail"]


# keyed state on a stream
@query(WORK + """, r AS (SELECT *, sum((event = 'done')::INT) OVER (PARTITION BY key ORDER BY ts, event_id) AS run FROM work),
f AS (SELECT *, sum((event = 'fail')::INT) OVER (PARTITION BY key, run ORDER BY ts, event_id) AS failures FROM r)
SELECT key, event_id, ts, CAST(failures AS BIGINT) AS failures, CASE WHEN failures < 3 THEN 'retry' ELSE 'failed' END AS action FROM f WHERE event = 'fail'""")
def retry_stream(spark, d):
    return keyed_state.arriving(work(spark, d), keyed_state.retry_actions)


@query(WORK + ", k AS (SELECT event_id, ts, key % 7 AS key, event FROM work) SELECT key, event_id, ts, event, CASE event " + " ".join(f"WHEN '{k}' THEN count(*) FILTER (event = '{k}') OVER w" for k in KINDS) + " END AS n_same, count(*) OVER w AS n_held FROM k WINDOW w AS (PARTITION BY key ORDER BY ts, event_id ROWS 999 PRECEDING)")
def last_mix_stream(spark, d):
    return keyed_state.arriving(work(spark, d).withColumn("key", F.col("key") % 7), keyed_state.last_mix)


# a sliding frame over a whole table
@query(WORK + " " + " UNION ALL ".join(f"SELECT event_id, '{k}' AS kind, count(*) FILTER (event = '{k}') OVER w AS n, count(*) OVER w AS n_frame, round(count(*) FILTER (event = '{k}') OVER w / count(*) OVER w, 6) AS share FROM work WINDOW w AS (ORDER BY ts, event_id ROWS 999 PRECEDING)" for k in KINDS))
def rolling_distribution(spark, d):
    return ordered.rolling_shares(work(spark, d), KINDS).withColumn("share", F.round("share", 6))


EXPECTED = {"done": 0.25, "fail": 0.405, "queued": 0.4, "start": 0.2}
OFF = "".join(f" WHEN abs(s_{k} - {e}) > 0.2 THEN '{k}'" for k, e in EXPECTED.items())


@query(WORK + ", s AS (SELECT event_id, ts, " + ", ".join(f"count(*) FILTER (event = '{k}') OVER w / count(*) OVER w AS s_{k}" for k in EXPECTED) + f" FROM work WINDOW w AS (ORDER BY ts, event_id ROWS 999 PRECEDING)), o AS (SELECT *, CASE{OFF} END AS kind FROM s), v AS (SELECT *, CASE kind " + " ".join(f"WHEN '{k}' THEN s_{k}" for k in EXPECTED) + " END AS share, CASE kind " + " ".join(f"WHEN '{k}' THEN {e}" for k, e in EXPECTED.items()) + " END AS expected FROM o WHERE kind IS NOT NULL) SELECT event_id, ts, kind, round(share, 6) AS share, CASE WHEN abs(share - expected) > 0.4 THEN 'critical' ELSE 'warning' END AS level FROM v")
def rolling_alerts(spark, d):
    return ordered.rolling_alerts(work(spark, d), EXPECTED).withColumn("share", F.round("share", 6))


# joins by place: an order is a page, its line items are cells, and again recognised lines
ROWS = "SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice) AS place FROM lineitem"
BOXES = f"""WITH RECURSIVE l AS ({ROWS}),
cells AS (SELECT l_orderkey % 100 AS id, l_orderkey AS page, place AS cell, (l_partkey % 12) * 10.0 AS x0, (l_suppkey % 3) * 8.0 AS y0, (l_partkey % 12) * 10.0 + 20 + l_linenumber * 3 AS x1, (l_suppkey % 3) * 8.0 + 12 AS y1 FROM l),
lines AS (SELECT l_orderkey % 100 AS id, l_orderkey AS page, place AS ord, (l_suppkey % 12) * 10.0 + 2 AS u0, (l_partkey % 3) * 8.0 + 1 AS v0, (l_suppkey % 12) * 10.0 + 20 + l_linenumber * 2 AS u1, (l_partkey % 3) * 8.0 + 12 AS v1 FROM l),
o AS (SELECT id, page, cell, ord, greatest(0, least(x1, u1) - greatest(x0, u0)) * greatest(0, least(y1, v1) - greatest(y0, v0)) AS i, (x1 - x0) * (y1 - y0) + (u1 - u0) * (v1 - v0) AS s FROM cells JOIN lines USING (id, page)),
e AS (SELECT id, page, cell, ord, i / (s - i) AS iou FROM o WHERE i / (s - i) >= 0.3)"""


def boxes(spark, d) -> tuple[DataFrame, DataFrame]:
    """Cells and lines with boxes of ten to forty units."""
    order = Window.partitionBy("l_orderkey").orderBy("l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")
    t = table(spark, d, "lineitem").withColumn("place", F.row_number().over(order))
    part, supplier = F.col("l_partkey"), F.col("l_suppkey")
    page = [(F.col("l_orderkey") % 100).alias("id"), F.col("l_orderkey").alias("page")]
    box = lambda x, y, w, h: F.array(*(c.cast("double") for c in (x, y, x + w, y + h))).alias("bbox")
    cells = t.select(*page, F.col("place").alias("cell"), box(part % 12 * 10, supplier % 3 * 8, F.col("l_linenumber") * 3 + 20, F.lit(12)))
    return cells, t.select(*page, F.col("place").alias("ord"), box(supplier % 12 * 10 + 2, part % 3 * 8 + 1, F.col("l_linenumber") * 2 + 18, F.lit(11)))


@query(BOXES + " SELECT id, page, cell, arg_max(ord, (iou, -ord)) AS ord, round(max(iou), 6) AS iou FROM cells LEFT JOIN e USING (id, page, cell) GROUP BY id, page, cell")
def best_lines(spark, d):
    return spatial.best_match(*boxes(spark, d)).select("id", "page", "cell", "ord", F.round("iou", 6).alias("iou"))


@query(BOXES + """, c AS (SELECT page, cell, list({'ord': ord, 'iou': iou} ORDER BY iou DESC, ord) AS wish FROM e GROUP BY page, cell), n AS (SELECT page, cell, wish, row_number() OVER (PARTITION BY page ORDER BY cell) AS k FROM c),
t(page, k, cell, ord, iou, taken) AS (SELECT page, 0, 0, NULL::BIGINT, NULL::DOUBLE, []::BIGINT[] FROM n WHERE k = 1
  UNION ALL SELECT page, k, cell, x.ord, x.iou, CASE WHEN x IS NULL THEN taken ELSE list_append(taken, x.ord) END FROM (SELECT n.page, n.k, n.cell, t.taken, list_filter(n.wish, lambda w: NOT list_contains(t.taken, w.ord))[1] AS x FROM t JOIN n ON n.page = t.page AND n.k = t.k + 1))
SELECT page % 100 AS id, page, cell, ord, round(iou, 6) AS iou FROM t WHERE ord IS NOT NULL""")
def exclusive_lines(spark, d):
    return spatial.exclusive_match(*boxes(spark, d)).withColumn("iou", F.round("iou", 6))


@query(BOXES + ", a AS (SELECT id, page, x0, y0, x1, y1 FROM cells WHERE cell <= 3), p AS (SELECT id, page, ord, (u0 + u1) / 2 AS x, (v0 + v1) / 2 AS y FROM lines) SELECT id, page, ord, x, y FROM p WHERE NOT EXISTS (SELECT 1 FROM a WHERE a.id = p.id AND a.page = p.page AND x BETWEEN x0 AND x1 AND y BETWEEN y0 AND y1)")
def lines_outside_cells(spark, d):
    cells, lines = boxes(spark, d)
    at = lambda i: F.get("bbox", F.lit(i))
    areas = cells.filter("cell <= 3").select("id", "page", *(at(i).alias(c) for i, c in enumerate(("x_min", "y_min", "x_max", "y_max"))))
    return spatial.outside_boxes(lines.select("id", "page", "ord", ((at(0) + at(2)) / 2).alias("x"), ((at(1) + at(3)) / 2).alias("y")), areas)


# channels of web pages by rules
RULES = [
    ("tion", "keyword", "étion", 1), ("tion", "keyword", "tion é", 1), ("tion", "exclude", "qqq", 1), ("tion", "filename", "/fr/", 1),
    ("ther", "keyword", "therble", 2), ("ther", "keyword", "ther", 2), ("ther", "exclude", "erthat th", 2), ("ther", "filename", "//www\\.", 2),
    ("sch", "keyword", "schein", 3), ("sch", "keyword", "sch", 3), ("sch", "filename", "/de/[0-9]+$", 3),
    ("ción", "keyword", "ciónque", 4), ("ción", "keyword", "ción", 4), ("ción", "exclude", "ciónca", 4), ("ción", "filename", "^https://m\\.", 4),
]
PAGE = """WITH h AS (SELECT page_id AS id, url, regexp_extract(html, '<title>([^<]*)</title>', 1) AS title, regexp_extract(html, '<h1>([^<]*)</h1>', 1) AS h1,
  trim(regexp_replace(regexp_replace(regexp_replace(html, '(?s)<(script|style)>.*?</(script|style)>|<!--.*?-->', ' ', 'g'), '<[^>]*>', ' ', 'g'), '\\s+', ' ', 'g')) AS text FROM pages),
p AS (SELECT *, left(text, 1000) AS header, CASE WHEN length(text) > 1300 THEN text[1001 : length(text) - 300] ELSE '' END AS body, CASE WHEN length(text) > 300 THEN right(text, 300) ELSE '' END AS footer FROM h)"""


def page_rules(spark) -> DataFrame:
    return spark.createDataFrame(RULES, "channel string, kind string, word string, priority int")


def rule_sql(strategy: str) -> str:
    """Each channel's word, name and exclusion tests spelled out."""
    channels = list(dict.fromkeys((c, p) for c, _, _, p in RULES))
    words = lambda c, kind: [w for x, k, w, _ in RULES if (x, k) == (c, kind)]
    has = lambda part, ws: "(" + " OR ".join(f"contains({part}, '{w}')" for w in ws) + ")" if ws else "false"
    first = "CASE" + "".join(f" WHEN contains(trim({t}), '{c}') THEN '{c}'" for t in ("title", "h1") for c, _ in channels) + " ELSE '' END"
    rows = " UNION ALL ".join(
        f"SELECT id, '{c}' AS channel, {p} AS priority, CASE WHEN named = '{c}' THEN 'metadata'"
        + "".join(f" WHEN regexp_matches(url, '{w}') THEN 'filename'" for w in words(c, "filename"))
        + "".join(f" WHEN {has(r, words(c, 'keyword'))} AND NOT {has('text', words(c, 'exclude'))} THEN '{r}'" for r in ("header", "body", "footer")) + " END AS source FROM n"
        for c, p in channels
    )
    pick = "arg_min(channel, priority)" if strategy == "priority" else "arg_min(channel, (-s, priority))"
    return PAGE + f""", n AS (SELECT *, {first} AS named FROM p), m AS ({rows}), s AS (SELECT *, CASE source WHEN 'metadata' THEN 1.0 WHEN 'filename' THEN 0.95 WHEN 'header' THEN 0.9 WHEN 'body' THEN 0.7 ELSE 0.6 END::DOUBLE AS s FROM m WHERE source IS NOT NULL),
g AS (SELECT id, {pick} AS channel, max(s) AS confidence, arg_min(source, (-s, priority)) AS source, list(s ORDER BY s DESC) AS l, string_agg(channel, ',' ORDER BY s DESC, priority) AS candidates FROM s GROUP BY id)
SELECT id, coalesce(channel, '일반') AS channel, coalesce(confidence, 0) AS confidence, coalesce(source, 'none') AS source, coalesce(l[2] / l[1] >= 0.3, false) AS mixed, coalesce(candidates, '') AS candidates FROM p LEFT JOIN g USING (id)"""


def pages(spark, d) -> DataFrame:
    """Pages as documents: title and first heading are metadata, the URL is the file name, the text is what stands outside tags."""
    text = F.regexp_replace(F.regexp_replace(F.regexp_replace("html", r"(?s)<(script|style)>.*?</(script|style)>|<!--.*?-->", " "), "<[^>]*>", " "), r"\s+", " ")
    part = lambda tag: F.regexp_extract("html", f"<{tag}>([^<]*)</{tag}>", 1)
    return table(spark, d, "pages").select(F.col("page_id").alias("id"), F.array(part("title"), part("h1")).alias("metadata"), F.col("url").alias("file_name"), F.trim(text).alias("text"))


def page_channels(spark, d, strategy: str) -> DataFrame:
    c = rule_classifier.classify(pages(spark, d), rule_classifier.compiled(page_rules(spark)), strategy)
    return c.select("id", "channel", "confidence", "source", "mixed", F.array_join("candidates", ",").alias("candidates"))


@query(rule_sql("frequency"))
def rule_channels(spark, d):
    return page_channels(spark, d, "frequency")


@query(rule_sql("priority"))
def rule_channels_by_priority(spark, d):
    return page_channels(spark, d, "priority")


@query(f"SELECT channel, source, count(*) AS n, count(*) FILTER (mixed) AS mixed FROM ({rule_sql('frequency')}) GROUP BY channel, source")
def rule_channel_counts(spark, d):
    return rule_classifier.region_counts(page_channels(spark, d, "frequency"))


# texts that were decoded wrongly: two of three documents are read as Latin-1 on purpose
def misread_documents(spark, d) -> DataFrame:
    wrong = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.when(F.col("doc_id") % 3 > 0, wrong).otherwise(F.col("text")).alias("text"), F.col("text").alias("original"))


#: What shows a sign of misreading when rightly read is left as it is; a misread text comes back but for those.
ENCODINGS = f"WITH e AS (SELECT doc_id AS id, text, doc_id % 3 > 0 AND regexp_matches(text, '[^\\x00-\\x7F]') AS wrong, regexp_matches(text, 'â€|[Ãìíëê{chr(0xFFFD)}]') AS sign FROM documents), r AS (SELECT id, text, CASE WHEN wrong AND NOT sign THEN 'fixed' WHEN sign THEN 'unfixable' ELSE 'valid' END AS encoding, NOT wrong OR NOT sign AS restored FROM e)"


@query(ENCODINGS + " SELECT id, encoding, restored FROM r")
def repaired_encodings(spark, d):
    return encoding.repair(misread_documents(spark, d)).select("id", "encoding", (F.col("text") == F.col("original")).alias("restored"))


@query(ENCODINGS + " SELECT encoding, count(*) AS n FROM r GROUP BY encoding")
def encoding_counts(spark, d):
    return encoding.repair_counts(encoding.repair(misread_documents(spark, d)))


# rows of tables as chunks, with the clause in force
HEADINGS = {"chapter": "^(Th|La|El)", "section": "^(An|Le|De)", "article": "^(In|É|As)", "appendix": "^(On|Ou|Ci)"}
CONTEXT = (
    ", li AS (SELECT doc_id AS id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS idx, trim(unnest(string_split(text, chr(10))), E' \\t\\r\\n') AS t FROM documents),"
    + " pl AS (SELECT id, idx, t, " + ", ".join(f"coalesce(max(CASE WHEN regexp_matches(t, '{p}') THEN idx END) OVER w, -1) AS {k}_at" for k, p in HEADINGS.items()) + " FROM li WINDOW w AS (PARTITION BY id ORDER BY idx)),"
    + " f AS (SELECT *, CASE WHEN article_at > greatest(appendix_at, chapter_at, section_at) THEN article_at WHEN section_at > greatest(appendix_at, chapter_at) THEN section_at WHEN chapter_at > appendix_at THEN chapter_at WHEN appendix_at >= 0 THEN appendix_at END AS clause_at,"
    + " (chapter_at > appendix_at)::INT + (section_at > greatest(appendix_at, chapter_at))::INT + (article_at > greatest(appendix_at, chapter_at, section_at))::INT + (appendix_at >= 0)::INT AS depth FROM pl),"
    + " ctx AS (SELECT f.id, f.idx, h.t AS clause_title, depth FROM f LEFT JOIN li h ON h.id = f.id AND h.idx = f.clause_at)"
)


def chunks_sql(place: str) -> str:
    return CELLS.replace("cells AS (SELECT doc_id AS id, table_no, row,", "cells AS (SELECT doc_id AS id, table_no, line_no, row,").replace("dense_rank() OVER (PARTITION BY doc_id ORDER BY run) - 1 AS table_no, row,", "dense_rank() OVER (PARTITION BY doc_id ORDER BY run) - 1 AS table_no, line_no, row,") + RELIABLE + GATED + CONTEXT + f""",
h AS (SELECT id, table_no, col, text AS header FROM cells WHERE row = 0),
s AS (SELECT id, table_no, row, string_agg(coalesce(header, 'col_' || col) || ': ' || text, ' | ' ORDER BY col) AS text FROM r LEFT JOIN h USING (id, table_no, col) WHERE (id, table_no) IN (SELECT (id, table_no) FROM gated WHERE passed) AND row > 0 AND text <> '' AND reliability >= 0.6 GROUP BY ALL),
first AS (SELECT id, table_no, min(line_no) AS line FROM cells GROUP BY ALL), e AS (SELECT id, max(idx) AS line FROM li GROUP BY id)
SELECT s.id, s.table_no, row, text, clause_title, CAST(coalesce(depth, 0) AS INTEGER) AS depth FROM s JOIN {place} LEFT JOIN ctx ON ctx.id = s.id AND ctx.idx = p.line"""


def row_chunks(spark, d, in_place: bool) -> DataFrame:
    c = table_chunks.table_row_chunks(texts(spark, d), " | ", HEADINGS, in_place=in_place)
    return c.select("id", "table_no", "row", "text", "clause_title", F.coalesce(F.size("heading_path"), F.lit(0)).alias("depth"))


@query(chunks_sql("e p ON p.id = s.id"))
def table_row_chunks(spark, d):
    return row_chunks(spark, d, False)


@query(chunks_sql("first p ON p.id = s.id AND p.table_no = s.table_no"))
def table_row_chunks_in_place(spark, d):
    return row_chunks(spark, d, True)


# an index of vectors, written and read back
def built_index(spark, d) -> vector_index.Index:
    path = shared_folder(spark, "index")
    vector_index.build(table(spark, d, "embeddings"), path)
    return vector_index.load(spark, path)


def asked(spark, d) -> DataFrame:
    return table(spark, d, "embeddings").filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")


@query("SELECT vec_id, label FROM embeddings WHERE embedding IS NOT NULL")
def indexed_vectors(spark, d):
    return built_index(spark, d).lists.select("vec_id", "label")


@query(VECTOR_SEARCH)
def index_search_exact(spark, d):
    return vector_index.search(built_index(spark, d), asked(spark, d), share=1.0).withColumn("score", F.round("score", 6))


@query()
def index_search(spark, d):
    return vector_index.search(built_index(spark, d), asked(spark, d)).withColumn("score", F.round("score", 6))


# metrics by grouping sets
FAILED = WORK + ", f AS (SELECT error, 'p' || (key % 3) AS parser, CASE WHEN event_id % 4 < 3 THEN '.' || (event_id % 4) END AS extension FROM work WHERE event = 'fail')"


def failed(spark, d) -> DataFrame:
    return work(spark, d).filter("event = 'fail'").select("error", F.concat(F.lit("p"), (F.col("key") % 3).cast("string")).alias("parser"), F.when(F.col("event_id") % 4 < 3, F.concat(F.lit("."), (F.col("event_id") % 4).cast("string"))).alias("extension"))


@query(FAILED + ", g AS (SELECT CASE WHEN GROUPING(e) = 0 THEN 'error' WHEN GROUPING(p) = 0 THEN 'parser' WHEN GROUPING(x) = 0 THEN 'extension' ELSE 'all' END AS dimension, coalesce(e, p, x, '') AS value, count(*) AS n FROM (SELECT error AS e, parser AS p, coalesce(extension, 'unknown') AS x FROM f) GROUP BY GROUPING SETS ((e), (p), (x), ())) SELECT dimension, value, n, round(100.0 * n / (SELECT count(*) FROM f), 6) AS percent FROM g")
def failure_metrics(spark, d):
    return run_metrics.failures(failed(spark, d))


RUNS = "WITH r AS (SELECT CASE o_orderstatus WHEN 'F' THEN 'success' WHEN 'P' THEN 'skipped' ELSE 'error' END AS status, CASE o_orderpriority WHEN '1-URGENT' THEN 'timeout' WHEN '2-HIGH' THEN 'crash' ELSE 'other' END AS reason, 'p' || (o_custkey % 4) AS parser, CAST(o_orderkey % 50 AS DOUBLE) AS seconds FROM orders)"


def run_results(spark, d) -> DataFrame:
    status = F.when(F.col("o_orderstatus") == "F", "success").when(F.col("o_orderstatus") == "P", "skipped").otherwise("error")
    reason = F.when(F.col("o_orderpriority") == "1-URGENT", "timeout").when(F.col("o_orderpriority") == "2-HIGH", "crash").otherwise("other")
    return table(spark, d, "orders").select(status.alias("status"), reason.alias("reason"), F.concat(F.lit("p"), (F.col("o_custkey") % 4).cast("string")).alias("parser"), (F.col("o_orderkey") % 50).cast("double").alias("seconds"))


RUN_METRICS = RUNS + """, g AS (SELECT CASE WHEN GROUPING(parser) = 0 THEN 'parser' ELSE 'all' END AS dimension, coalesce(parser, '') AS value, count(*) AS total, count(*) FILTER (status = 'success') AS success, count(*) FILTER (status = 'skipped') AS skipped, count(*) FILTER (status = 'error') AS errors,
 count(*) FILTER (status = 'error' AND reason = 'timeout') AS timeout, count(*) FILTER (status = 'error' AND reason = 'crash') AS crash, sum(seconds) AS seconds FROM r GROUP BY GROUPING SETS ((parser), ()))
SELECT dimension, value, total, success, skipped, errors, timeout, crash, round(100.0 * total / (SELECT count(*) FROM r), 2) AS share, round(100.0 * success / (success + errors), 2) AS success_percent, round(100.0 * errors / (success + errors), 2) AS failure_percent, seconds, round(60.0 * success / seconds, 2) AS per_minute FROM g"""


@query(RUN_METRICS)
def runner_metrics(spark, d):
    return run_metrics.runs(run_results(spark, d))


@query(RUN_METRICS.replace("SELECT dimension, value, total", ", m AS (SELECT dimension, value, total") + ") SELECT 'High failure rate (' || failure_percent || '%) - investigate primary parser issues' AS advice FROM m WHERE dimension = 'all' AND failure_percent > 50")
def run_advice(spark, d):
    return run_metrics.advice(run_metrics.runs(run_results(spark, d)), run_metrics.failures(failed(spark, d)))


# functions called from SQL
LATIN_HEADERS = {"special_clause": "^(Th|La).*[.]$", "coverage": "^(An|Le)", "appendix": "^(On|El)", "addendum": "^(In|De)"}
LATIN_ARTICLE = "^[A-ZÉ][a-zé]{1,3} "
LINES = "SELECT doc_id AS id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS line_no, unnest(string_split(text, chr(10))) AS line FROM documents"
SEGMENTS = f"""WITH l AS ({LINES}), k AS (SELECT *, trim(line, E' \\t\\r\\n') AS s FROM l), b AS (SELECT *, CASE WHEN s LIKE '##%' THEN trim(ltrim(s, '#'), E' \\t\\r\\n') ELSE s END AS bare FROM k),
h AS (SELECT *, CASE {' '.join(f"WHEN regexp_matches({'s' if k == 'appendix' else 'bare'}, '{p}')" + (' AND length(bare) > 3' if k == 'coverage' else '') + f" THEN '{k}'" for k, p in LATIN_HEADERS.items())} END AS kind, regexp_matches(s, '{LATIN_ARTICLE}')::INT AS article FROM b),
g AS (SELECT *, count(kind) OVER (PARTITION BY id ORDER BY line_no) AS seg, count(kind) OVER (PARTITION BY id) AS n FROM h),
z AS (SELECT id, greatest(seg, 1) AS segment, coalesce(max(kind), 'document') AS kind, CASE WHEN max(n) = 0 THEN '전체문서' ELSE arg_min(CASE WHEN kind = 'appendix' THEN s ELSE bare END, line_no) END AS title, min(line_no) AS start_line, max(line_no) AS end_line, length(trim(string_agg(line, chr(10) ORDER BY line_no), E' \\t\\r\\n')) AS n_chars, sum(article) AS a FROM g WHERE seg > 0 OR n = 0 GROUP BY id, greatest(seg, 1))"""


def lines(spark, d) -> DataFrame:
    return texts(spark, d).select("id", F.posexplode(F.split("text", "\n")).alias("line_no", "line"))


@query(SEGMENTS + """ SELECT id, segment, kind, title, start_line, end_line, n_chars, CASE WHEN kind IN ('special_clause', 'coverage', 'document') THEN a ELSE 0 END::BIGINT AS n_articles, concat_ws(',', CASE WHEN n_chars > 12000 THEN 'too_long' END, CASE WHEN kind = 'special_clause' AND a = 0 AND n_chars > 500 THEN 'no_articles' END, CASE WHEN length(title) < 3 THEN 'short_title' END) AS warnings FROM z""")
def simple_clause_segments(spark, d):
    s = clause_headers.segment_warnings(clause_headers.simple_segments(lines(spark, d), LATIN_HEADERS, LATIN_ARTICLE))
    return s.withColumn("warnings", F.array_join("warnings", ","))


@query(SEGMENTS + " SELECT id, CAST(segment AS INTEGER) AS segment, kind, title, start_line, end_line, CAST(CASE WHEN kind IN ('special_clause', 'coverage', 'document') THEN a ELSE 0 END AS INTEGER) AS n_articles FROM z")
def sql_clause_segments(spark, d):
    sql.register(spark)
    return spark.sql("SELECT * FROM clause_segments(TABLE({lines}) PARTITION BY id ORDER BY (line_no), {headers}, {article})", lines=lines(spark, d), headers=json.dumps(LATIN_HEADERS), article=LATIN_ARTICLE)


@query(f"SELECT doc_id AS id, md5({SQUASH}) AS content_key, CAST(len(regexp_extract_all(text, '[\\p{{L}}\\p{{N}}_]+')) AS INTEGER) AS n_words, round(length(regexp_replace(text, '[\\p{{L}}\\p{{N}}_\\s]', '', 'g')) / length(text), 6) AS special_share, CASE WHEN length(text) % 10 >= 6 THEN 'auto' WHEN length(text) % 10 >= 4 THEN 'review' ELSE 'unclassified' END AS route FROM documents WHERE length(text) > 0")
def sql_scalars(spark, d):
    sql.register(spark)
    return spark.sql("SELECT id, content_key(text) AS content_key, n_words(text) AS n_words, round(special_share(text), 6) AS special_share, routed(length(text) % 10, 6, 4) AS route FROM {t} WHERE length(text) > 0", t=texts(spark, d))


PATH = "CASE doc_id % 4 WHEN 0 THEN '/data/' || source || '/terms_' || doc_id || '.pdf' WHEN 1 THEN source || '.v2.pdf' WHEN 2 THEN source || '/요약서.pdf' END"


@query("WITH" + CONTEXT.removeprefix(",") + f""", a AS (SELECT doc_id AS id, {PATH} AS path FROM documents)
SELECT li.id, li.idx, md5(li.t) AS text, CASE WHEN path LIKE '%요약서%' THEN 'paraphrase' ELSE 'canonical' END AS role, CASE WHEN path LIKE '%/%' THEN regexp_extract(path, '([^/]+)/[^/]*$', 1) ELSE coalesce(regexp_replace(path, '\\.pdf$', ''), '') END AS product_id, CASE WHEN li.id % 3 = 0 THEN '202401' ELSE 'unknown' END AS version, clause_title, CAST(coalesce(depth, 0) AS INTEGER) AS depth FROM li JOIN a ON a.id = li.id LEFT JOIN ctx ON ctx.id = li.id AND ctx.idx = li.idx WHERE li.t <> ''""")
def paragraph_chunks(spark, d):
    docs = table(spark, d, "documents").select(F.col("doc_id").alias("id"), "text", F.expr(PATH).alias("path"), F.when(F.col("doc_id") % 3 == 0, "202401").alias("version"))
    c = table_chunks.paragraph_chunks(docs, HEADINGS)
    return c.select("id", "idx", F.md5("text").alias("text"), "role", "product_id", "version", "clause_title", F.size("heading_path").alias("depth"))
