"""Queries over the driver's tables, one for each operator, and SQL for DuckDB that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import answers, chunking, classify, dedup, records, retrieval, tables
from quern.plans.common import CELLS, CHANNEL, GATED, GREEDY, ORACLE_SQL, QUERIES, RELIABLE, SQUASH, STRUCTURAL, VECTOR_SEARCH, WORK, examples, query, table, texts, work
from quern.sources import files
from quern.streaming import ledger

# deduplication
@query(f"""WITH k AS (SELECT doc_id, CASE WHEN length(text) < 50 THEN 'short-' || doc_id ELSE md5({SQUASH}) END AS k FROM documents)
SELECT min(doc_id) AS ord FROM k GROUP BY k""")
def exact_dedup(spark, d):
    return dedup.exact(examples(spark, d)).select("ord")


@query(f"SELECT left(md5({SQUASH}), 8) AS hash, count(*) AS n, min(doc_id) AS first_ord, max(doc_id) AS last_ord, count(DISTINCT source) AS n_sources FROM documents GROUP BY md5({SQUASH}) HAVING count(*) > 1")
def duplicate_clusters(spark, d):
    return dedup.clusters(examples(spark, d))


@query("SELECT source, count(*) AS n, count(*) FILTER (length(text) < 100) AS short, count(*) FILTER (length(text) >= 100 AND length(text) < 500) AS medium, count(*) FILTER (length(text) >= 500) AS long, round(avg(length(text)), 6) AS mean_length FROM documents GROUP BY source")
def source_counts(spark, d):
    return dedup.source_counts(examples(spark, d))


SEMANTIC = """WITH RECURSIVE t0 AS (SELECT doc_id, regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+') AS w FROM documents),
classes AS (SELECT doc_id AS ord, CASE WHEN len(w) > 0 THEN min(doc_id) OVER (PARTITION BY list_sort(w)) ELSE doc_id END AS class FROM t0),
w AS (SELECT doc_id, unnest(w) AS word FROM t0),
tf AS (SELECT doc_id, word, count(*) AS k FROM w GROUP BY ALL), df AS (SELECT word, count(*) AS df FROM tf GROUP BY ALL), t AS (SELECT doc_id, sum(k) AS total FROM tf GROUP BY ALL),
v AS (SELECT doc_id, word, k / total * (SELECT count(*) FROM documents) / (df + 1) AS x FROM tf JOIN t USING (doc_id) JOIN df USING (word)),
n AS (SELECT doc_id, sqrt(sum(x * x)) AS n FROM v GROUP BY ALL), u AS (SELECT doc_id, word, x / n AS u FROM v JOIN n USING (doc_id) JOIN classes ON ord = doc_id AND class = doc_id),
pairs AS MATERIALIZED (SELECT a.doc_id AS a, b.doc_id AS b, sum(a.u * b.u) AS s FROM u a JOIN u b ON a.word = b.word AND a.doc_id < b.doc_id GROUP BY ALL HAVING sum(a.u * b.u) >= 0.85)"""
@query("""WITH f AS (SELECT doc_id, source, length(text) AS n, list_distinct(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')[1:10]) AS w FROM documents),
p AS (SELECT a.doc_id AS a, b.doc_id AS b, (0.6 + 0.2 + CASE WHEN a.n = 0 AND b.n = 0 THEN 0.1 WHEN a.n > 0 AND b.n > 0 THEN 0.1 * (1 - abs(a.n - b.n) / greatest(a.n, b.n)) ELSE 0 END
  + 0.3 * len(list_intersect(a.w, b.w)) / greatest(1, len(list_distinct(list_concat(a.w, b.w))))) / 1.2 AS s
  FROM f a JOIN f b ON a.source = b.source AND a.doc_id < b.doc_id)
SELECT a, b, round(s, 6) AS similarity FROM p WHERE s >= 0.85""")
def structural_pairs(spark, d):
    e = examples(spark, d)
    return dedup.members_pairs(dedup.structural_pairs(e), dedup.structural_classes(e)).withColumn("similarity", F.round("similarity", 6))


@query(STRUCTURAL + " SELECT ord, class FROM classes")
def structural_classes(spark, d):
    return dedup.structural_classes(examples(spark, d))


@query(STRUCTURAL + GREEDY)
def structural_dedup(spark, d):
    return dedup.structural(examples(spark, d)).select("ord")


@query("""WITH w AS (SELECT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS word FROM documents),
tf AS (SELECT doc_id, word, count(*) AS k FROM w GROUP BY ALL), df AS (SELECT word, count(*) AS df FROM tf GROUP BY ALL), t AS (SELECT doc_id, sum(k) AS total FROM tf GROUP BY ALL),
v AS (SELECT doc_id, word, k / total * (SELECT count(*) FROM documents) / (df + 1) AS x FROM tf JOIN t USING (doc_id) JOIN df USING (word)),
n AS (SELECT doc_id, sqrt(sum(x * x)) AS n FROM v GROUP BY ALL), u AS (SELECT doc_id, word, x / n AS u FROM v JOIN n USING (doc_id))
SELECT a.doc_id AS a, b.doc_id AS b, round(sum(a.u * b.u), 5) AS similarity FROM u a JOIN u b ON a.word = b.word AND a.doc_id < b.doc_id GROUP BY ALL HAVING sum(a.u * b.u) >= 0.85""")
def semantic_pairs(spark, d):
    e = examples(spark, d)
    return dedup.members_pairs(dedup.semantic_pairs(e), dedup.semantic_classes(e)).withColumn("similarity", F.round("similarity", 5))


@query(SEMANTIC + " SELECT ord, class FROM classes")
def semantic_classes(spark, d):
    return dedup.semantic_classes(examples(spark, d))


@query(SEMANTIC + GREEDY)
def semantic_dedup(spark, d):
    return dedup.semantic(examples(spark, d)).select("ord")


@query(f"WITH h AS (SELECT md5({SQUASH}) AS h, doc_id, source FROM documents), n AS (SELECT *, count(*) OVER (PARTITION BY h) AS n, row_number() OVER (PARTITION BY h ORDER BY doc_id) AS place FROM h) SELECT left(h, 8) AS hash, doc_id AS ord, source, CAST(place AS INTEGER) AS place FROM n WHERE n > 1")
def cluster_members(spark, d):
    return dedup.members(examples(spark, d))


@query("SELECT word, count(*) AS df, round((SELECT count(*) FROM documents) / (count(*) + 1), 6) AS idf FROM (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[\\p{L}\\p{N}_]+')) AS word FROM documents) GROUP BY word")
def vocabulary(spark, d):
    return answers.vocabulary(texts(spark, d).select("id", T.word_tokens(F.col("text")).alias("words")))


# text functions and filters
@query("""WITH t AS (SELECT doc_id AS id, length(text) AS n, length(text) - length(regexp_replace(text, '[\\x00-\\x08\\x0b\\x0c\\x0e-\\x1f]', '', 'g')) AS c, length(text) - length(replace(text, '�', '')) AS b, length(text) - length(regexp_replace(text, '[-]', '', 'g')) AS p FROM documents)
SELECT id, CASE WHEN n <= 2 THEN c + b + p = 0 ELSE b <= 0.05 * n AND c <= 0.02 * n AND (n < 10 OR p <= 0.2 * n) END AS sane FROM t""")
def text_sanity(spark, d):
    return texts(spark, d).select("id", T.sane(F.col("text")).alias("sane"))


CLEAN = "text"
for _p, _b in ((r"[\x00-\x08\x0b\x0c\x0e-\x1f\x7f]", ""), (r"[!@#$%^&*()]{3,}", ""), (r"\.{4,}", "..."), (r"-{4,}", "---"), (r"_{4,}", "___"), (r"~{3,}", "~~"), (r" {2,}", " "), (r"\n{3,}", "\n\n"), (r" +\n", "\n"), (r"\n +", "\n")):
    CLEAN = f"regexp_replace({CLEAN}, '{_p}', '{_b}', 'g')"


@query(f"SELECT doc_id AS id, md5(trim({CLEAN}, E' \\t\\n\\r')) AS cleaned, trim({CLEAN}, E' \\t\\n\\r') <> text AS modified FROM documents")
def text_repair(spark, d):
    c = T.clean(F.col("text"))
    return texts(spark, d).select("id", F.md5(c).alias("cleaned"), (c != F.col("text")).alias("modified"))


VALID = "(length(text) >= 20 AND (length(text) - length(replace(text, left(text, 10), ''))) // length(left(text, 10)) <= length(text) / 20 AND length(text) - length(regexp_replace(text, '[^\\p{L}\\p{N}_\\s]', '', 'g')) <= 0.3 * length(text))"


@query(f"SELECT doc_id AS id, {VALID} AS valid FROM documents")
def example_validity(spark, d):
    return texts(spark, d).select("id", records.valid_output(F.col("text")).alias("valid"))


@query(f"SELECT min(doc_id) AS ord FROM documents WHERE length(trim(text, E' \\t\\n\\r')) >= 10 AND {VALID} GROUP BY md5(text)")
def integrity_filter(spark, d):
    return records.integrity(examples(spark, d)).select("ord")


@query("SELECT doc_id AS id, length(regexp_replace(text, '\\s', '', 'g')) < 100 AS needs_ocr FROM documents")
def triage(spark, d):
    return texts(spark, d).select("id", (F.length(F.regexp_replace("text", r"\s", "")) < 100).alias("needs_ocr"))


@query("SELECT doc_id AS id, CAST(greatest(120, least(3600, CASE WHEN n_chars <= 10 THEN 300 WHEN n_chars <= 50 THEN 600 WHEN n_chars <= 100 THEN 1200 ELSE 1800 END + CAST(floor((n_chars % 700) * 0.5) AS BIGINT))) AS INTEGER) AS timeout_s FROM documents")
def dynamic_timeout(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), files.timeout_s(F.col("n_chars") * (1 << 20), F.col("n_chars") % 700).alias("timeout_s"))


@query("SELECT doc_id AS id, f AS first, least(f + 49, n) AS last FROM (SELECT doc_id, n_chars % 500 AS n, unnest(range(1, n_chars % 500 + 1, 50)) AS f FROM documents)")
def page_ranges(spark, d):
    return table(spark, d, "documents").select(F.col("doc_id").alias("id"), F.explode(files.page_ranges(F.col("n_chars") % 500)).alias("x")).select("id", "x.first", "x.last")


# classification
@query("SELECT doc_id AS id, CASE WHEN regexp_matches(source, '(?i)약관|terms') THEN 'terms_and_conditions' WHEN regexp_matches(source, '(?i)사업방법서|business') THEN 'business_method' WHEN regexp_matches(source, '(?i)요약서|summary') THEN 'product_summary' WHEN regexp_matches(source, '(?i)금감원|fss|보도자료|press') THEN 'fss_release' WHEN regexp_matches(source, '(?i)판례|precedent|판결') THEN 'court_precedent' WHEN regexp_matches(text, '보험.*약관|약관.*보험') THEN 'terms_and_conditions' WHEN regexp_matches(text, '보험료.*산출|산출.*보험료') THEN 'business_method' WHEN regexp_matches(text, '청구.*절차|절차.*청구') THEN 'claims_process' ELSE 'general' END AS label, CASE WHEN regexp_matches(source, '약관') THEN 'canonical' WHEN regexp_matches(source, '요약서') THEN 'paraphrase' WHEN regexp_matches(source, '사업방법서') THEN 'operational' ELSE 'canonical' END AS role, CASE WHEN regexp_matches(text, '절차|방법|처리|운영|심사|프로세스') THEN 'operation' WHEN regexp_matches(text, '쉽게|요약|설명|간단히|핵심') THEN 'explanation' ELSE 'definition' END AS query_type FROM documents")
def document_labels(spark, d):
    return texts(spark, d).select("id", classify.document_label(F.col("source"), F.col("text")).alias("label"), classify.document_role(F.col("source")).alias("role"), classify.query_type(F.col("text")).alias("query_type"))


@query("SELECT doc_id AS id, (length(text) - length(replace(lower(text), 'tm', 'x'))) AS n FROM documents WHERE regexp_matches(text, '(?i)tm')")
def channel_matches(spark, d):
    c = classify.channel_candidates(texts(spark, d)).filter("channel = 'TM'")
    return c.select("id", F.col("n_keywords").alias("n"))


def channel_scores(spark, d):
    c = classify.channel_candidates(texts(spark, d))
    return classify.best_channel(c.withColumn("score", F.col("confidence") * 0.6))


@query(CHANNEL + " SELECT id, channel, round(s, 6) AS confidence, CASE WHEN s >= 0.35 THEN 'auto' WHEN s >= 0.2 THEN 'review' ELSE 'unclassified' END AS route FROM b WHERE r = 1")
def ensemble_channel(spark, d):
    b = channel_scores(spark, d)
    return b.select("id", "channel", F.round("confidence", 6).alias("confidence"), classify.route(F.col("confidence"), 0.35, 0.2).alias("route"))


@query(CHANNEL + ", t AS (SELECT CASE WHEN s >= 0.35 THEN 'auto' WHEN s >= 0.2 THEN 'review' ELSE 'unclassified' END AS route FROM b WHERE r = 1) SELECT route, count(*) AS n, round(100.0 * count(*) / (SELECT count(*) FROM t), 6) AS percent FROM t GROUP BY route")
def route_counts(spark, d):
    return classify.route_counts(channel_scores(spark, d).select(classify.route(F.col("confidence"), 0.35, 0.2).alias("route")))


def predictions(spark, d) -> DataFrame:
    """Labels as truth, a length rule as prediction."""
    docs = table(spark, d, "documents").select("doc_id", F.when(F.length("text") % 7 < 5, "q1").otherwise("q0").alias("predicted"), ((F.length("text") % 10) / 10).alias("confidence"))
    return docs.join(table(spark, d, "labels").select("doc_id", F.concat(F.lit("q"), F.col("quality").cast("string")).alias("actual")), "doc_id")


PREDICTED = "WITH p AS (SELECT 'q' || quality AS actual, CASE WHEN length(text) % 7 < 5 THEN 'q1' ELSE 'q0' END AS predicted, (length(text) % 10) / 10 AS confidence FROM documents JOIN labels USING (doc_id))"
SCORES = "SELECT g, label, count(*) FILTER (actual = label) AS support, count(*) FILTER (predicted = label) AS p, count(*) FILTER (actual = label AND predicted = label) AS tp"


@query(PREDICTED + ", s AS (SELECT label, count(*) FILTER (actual = label) AS support, count(*) FILTER (predicted = label) AS p, count(*) FILTER (actual = label AND predicted = label) AS tp FROM p, (VALUES ('q0'), ('q1')) l(label) GROUP BY label) SELECT label, support, round(CASE WHEN p > 0 THEN tp / p ELSE 0 END, 6) AS precision, round(tp / support, 6) AS recall, round(CASE WHEN tp > 0 THEN 2 * (tp / p) * (tp / support) / (tp / p + tp / support) ELSE 0 END, 6) AS f1 FROM s WHERE support > 0")
def class_scores(spark, d):
    return classify.class_scores(predictions(spark, d))


@query(PREDICTED + " SELECT a AS actual, b AS predicted, count(p.actual) AS n FROM (VALUES ('q0'), ('q1')) x(a) CROSS JOIN (VALUES ('q0'), ('q1')) y(b) LEFT JOIN p ON p.actual = a AND p.predicted = b GROUP BY a, b")
def confusion(spark, d):
    return classify.confusion(predictions(spark, d))


@query(PREDICTED + ", q AS (SELECT t, actual, CASE WHEN confidence >= t THEN predicted ELSE 'unclassified' END AS predicted FROM p, (VALUES (0.25), (0.45), (0.65)) v(t)), s AS (SELECT t, label, count(*) FILTER (actual = label) AS support, count(*) FILTER (predicted = label) AS p, count(*) FILTER (actual = label AND predicted = label) AS tp FROM q, (VALUES ('q0'), ('q1')) l(label) GROUP BY t, label), f AS (SELECT t, round(CASE WHEN tp > 0 THEN 2 * (tp / p) * (tp / support) / (tp / p + tp / support) ELSE 0 END, 6) AS f1 FROM s WHERE support > 0) SELECT CAST(t AS DOUBLE) AS threshold, round(avg(f1), 6) AS macro_f1 FROM f GROUP BY t")
def threshold_sweep(spark, d):
    return classify.threshold_sweep(predictions(spark, d), [0.25, 0.45, 0.65])


@query("SELECT doc_id AS id FROM documents WHERE doc_id IN (SELECT doc_id FROM labels WHERE toxic = 1)")
def labelled_only(spark, d):
    return texts(spark, d).select("id").join(table(spark, d, "labels").filter("toxic = 1").select(F.col("doc_id").alias("id")), "id", "left_semi")


# tables
def cells(spark, d) -> DataFrame:
    return tables.detect(texts(spark, d).select("id", "text"), " | ")


def reliable(spark, d) -> DataFrame:
    return cells(spark, d).withColumn("reliability", tables.reliability(F.col("text")))


@query(CELLS + " SELECT id, table_no, row, col, text FROM cells")
def table_detection(spark, d):
    return cells(spark, d)


@query(CELLS + RELIABLE + " SELECT id, table_no, row, col, round(reliability, 6) AS reliability FROM r")
def cell_reliability(spark, d):
    return reliable(spark, d).select("id", "table_no", "row", "col", F.round("reliability", 6).alias("reliability"))


@query(CELLS + RELIABLE + GATED + " SELECT id, table_no, fill_rate, low_conf_ratio, header_ok, passed FROM gated")
def table_gate(spark, d):
    return tables.gate(reliable(spark, d)).select("id", "table_no", "fill_rate", "low_conf_ratio", "header_ok", "passed")


@query(CELLS + RELIABLE + ", h AS (SELECT id, table_no, col, text AS header FROM cells WHERE row = 0) SELECT id, table_no, row, string_agg(coalesce(header, 'col_' || col) || ': ' || text, ' | ' ORDER BY col) AS sentence FROM r LEFT JOIN h USING (id, table_no, col) WHERE row > 0 AND text <> '' AND reliability >= 0.6 GROUP BY ALL")
def row_sentences(spark, d):
    return tables.row_sentences(reliable(spark, d))


@query(CELLS + ", w AS (SELECT id, table_no, max(col) + 1 AS width FROM cells GROUP BY ALL), gr AS (SELECT id, table_no, row, unnest(range(width)) AS col FROM (SELECT DISTINCT id, table_no, row FROM cells) JOIN w USING (id, table_no)) SELECT id, table_no, row, '| ' || string_agg(coalesce(text, ''), ' | ' ORDER BY col) || ' |' AS line FROM gr LEFT JOIN cells USING (id, table_no, row, col) GROUP BY ALL")
def table_markdown(spark, d):
    return tables.markdown_rows(cells(spark, d))


@query(CELLS + ", w AS (SELECT id, table_no, max(col) + 1 AS width FROM cells GROUP BY ALL), gr AS (SELECT id, table_no, row, unnest(range(width)) AS col FROM (SELECT DISTINCT id, table_no, row FROM cells) JOIN w USING (id, table_no)), l0 AS (SELECT id, table_no, row, count(*) AS n, '| ' || string_agg(coalesce(text, ''), ' | ' ORDER BY col) || ' |' AS line FROM gr LEFT JOIN cells USING (id, table_no, row, col) GROUP BY ALL), li AS (SELECT id, table_no, row, line || CASE WHEN row = 0 THEN chr(10) || '|' || repeat(' --- |', n::INT) ELSE '' END AS line FROM l0) SELECT id, table_no, md5(string_agg(line, chr(10) ORDER BY row)) AS output_md5, count(*) AS n_rows FROM li GROUP BY ALL")
def table_examples(spark, d):
    e = records.table_examples(cells(spark, d))
    return e.select("id", "table_no", F.md5("output").alias("output_md5"), F.col("n_rows").cast("long").alias("n_rows"))


# records
@query("SELECT doc_id AS id, CASE WHEN text = '' THEN 0 ELSE 1 END AS n_messages, text <> '' AND length(text) > 100 AS thinks, md5(CASE WHEN length(text) > 100 THEN '<think>' || chr(10) || chr(10) || '</think>' || chr(10) || chr(10) || text ELSE text END) AS output FROM documents")
def chat_messages(spark, d):
    e = examples(spark, d)
    out = records.think(F.col("output"))
    return e.select(F.col("ord").alias("id"), F.size(records.messages()).alias("n_messages"), (out != F.col("output")).alias("thinks"), F.md5(out).alias("output"))


@query("SELECT doc_id AS id, round(CASE WHEN length(text) >= 50 THEN 0.3 WHEN length(text) >= 20 THEN 0.15 ELSE 0 END + CASE WHEN w >= 10 THEN 0.3 WHEN w >= 5 THEN 0.15 ELSE 0 END + CASE WHEN regexp_matches(rtrim(text, E' \\t\\n\\r'), '[.!?]$') THEN 0.4 ELSE 0 END, 6)::DOUBLE AS completeness FROM (SELECT *, len(regexp_extract_all(text, '[^\\s]+')) AS w FROM documents)")
def completeness_score(spark, d):
    return texts(spark, d).select("id", F.round(records.completeness(F.col("text")), 6).alias("completeness"))


#: RE2 has no back-references: runs of six equal characters, spelled out.
SIX = "|".join(f"{c}{{6}}" for c in "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789éèêçñßüöäóíáúÉÈÊÇÑÜÖÄÓÍÁÚ!#%&=:;,'_ -")


@query(f"""WITH t AS (SELECT doc_id AS id, text AS t, list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '') AS w FROM documents)
SELECT id, round(CASE WHEN t = '' THEN 0 ELSE greatest(0, 1 - CASE WHEN regexp_matches(t, '[!@#$%^&*()]{{4,}}') THEN 0.2 ELSE 0 END - CASE WHEN regexp_matches(t, '{SIX.replace("'", "''")}') THEN 0.2 ELSE 0 END - CASE WHEN len(w) > 10 AND len(list_distinct(w)) < 0.3 * len(w) THEN 0.3 ELSE 0 END
  - CASE WHEN (length(t) - length(replace(t, chr(10) || chr(10), ''))) / 2 > 0.1 * length(t) THEN 0.1 ELSE 0 END) END, 6)::DOUBLE AS quality FROM t""")
def text_quality(spark, d):
    return texts(spark, d).select("id", F.round(records.text_quality(F.col("text")), 6).alias("quality"))


@query("WITH r AS (SELECT doc_id AS id, row_number() OVER (ORDER BY md5(doc_id || ':42'), doc_id) - 1 AS r, count(*) OVER () AS n FROM documents) SELECT id, CASE WHEN r < floor(n * 0.8) THEN 'train' WHEN r < floor(n * 0.8) + floor(n * 0.1) THEN 'validation' ELSE 'test' END AS split FROM r")
def exact_split(spark, d):
    return records.split(texts(spark, d).select("id")).select("id", "split")


@query("SELECT doc_id AS id, md5(left(text, 8000)) AS input, length(text) > 8000 AS truncated, CAST(length(text) AS INTEGER) AS original_length FROM documents WHERE length(text) > 500")
def summary_examples(spark, d):
    return records.summaries(texts(spark, d)).withColumn("input", F.md5("input"))


# chunks
@query("WITH p AS (SELECT doc_id AS id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS idx, trim(unnest(string_split(text, chr(10))), E' \\t\\r\\n') AS t FROM documents), k AS (SELECT *, max(CASE WHEN regexp_matches(t, '^별표\\s*\\d+') THEN idx END) OVER (PARTITION BY id ORDER BY idx) AS a FROM p) SELECT id, idx, CASE WHEN a IS NULL THEN NULL ELSE (SELECT t FROM p q WHERE q.id = k.id AND q.idx = k.a) END AS clause_title, CASE WHEN a IS NULL THEN 0 ELSE 1 END AS depth FROM k")
def clause_context(spark, d):
    p = texts(spark, d).select("id", F.posexplode(F.split("text", "\n")).alias("idx", "text"))
    return chunking.clause_context(p).select("id", "idx", "clause_title", F.size("heading_path").alias("depth"))


@query("""WITH RECURSIVE p AS (SELECT doc_id AS id, generate_subscripts(string_split(text, chr(10)), 1) AS k, unnest(string_split(text, chr(10))) AS p FROM documents),
g(id, k, p, held, chunk_no) AS (SELECT id, k, p, length(p) + 2, 0 FROM p WHERE k = 1 UNION ALL SELECT p.id, p.k, p.p, CASE WHEN held + length(p.p) + 2 <= 1000 THEN held + length(p.p) + 2 ELSE length(p.p) + 2 END, CASE WHEN held + length(p.p) + 2 <= 1000 THEN chunk_no ELSE chunk_no + 1 END FROM g JOIN p ON p.id = g.id AND p.k = g.k + 1),
c AS (SELECT id, chunk_no, trim(string_agg(p, chr(10) || chr(10) ORDER BY k), E' \\t\\r\\n') AS text FROM g GROUP BY id, chunk_no) SELECT id, chunk_no, md5(text) AS text FROM c WHERE text <> ''""")
def packed_chunks(spark, d):
    return chunking.pack(texts(spark, d).select("id", F.split("text", "\n").alias("paragraphs"))).select("id", "chunk_no", F.md5("text").alias("text"))


@query("WITH l AS (SELECT doc_id AS id, CAST(generate_subscripts(string_split(text, chr(10)), 1) - 1 AS INTEGER) AS i, unnest(string_split(text, chr(10))) AS line FROM documents), s AS (SELECT *, sum(regexp_matches(line, '^Th')::INT) OVER (PARTITION BY id ORDER BY i) AS segment FROM l) SELECT id, CAST(segment AS BIGINT) AS segment, min(i) AS start_line, max(i) AS end_line, arg_min(line, i) AS title, CAST(sum(length(line)) AS BIGINT) AS n_chars FROM s WHERE segment > 0 GROUP BY id, segment")
def header_segments(spark, d):
    return chunking.segments(texts(spark, d), "^Th")


# retrieval
@query(VECTOR_SEARCH)
def vector_search(spark, d):
    v = table(spark, d, "embeddings")
    q = v.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    return retrieval.search(v, q).withColumn("score", F.round("score", 6))


# answers
@query("WITH t AS (SELECT doc_id AS id, regexp_matches(text, '[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}') AS e, regexp_matches(text, '01[016789]-?[0-9]{3,4}-?[0-9]{4}') AS p, regexp_matches(text, '[0-9]{6}-[1-4][0-9]{6}') AS r, regexp_matches(text, '[0-9]{4}-[0-9]{4}-[0-9]{4}-[0-9]{4}') AS c, regexp_matches(text, '[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}\\.[0-9]{1,3}') AS i FROM documents) SELECT id, concat_ws(',', CASE WHEN e THEN 'email' END, CASE WHEN p THEN 'phone' END, CASE WHEN r THEN 'resident' END, CASE WHEN c THEN 'card' END, CASE WHEN i THEN 'ip' END) AS pii FROM t")
def personal_data(spark, d):
    return texts(spark, d).select("id", F.array_join(answers.pii(F.col("text")), ",").alias("pii"))


WHOLE_WORD = lambda w: f"regexp_matches(o, '(?i)(^|[^\\p{{L}}\\p{{N}}_]){w}($|[^\\p{{L}}\\p{{N}}_])')"
LEAKED = " OR ".join(map(WHOLE_WORD, ("let''?s think", "chain of thought", "step\\s*by\\s*step", "추론", "먼저($|[^\\p{L}\\p{N}_])(.*[^\\p{L}\\p{N}_])?다음")))
GENERAL, SURE = (" OR ".join(map(WHOLE_WORD, x)) for x in (("일반적으로", "보통", "대개", "통상", "대부분"), ("반드시", "무조건", "항상", "확실히")))
#: Of records r (id, instruction, canonical, summary, operational, output, product_id, version).
FINDINGS = f""", n AS (SELECT id, coalesce(instruction, '') AS instruction, coalesce(canonical, '') AS canonical, coalesce(summary, '') AS summary, coalesce(operational, '') AS operational, coalesce(output, '') AS output, trim(coalesce(product_id, ''), E' \\t\\r\\n') AS p, trim(coalesce(version, ''), E' \\t\\r\\n') AS v FROM r),
k AS (SELECT *, trim(output, E' \\t\\r\\n') AS o, list_distinct(regexp_extract_all(output, '[A-Za-z0-9가-힣]{{2,}}')) AS tk, list_distinct(regexp_extract_all(canonical, '[A-Za-z0-9가-힣]{{2,}}')) AS ck, list_distinct(regexp_extract_all(summary, '[A-Za-z0-9가-힣]{{2,}}')) AS sk, list_distinct(regexp_extract_all(operational, '[A-Za-z0-9가-힣]{{2,}}')) AS pk, list_filter(regexp_extract_all(output, '[A-Za-z0-9가-힣]+'), lambda x: length(x) >= 2) AS w, trim(instruction, E' \\t\\r\\n') <> '' AS hi, trim(output, E' \\t\\r\\n') <> '' AS ho, trim(canonical, E' \\t\\r\\n') <> '' AS hc FROM n),
c AS (SELECT id, list_filter([CASE WHEN NOT hi THEN 'fail:schema.instruction' END, CASE WHEN NOT ho THEN 'fail:schema.output' END, CASE WHEN NOT hc THEN 'fail:schema.canonical' END, CASE WHEN p = '' THEN 'warn:meta.product_id' END, CASE WHEN v = '' THEN 'warn:meta.version' END, CASE WHEN {LEAKED} THEN 'fail:quality.reasoning_leak' END,
  CASE WHEN length(o) BETWEEN 1 AND 19 THEN 'warn:quality.too_short' END, CASE WHEN length(o) > 1200 THEN 'warn:quality.too_long' END,
  CASE WHEN hc AND len(tk) > 0 AND len(list_intersect(tk, ck)) / len(tk) < 0.18 AND (len(list_intersect(tk, sk)) / len(tk) > 0.25 OR len(list_intersect(tk, pk)) / len(tk) > 0.25) THEN 'warn:grounding.summary_operational_dominant' END,
  CASE WHEN hc AND ho AND len(w) >= 8 AND len(list_filter(range(0, greatest(least(len(w) - 3, 40) - 1, 0) + 1, 3), lambda i: contains(canonical, array_to_string(w[i + 1 : i + 4], ' ')))) = 0 THEN 'warn:grounding.weak' END,
  CASE WHEN {GENERAL} THEN 'warn:tone.generic' END, CASE WHEN {SURE} THEN 'warn:tone.certain' END], lambda x: x IS NOT NULL) AS codes FROM k)
SELECT id, array_to_string(codes, ',') AS codes, len(list_filter(codes, lambda x: x LIKE 'fail:%')) = 0 AS ok FROM c"""
OUTPUTS = """WITH r AS (SELECT doc_id AS id, CASE WHEN doc_id % 9 < 8 THEN 'what of ' || source END AS instruction, CASE WHEN doc_id % 7 < 6 THEN d.text END AS canonical, b.text AS summary, CASE WHEN doc_id % 2 = 0 THEN b.text || ' more' ELSE source END AS operational,
  CASE doc_id % 6 WHEN 0 THEN b.text WHEN 1 THEN left(d.text, 400) WHEN 2 THEN 'go step by step. ' || b.text WHEN 3 THEN 'a few words' WHEN 4 THEN '보통 항상 그렇다, ' || left(d.text, 90) ELSE ' ' END AS output, CASE WHEN doc_id % 5 > 0 THEN source END AS product_id, CASE WHEN doc_id % 4 > 0 THEN '202401' ELSE ' ' END AS version FROM documents d JOIN benchmark b ON item_id = doc_id % 40)"""


@query(OUTPUTS + FINDINGS)
def distilled_outputs(spark, d):
    """Benchmark passages and parts of documents as outputs that documents are to support."""
    docs, b = table(spark, d, "documents"), table(spark, d, "benchmark").select("item_id", F.col("text").alias("b"))
    k = F.col("doc_id")
    output = F.when(k % 6 == 0, F.col("b")).when(k % 6 == 1, F.left("text", F.lit(400))).when(k % 6 == 2, F.concat(F.lit("go step by step. "), "b")).when(k % 6 == 3, "a few words").when(k % 6 == 4, F.concat(F.lit("보통 항상 그렇다, "), F.left("text", F.lit(90)))).otherwise(" ")
    r = docs.join(b, k % 40 == F.col("item_id")).select(
        k.alias("id"), F.when(k % 9 < 8, F.concat(F.lit("what of "), "source")).alias("instruction"), F.when(k % 7 < 6, F.col("text")).alias("canonical"), F.col("b").alias("summary"), F.when(k % 2 == 0, F.concat("b", F.lit(" more"))).otherwise(F.col("source")).alias("operational"),
        output.alias("output"), F.when(k % 5 > 0, F.col("source")).alias("product_id"), F.when(k % 4 > 0, "202401").otherwise(" ").alias("version"),
    )
    return answers.findings(r).select("id", F.array_join("codes", ",").alias("codes"), "ok")


@query("WITH r AS (SELECT doc_id AS id, text AS instruction, text AS canonical, text AS output, '' AS summary, '' AS operational, source AS product_id, '202401' AS version FROM documents)" + FINDINGS)
def distill_findings(spark, d):
    whole = [F.col("text").alias(c) for c in ("instruction", "canonical", "output")]
    r = texts(spark, d).select("id", *whole, F.lit("").alias("summary"), F.lit("").alias("operational"), F.col("source").alias("product_id"), F.lit("202401").alias("version"))
    return answers.findings(r).select("id", F.array_join("codes", ",").alias("codes"), "ok")


SCOPES = "SELECT l_orderkey AS doc_id, l_linestatus AS question, CAST(l_linenumber AS INTEGER) AS ord, CASE l_returnflag WHEN 'A' THEN 'not_covered' WHEN 'R' THEN 'conditional' ELSE 'covered' END AS decision, CAST(l_partkey % 3 AS INTEGER) AS n_evidence, l_suppkey % 2 = 0 AS exclusions_checked, CAST(l_partkey % 2 AS BIGINT) AS n_exclusions, l_discount * 10 AS confidence FROM lineitem"


@query(f"WITH s AS ({SCOPES}), u AS (SELECT *, decision = 'covered' AND NOT exclusions_checked AS unchecked, CASE WHEN n_evidence > 0 THEN confidence ELSE least(confidence, 0.55) END AS c FROM s), n AS (SELECT doc_id, question, ord, n_evidence, n_exclusions, CASE WHEN unchecked THEN 'conditional' ELSE decision END AS decision, greatest(0, least(1, CASE WHEN unchecked THEN least(c, 0.7) ELSE c END)) AS confidence FROM u), r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, question ORDER BY CASE decision WHEN 'not_covered' THEN 3 WHEN 'conditional' THEN 2 WHEN 'covered' THEN 1 ELSE 0 END DESC, confidence DESC, ord) AS k FROM n) SELECT doc_id, question, max(decision) FILTER (k = 1) AS final_decision, round(max(confidence) FILTER (k = 1), 6) AS confidence, count(*) FILTER (n_evidence = 0) AS n_warnings, bool_or(decision = 'covered') AND bool_or(decision = 'not_covered') AS conflict, CAST(sum(n_exclusions) AS BIGINT) AS n_exclusions FROM r GROUP BY ALL")
def merged_answers(spark, d):
    decision = F.when(F.col("l_returnflag") == "A", "not_covered").when(F.col("l_returnflag") == "R", "conditional").otherwise("covered")
    s = table(spark, d, "lineitem").select(F.col("l_orderkey").alias("doc_id"), F.col("l_linestatus").alias("question"), F.col("l_linenumber").alias("ord"), decision.alias("decision"), (F.col("l_partkey") % 3).cast("int").alias("n_evidence"), (F.col("l_suppkey") % 2 == 0).alias("exclusions_checked"), (F.col("l_partkey") % 2).alias("n_exclusions"), (F.col("l_discount") * 10).alias("confidence"))
    return answers.merge(s).withColumn("confidence", F.round("confidence", 6))


# the ledger
STATE = ", s AS (SELECT *, row_number() OVER (PARTITION BY key ORDER BY ts DESC, event_id DESC) AS r FROM work), c AS (SELECT key, CASE event WHEN 'start' THEN 'processing' WHEN 'fail' THEN 'failed' ELSE event END AS state, ts FROM s WHERE r = 1)"


@query(WORK + STATE + " SELECT key, state, ts FROM c")
def queue_state(spark, d):
    return ledger.current_state(work(spark, d))


@query(WORK + ", s AS (SELECT *, max(CASE WHEN event = 'done' THEN (ts, event_id) END) OVER (PARTITION BY key) AS last FROM work) SELECT key, count(*) AS failures, count(*) >= 3 AS dead FROM s WHERE event = 'fail' AND (last IS NULL OR (ts, event_id) > last) GROUP BY key")
def retry_counts(spark, d):
    return ledger.retries(work(spark, d))


@query(WORK + STATE + " SELECT key, ts FROM c WHERE state = 'processing' AND epoch(TIMESTAMP '2030-01-01 00:00:00') - floor(epoch(ts)) > 900")
def stale_work(spark, d):
    return ledger.stale(work(spark, d), "2030-01-01 00:00:00")


@query(WORK + STATE + " SELECT DISTINCT c_custkey AS key FROM customer WHERE c_custkey NOT IN (SELECT key FROM c WHERE state <> 'failed')")
def pending_work(spark, d):
    return ledger.pending(table(spark, d, "customer").select(F.col("c_custkey").alias("key")).distinct(), work(spark, d))


@query(WORK + ", l AS (SELECT * FROM work WHERE event IN ('done', 'fail') AND elapsed IS NOT NULL ORDER BY ts DESC, event_id DESC LIMIT 1000), o AS (SELECT *, row_number() OVER (ORDER BY elapsed) - 1 AS r, count(*) OVER () AS n FROM l) SELECT count(*) AS n, round(avg(elapsed), 6) AS avg_s, max(elapsed) FILTER (r = least(floor(0.95 * n), n - 1)) AS p95_s, min(elapsed) AS min_s, max(elapsed) AS max_s, round(100.0 * count(*) FILTER (event = 'fail') / count(*), 6) AS fail_percent FROM o")
def latency_summary(spark, d):
    return ledger.latency(work(spark, d))


@query(WORK + ", f AS (SELECT error, count(*) AS n FROM work WHERE event = 'fail' GROUP BY error) SELECT error, n, round(100.0 * n / (SELECT sum(n) FROM f), 6) AS percent FROM f")
def error_counts(spark, d):
    return ledger.errors(work(spark, d))


@query(WORK + ", l AS (SELECT * FROM work ORDER BY ts DESC, event_id DESC LIMIT 1000), s AS (SELECT event, count(*) / 1000 AS share FROM l GROUP BY event), e AS (SELECT * FROM (VALUES ('done', 0.6), ('fail', 0.05), ('queued', 0.1), ('start', 0.2)) v(event, expected)) SELECT e.event, CAST(expected AS DOUBLE) AS expected, round(coalesce(share, 0), 6) AS share, CASE WHEN abs(coalesce(share, 0) - expected) > 0.4 THEN 'critical' ELSE 'warning' END AS level FROM e LEFT JOIN s USING (event) WHERE abs(coalesce(share, 0) - CAST(expected AS DOUBLE)) > 0.2")
def distribution_anomalies(spark, d):
    return ledger.anomalies(ledger.distribution(work(spark, d)), {"done": 0.6, "fail": 0.05, "queued": 0.1, "start": 0.2})


@query(WORK + " SELECT time_bucket(INTERVAL 1 HOUR, ts) AS window_start, event, count(*) AS n, round(sum(elapsed), 4) AS total FROM work GROUP BY ALL")
def hourly_windows(spark, d):
    return ledger.per_window(work(spark, d).withColumnRenamed("elapsed", "value"))


@query(WORK + ", g AS (SELECT key, ts, CASE WHEN ts - lag(ts) OVER w < INTERVAL 30 MINUTE THEN 0 ELSE 1 END AS new FROM work WINDOW w AS (PARTITION BY key ORDER BY ts)), s AS (SELECT key, ts, sum(new) OVER (PARTITION BY key ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM g) SELECT key, min(ts) AS session_start, count(*) AS n FROM s GROUP BY key, s")
def user_sessions(spark, d):
    return ledger.sessions(work(spark, d))


from quern.plans import derived_queries, mechanism_queries, surface_queries  # noqa: E402, F401

QUERIES |= derived_queries.QUERIES
ORACLE_SQL |= derived_queries.ORACLE_SQL
