"""Operators that keep state, order whole tables, join by place, scan by rules, repair, index and sum, against brute force."""

import collections
import json
import random

import pytest
from pyspark.sql import functions as F

from quern.functions import encoding, sql
from quern.operators import clause_headers, ordered, rule_classifier, spatial, table_chunks, tables, vector_index
from quern.streaming import keyed_state, run_metrics


def plan(df):
    return df._jdf.queryExecution().toString()


# keyed state
LEDGER = "event_id long, key long, ts timestamp, event string"


def ledger(spark, rows):
    return spark.createDataFrame(rows, "event_id long, key long, t string, event string").select("event_id", "key", F.col("t").cast("timestamp").alias("ts"), "event")


def test_retries_and_mixes_go_on_after_a_restart(spark, tmp_path):
    r = random.Random(1)
    rows = [(i, r.choice([1, 2, None]), f"2024-01-01 {i // 60:02d}:{i % 60:02d}:00", r.choice(["fail", "fail", "done", "start", None])) for i in range(200)]
    out = {}
    for part in range(3):
        now = [x for x in rows if x[0] * 3 // 200 == part]
        r.shuffle(now)
        ledger(spark, now).repartition(2).write.mode("append").parquet(f"{tmp_path}/in")
        for name, of in (("retry", keyed_state.retry_actions), ("mix", lambda s: keyed_state.last_mix(s, 7))):
            keyed_state.run_once(of(spark.readStream.schema(LEDGER).parquet(f"{tmp_path}/in")), f"{tmp_path}/{name}", f"{tmp_path}/{name}-state")
            out[name] = spark.read.parquet(f"{tmp_path}/{name}").collect()
    retries, mix, n, last = set(), set(), collections.Counter(), collections.defaultdict(lambda: collections.deque(maxlen=7))
    for i, key, _, event in rows:
        if key is None or event is None:
            continue
        n[key] = 0 if event == "done" else n[key] + (event == "fail")
        if event == "fail":
            retries.add((key, i, n[key], "retry" if n[key] < 3 else "failed"))
        last[key].append(event)
        mix.add((key, i, event, last[key].count(event), len(last[key])))
    assert sorted((x.key, x.event_id, x.failures, x.action) for x in out["retry"]) == sorted(retries)
    assert sorted((x.key, x.event_id, x.event, x.n_same, x.n_held) for x in out["mix"]) == sorted(mix)
    keyed_state.run_once(keyed_state.retry_actions(spark.readStream.schema(LEDGER).parquet(f"{tmp_path}/in")), f"{tmp_path}/retry", f"{tmp_path}/retry-state")
    assert spark.read.parquet(f"{tmp_path}/retry").count() == len(retries)  # nothing new


# frames over a whole table
@pytest.mark.parametrize("block", [3, 10, 1000])
def test_rolling_counts_at_every_event(spark, block):
    r = random.Random(2)
    rows = [(i, 1, f"2024-01-01 00:{r.choice([0, 0, 0, i % 60]):02d}:00", r.choice(["a", "b", None])) for i in range(90)]
    d = ledger(spark, rows).repartition(4)
    got = {x.event_id: (x.n_frame, x.counts) for x in ordered.rolling_counts(d, ["a", "b"], 5, block=block).collect()}
    order = sorted(rows, key=lambda x: (x[2], x[0]))
    for k, x in enumerate(order):
        frame = [y[3] for y in order[max(0, k - 4) : k + 1]]
        assert got[x[0]] == (len(frame), [frame.count("a"), frame.count("b")])
    alerts = {x.event_id: (x.kind, x.level) for x in ordered.rolling_alerts(d, {"b": 0.5, "a": 0.5}, 5, block=block).collect()}
    for i, (n, (a, b)) in got.items():
        off = [(k, abs(c / n - 0.5)) for k, c in (("b", b), ("a", a)) if abs(c / n - 0.5) > 0.2]
        assert alerts.get(i) == ((off[0][0], "critical" if off[0][1] > 0.4 else "warning") if off else None)
    assert ordered.rolling_counts(d.limit(0), ["a"], 5).count() == 0


def test_no_window_over_a_whole_table_in_one_task(spark):
    d = ledger(spark, [(1, 1, "2024-01-01 00:00:00", "a")])
    assert "SinglePartition" not in plan(ordered.rolling_shares(d, ["a", "b"]))


# joins by place
def overlap(a, b):
    i = max(0.0, min(a[2], b[2]) - max(a[0], b[0])) * max(0.0, min(a[3], b[3]) - max(a[1], b[1]))
    area = lambda x: (x[2] - x[0]) * (x[3] - x[1])
    return i / (area(a) + area(b) - i) if i else 0.0


def random_boxes(seed, n):
    r = random.Random(seed)
    out = []
    for k in range(n):
        size = r.choice([3, 20, 20, 90, 700, 5000])
        x, y = r.choice([-40.0, 0.0, 32.0, r.uniform(-100, 400)]), r.choice([0.0, 64.0, r.uniform(-100, 400)])
        out.append((1, r.choice([1, 1, 1, 2]), k, [x, y, x + size * r.uniform(0.5, 1), y + size * r.uniform(0.5, 1)]))
    return out


BOX = "id int, page int, {} int, bbox array<double>"
ODD = [(1, 1, 900, None), (1, 1, 901, [1.0, 2.0]), (1, 1, 902, [5.0, 5.0, 5.0, 9.0]), (1, 1, 903, [0.0, 0.0, float("nan"), 5.0]), (1, 1, 904, [9.0, 9.0, 1.0, 1.0])]


def test_overlaps_find_every_pair_once(spark):
    a, b = random_boxes(1, 80), random_boxes(2, 80)
    left = spark.createDataFrame(a + ODD, BOX.format("cell")).withColumnRenamed("bbox", "box_a")
    right = spark.createDataFrame(b + ODD, BOX.format("ord")).withColumnRenamed("bbox", "box_b")
    found = spatial.overlaps(left, right, ["id", "page"])
    assert "NestedLoop" not in plan(found) and "Cartesian" not in plan(found)
    expected = collections.Counter((x[2], y[2]) for x in a for y in b if x[1] == y[1] and overlap(x[3], y[3]) > 0)
    assert collections.Counter((r.cell, r.ord) for r in found.collect()) == expected and len(expected) > 300


@pytest.mark.parametrize("seed", [3, 4, 5])
def test_matching_is_what_choosing_in_turn_gives(spark, seed):
    a, b = random_boxes(seed, 70), random_boxes(seed, 70)  # equal boxes in both
    b = [(i, p, k, [x + (k % 3), *rest]) for i, p, k, (x, *rest) in b] + [(1, 1, 500 + k, a[k][3]) for k in range(10)]
    a += [(1, 1, 300 + k, a[0][3]) for k in range(5)]  # many cells that want one line
    cells, lines = spark.createDataFrame(a + ODD, BOX.format("cell")), spark.createDataFrame(b, BOX.format("ord"))
    taken, turn, best = set(), {}, {}
    for _, page, cell, box in sorted(a, key=lambda x: x[2]):
        wish = sorted(((-overlap(box, y[3]), y[2]) for y in b if y[1] == page and overlap(box, y[3]) >= 0.3))
        best[cell] = wish[0][1] if wish else None
        free = [o for _, o in wish if (page, o) not in taken]
        if free:
            taken.add((page, free[0]))
            turn[cell] = free[0]
    assert {r.cell: r.ord for r in spatial.exclusive_match(cells, lines).collect()} == turn
    assert {r.cell: r.ord for r in spatial.best_match(cells, lines).collect()} == best | {x[2]: None for x in ODD}
    assert spatial.exclusive_match(cells.limit(0), lines).count() == 0


def test_points_outside_areas(spark):
    r = random.Random(7)
    points = [(1, r.choice([1, 2]), r.choice([32.0, 64.0, r.uniform(-50, 300)]), r.choice([0.0, 64.0, r.uniform(-50, 300)])) for _ in range(200)]
    areas = [(i, p, *box) for i, p, _, box in random_boxes(8, 12) if box[2] - box[0] < 200]
    p = spark.createDataFrame(points, "id int, page int, x double, y double")
    t = spark.createDataFrame(areas, "id int, page int, x_min double, y_min double, x_max double, y_max double")
    left = spatial.outside_boxes(p, t)
    assert "NestedLoop" not in plan(left)
    expected = collections.Counter(x for x in points if not any(a[1] == x[1] and a[2] <= x[2] <= a[4] and a[3] <= x[3] <= a[5] for a in areas))
    assert collections.Counter(map(tuple, left.collect())) == expected and 0 < sum(expected.values()) < 200
    assert spatial.outside_boxes(p, t.limit(0)).count() == 200


# rules
RULES = [("A", "keyword", "TV", 2), ("B", "keyword", "TV shop", 1), ("A", "exclude", "TV license", 2), ("A", "filename", r"\(A\)", 2), ("C", "keyword", "x.y\\E|", 3), ("B", "filename", "b-", 1)]


def test_rules_by_place_and_strategy(spark):
    rules = rule_classifier.compiled(spark.createDataFrame(RULES, "channel string, kind string, word string, priority int"))
    fill = "." * 1000
    docs = [
        (1, ["", None, " it is B "], None, "nothing"), (2, None, "file (A).pdf", fill + "TV shop" + fill), (3, None, None, "TV shop"), (4, None, None, fill + fill + "TV"), (5, None, None, "TV license TV shop"),
        (6, None, None, None), (7, None, None, "a x.y\\E| b"), (8, None, "b-(A)", fill + "x.y\\E|" + fill), (9, ["ABC"], "b-", ""), (10, None, None, "T" * 999 + "TV"), (11, None, None, "." * 1100 + "TV"),
    ]
    d = spark.createDataFrame([(*x, "own") for x in docs], "id int, metadata array<string>, file_name string, text string, candidates_ string")
    got = {r.id: (r.channel, r.confidence, r.source, r.mixed, r.candidates) for r in rule_classifier.classify(d, rules).collect()}
    assert got[1] == ("B", 1.0, "metadata", False, ["B"])
    assert got[2] == ("A", 0.95, "filename", True, ["A", "B"])  # TV shop begins with TV
    assert got[3] == ("B", 0.9, "header", True, ["B", "A"])
    assert got[4] == ("A", 0.6, "footer", False, ["A"])
    assert got[5] == ("B", 0.9, "header", False, ["B"])
    assert got[6] == ("일반", 0.0, "none", False, [])
    assert got[7][:3] == ("C", 0.9, "header")
    assert got[8] == ("B", 0.95, "filename", True, ["B", "A", "C"])
    assert got[9] == ("B", 1.0, "metadata", False, ["B"])
    assert got[10] == ("A", 0.6, "footer", False, ["A"])  # the word lies across the end of the header
    assert got[11][2] == "footer"
    by_priority = {r.id: (r.channel, r.confidence, r.source) for r in rule_classifier.classify(d, rules, "priority").collect()}
    assert by_priority[2] == ("B", 0.95, "filename")
    with pytest.raises(ValueError, match="strategy"):
        rule_classifier.classify(d, rules, "other")
    none = rule_classifier.compiled(spark.createDataFrame([], "channel string, kind string, word string, priority int"))
    assert {r.channel for r in rule_classifier.classify(d, none).collect()} == {"일반"}


def test_too_many_rules_are_refused(spark, monkeypatch):
    monkeypatch.setattr(rule_classifier, "MOST_RULES", 3)
    with pytest.raises(ValueError, match="more than 3"):
        rule_classifier.compiled(spark.createDataFrame(RULES, "channel string, kind string, word string, priority int"))


# encodings
def test_repair_of_wrongly_decoded_texts(spark):
    wrong = lambda t, name: t.encode().decode(name)
    cases = [
        ("plain", "plain", "valid"), (None, None, "valid"), (wrong("über – naïve", "cp1252"), "über – naïve", "fixed"), (wrong("암 보험", "latin1"), "암 보험", "fixed"),
        ("été", "été", "fixed"), ("í stays", "í stays", "unfixable"), (wrong("él vive aquí", "latin1"), wrong("él vive aquí", "latin1"), "unfixable"), ("한글 텍스트", "한글 텍스트", "valid"), ("a�b", "a�b", "unfixable"),
    ]
    d = spark.createDataFrame([(i, t, "own") for i, (t, _, _) in enumerate(cases)], "id int, text string, encoding_ string")
    rows = {r.id: (r.text, r.encoding) for r in encoding.repair(d).collect()}
    assert rows == {i: (t, s) for i, (_, t, s) in enumerate(cases)}
    assert {r.encoding: r.n for r in encoding.repair_counts(encoding.repair(d)).collect()} == {"valid": 3, "fixed": 3, "unfixable": 3}
    assert encoding.repair(d.limit(0)).count() == 0


# table rows with their clause
def test_table_rows_take_the_clause_in_force(spark):
    text = "\n".join(["제1조 처음", "담보 명칭 항목  가입 금액 항목", "암 진단 담보  천만원 지급", "제2조 다음", "본문", "보장 명칭 항목  가입 금액 항목", "골절 진단 담보  백만원 지급", "제3조 끝"])
    d = spark.createDataFrame([(1, text), (2, "no table"), (3, None)], "id int, text string")
    assert tables.gate(tables.detect(d.filter("id = 1")).withColumn("reliability", tables.reliability(F.col("text")))).filter("passed").count() == 2
    rows = lambda **k: {r.table_no: (r.text, r.clause_title, r.heading_path) for r in table_chunks.table_row_chunks(d, **k).collect()}
    at_end, in_place = rows(), rows(in_place=True)
    assert at_end[0] == ("담보 명칭 항목: 암 진단 담보 | 가입 금액 항목: 천만원 지급", "제3조 끝", ["제3조 끝"]) and at_end[1][1] == "제3조 끝"
    assert [in_place[i][1] for i in (0, 1)] == ["제1조 처음", "제2조 다음"]
    titles = spark.createDataFrame([(1, 0, "별표 1 지급표"), (1, 1, "표")], "id int, table_no int, title string")
    assert [rows(in_place=True, titles=titles)[i][1] for i in (0, 1)] == ["별표 1 지급표", "제2조 다음"]


# an index
def test_the_index_covers_all_rows_and_recalls(spark, tmp_path):
    v = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    odd = spark.createDataFrame([(-1, None, None), (-2, [], 3)], "vec_id long, embedding array<float>, label int")
    vector_index.build(v.unionByName(odd), f"{tmp_path}/index")
    index = vector_index.load(spark, f"{tmp_path}/index")
    assert index.lists.count() == v.count() == sum(index.sizes) and len(index.centroids) == 44
    q = v.filter("vec_id % 20 = 0").select(F.col("vec_id").alias("query_id"), "embedding")
    exact = vector_index.search(index, q, share=1.0)
    found = vector_index.search(index, q)
    assert found.groupBy("query_id").count().filter("count = 3").count() == q.count()
    assert vector_index.recall(found, exact) >= 0.9
    from quern.operators import retrieval

    assert {(r.query_id, r.rank, r.vec_id) for r in exact.collect()} == {(r.query_id, r.rank, r.vec_id) for r in retrieval.search(v, q).collect()}


def test_a_hot_list_is_searched_in_blocks(spark, tmp_path, monkeypatch):
    rows = [(i, [1.0, i / 1000.0], "own") for i in range(300)] + [(1000 + i, [1.0, 0.5], "copy") for i in range(100)]
    v = spark.createDataFrame(rows, "vec_id long, embedding array<double>, note string")
    vector_index.build(v, f"{tmp_path}/index", 2)
    index = vector_index.load(spark, f"{tmp_path}/index")
    q = v.filter("vec_id < 40").select(F.col("vec_id").alias("query_id"), "embedding")
    whole = sorted(map(tuple, vector_index.search(index, q, share=1.0).collect()))
    monkeypatch.setattr(vector_index, "VECTOR_BLOCK", 16)
    monkeypatch.setattr(vector_index, "QUERY_BLOCK", 8)
    assert sorted(map(tuple, vector_index.search(index, q, share=1.0).collect())) == whole and len(whole) == 120
    vector_index.build(v.limit(0), f"{tmp_path}/empty")
    assert vector_index.search(vector_index.load(spark, f"{tmp_path}/empty"), q).count() == 0
    assert vector_index.search(index, q.limit(0)).count() == 0


# metrics
def test_metrics_by_grouping_sets(spark):
    f = spark.createDataFrame([("memory", "p", ".pdf"), ("memory", "q", None), ("corrupted", "p", ".pdf"), ("corrupted", None, ".hwp")], "error string, parser string, extension string")
    m = run_metrics.failures(f)
    assert {(r.dimension, r.value): (r.n, r.percent) for r in m.collect()} == {
        ("all", ""): (4, 100.0), ("error", "memory"): (2, 50.0), ("error", "corrupted"): (2, 50.0), ("parser", "p"): (2, 50.0), ("parser", "q"): (1, 25.0), ("parser", "unknown"): (1, 25.0),
        ("extension", ".pdf"): (2, 50.0), ("extension", ".hwp"): (1, 25.0), ("extension", "unknown"): (1, 25.0),
    }
    assert plan(m).count("Expand") and run_metrics.failures(f.limit(0)).filter("n > 0").count() == 0
    r = spark.createDataFrame([("success", None, "p", 2.0), ("error", "timeout", "p", 3.0), ("error", "crash", "q", None), (None, None, "q", 1.0), ("skipped", None, "q", None)], "status string, reason string, parser string, seconds double")
    by = {(x.dimension, x.value): x.asDict() for x in run_metrics.runs(r).collect()}
    assert [by["all", ""][c] for c in ("total", "success", "skipped", "errors", "timeout", "crash", "success_percent", "failure_percent", "seconds", "per_minute")] == [5, 1, 1, 3, 1, 1, 25.0, 75.0, 6.0, 10.0]
    assert by["parser", "p"]["share"] == 40.0
    assert {x.advice for x in run_metrics.advice(run_metrics.runs(r), m).collect()} == {"High failure rate (75.0%) - investigate primary parser issues", "High corrupted PDF rate - implement pre-validation"}


# SQL
CLAUSES = ["머리말", "암 진단 특약", "제1조(목적)", "## 제2조", "본문", "- 3 -", "골절 담보", "제1조", "담보", "【 별표 1 】 표", "제9조", "부 칙", "끝"]


def test_segments_from_sql_and_columns(spark):
    rows = [(1, i, t) for i, t in enumerate(CLAUSES)] + [(2, 0, "제1조"), (2, 1, "x")]
    lines = spark.createDataFrame(rows, "id long, line_no int, line string").repartition(3)
    native = clause_headers.simple_segments(lines)
    got = sorted((r.id, r.segment, r.kind, r.title, r.start_line, r.end_line, r.n_articles) for r in native.collect())
    assert got == [
        (1, 1, "special_clause", "암 진단 특약", 1, 5, 2), (1, 2, "coverage", "골절 담보", 6, 8, 1), (1, 3, "appendix", "【 별표 1 】 표", 9, 10, 0), (1, 4, "addendum", "부 칙", 11, 12, 0), (2, 1, "document", "전체문서", 0, 1, 1),
    ]
    sql.register(spark)
    out = spark.sql("SELECT * FROM clause_segments(TABLE({l}) PARTITION BY id ORDER BY (line_no))", l=lines).collect()
    assert sorted(map(tuple, out)) == got
    long = spark.createDataFrame([(1, i, "암 특약" if i == 0 else "x" * 600) for i in range(3)], "id long, line_no int, line string")
    assert clause_headers.segment_warnings(clause_headers.simple_segments(long), 1000).first().warnings == ["too_long", "no_articles"]


def test_scalars_from_sql_stay_in_the_plan(spark):
    sql.register(spark)
    df = spark.sql("SELECT squash('  a \t b '), n_words('é 1_b, c'), file_suffix('/x/a.b.PDF'), file_suffix('.hid'), special_share('a!'), routed(0.5D, 0.6D, 0.4D), squash(NULL)")
    assert "Python" not in plan(df)
    assert tuple(df.first()) == ("a b", 3, ".pdf", "", 0.5, "review", None)
    assert json.dumps([df.count()]) == "[1]"


# deduplication
EXAMPLE = "ord long, instruction string, input string, output string, source string"


def test_copies_are_classes_not_pairs(spark):
    from quern.operators import dedup

    near = ["one two three four five six seven eight nine ten", "one two three four five six seven eight nine tenth", "wholly other words stand in this one text here now"]
    e = spark.range(100_000).select("id", F.element_at(F.array(*map(F.lit, near)), (F.when(F.col("id") % 1000 == 1, 2).when(F.col("id") % 1000 == 2, 3).otherwise(1)).cast("int")).alias("output"))
    e = e.select(F.col("id").alias("ord"), F.lit("").alias("instruction"), F.lit("").alias("input"), "output", F.lit("s").alias("source"))
    pairs = dedup.structural_pairs(e)
    assert [(r.a, r.b) for r in pairs.collect()] == [(0, 1)]
    assert {r["class"] for r in dedup.structural_classes(e).select("class").distinct().collect()} == {0, 1, 2}
    assert sorted(r.ord for r in dedup.structural(e).collect()) == [0, 2]
    assert sorted(r.ord for r in dedup.semantic(e).collect()) in ([0, 2], [0, 1, 2])
    assert [r["class"] for r in dedup.semantic_classes(e).groupBy("class").count().filter("count > 99000").collect()] == [0]


@pytest.mark.parametrize("block", [2, 7, 1000])
def test_keys_in_blocks_lose_no_pair(spark, block):
    from quern.operators import dedup

    r = random.Random(5)
    rows = sorted({(r.randrange(60), r.choice("aaaab")) for _ in range(150)})
    n = collections.Counter(k for _, k in rows)
    d = spark.createDataFrame([(o, k, n[k]) for o, k in rows], "ord long, k string, df long")
    expected = {(x, y) for x, k in rows for y, m in rows if k == m and x < y}
    found = [tuple(x) for x in dedup.meeting(d, ["k"], "df", block).collect()]
    assert set(found) == expected and len(found) == len(expected)


def test_semantic_keep_first_against_the_sequence(spark):
    from quern.operators import dedup

    r = random.Random(6)
    vocabulary = [f"w{i}" for i in range(40)]
    texts = [" ".join(r.choices(vocabulary[: 8 + i % 20], k=12)) for i in range(40)]
    texts += [" ".join(r.sample(t.split(), 12)) for t in texts[:10]] + ["", "", "!"]
    order = list(range(len(texts)))
    r.shuffle(order)
    e = spark.createDataFrame([(o, "", None, t, "s") for o, t in zip(order, texts, strict=True)], EXAMPLE)
    by = dict(zip(order, texts, strict=True))
    words = {o: collections.Counter(t.split()) if t != "!" else collections.Counter() for o, t in by.items()}
    df = collections.Counter(w for c in words.values() for w in c)
    vector = {o: {w: k / sum(c.values()) * len(by) / (df[w] + 1) for w, k in c.items()} for o, c in words.items()}
    norm = {o: sum(x * x for x in v.values()) ** 0.5 for o, v in vector.items()}
    cosine = lambda a, b: sum(x * vector[b].get(w, 0) for w, x in vector[a].items()) / (norm[a] * norm[b]) if norm[a] and norm[b] else 0
    kept = []
    for o in sorted(by):
        if not any(cosine(k, o) >= 0.6 for k in kept):
            kept.append(o)
    assert sorted(x.ord for x in dedup.semantic(e, 0.6).collect()) == kept and len(kept) < len(texts)


def test_structural_pairs_are_made_once_and_not_shuffled_as_candidates(spark):
    import random

    from quern.operators import dedup

    r = random.Random(3)
    rows = [(i, "", "", " ".join(r.sample([f"w{k}" for k in range(14)], 10)), "s") for i in range(150)]
    found = dedup.structural_pairs(spark.createDataFrame(rows, "ord long, instruction string, input string, output string, source string"))
    pairs = [(x.a, x.b) for x in found.collect()]
    assert len(pairs) == len(set(pairs)) > 100
    w = {i: set(t.split()) for i, _, _, t, _ in rows}
    n = {i: len(t) for i, _, _, t, _ in rows}
    expected = set()
    first = {}
    for i in w:
        first.setdefault((n[i], tuple(sorted(w[i]))), i)
    for a in first.values():
        for b in first.values():
            if a < b and (0.9 + 0.1 * (1 - abs(n[a] - n[b]) / max(n[a], n[b])) - 0.1 + 0.3 * len(w[a] & w[b]) / len(w[a] | w[b])) / 1.2 >= 0.85 - 1e-12:
                expected.add((a, b))
    assert set(pairs) == expected
    # pairs come out of the join of the blocks: nothing is exchanged after it
    plan = found._jdf.queryExecution().optimizedPlan().toString().split("Join")[0]
    assert "Aggregate" not in plan


def test_semantic_pairs_whatever_words_are_sent_and_without_shuffling_texts(spark, monkeypatch):
    from quern.operators import dedup

    r = random.Random(8)
    texts = [" ".join(r.choices([f"w{i}" for i in range(60)], k=15)) + f" own{k}" * (k % 3) for k in range(80)]
    texts += [t + " w1" for t in texts[:20]] + texts[:5] + ["", None]
    e = spark.createDataFrame([(o, "", None, t, "s") for o, t in enumerate(texts)], EXAMPLE)
    words = {o: collections.Counter((t or "").split()) for o, t in enumerate(texts)}
    df = collections.Counter(w for c in words.values() for w in c)
    vector = {o: {w: k / sum(c.values()) * len(texts) / (df[w] + 1) for w, k in c.items()} for o, c in words.items() if c}
    norm = {o: sum(x * x for x in v.values()) ** 0.5 for o, v in vector.items()}
    first = {}
    for o, c in words.items():
        first.setdefault(tuple(sorted(c.items())), o)
    firsts = sorted(o for o in first.values() if o in vector)
    expected = {(a, b): round(c, 6) for a in firsts for b in firsts if a < b and (c := sum(x * vector[b].get(w, 0) for w, x in vector[a].items()) / norm[a] / norm[b]) >= 0.7}
    assert len(expected) > 10
    for most in (0, 30, 1000):
        monkeypatch.setattr(dedup, "COMMON_WORDS", most)
        assert {(x.a, x.b): round(x.similarity, 6) for x in dedup.semantic_pairs(e, 0.7).collect()} == expected, most
    # texts that are like none leave few rows behind: no table of all their words
    written = []
    real = dedup.stored
    monkeypatch.setattr(dedup, "stored", lambda d, name: written.append(x := real(d, name)) or x)
    long = spark.createDataFrame([(o, "", "", " ".join(f"w{r.randrange(300)}" for _ in range(200)) + f" own{o} own{o}", "s") for o in range(60)], EXAMPLE)
    assert dedup.semantic_pairs(long).count() == 0
    assert sum(x.count() for x in written) < 1000


def test_a_search_keeps_the_best_in_small_blocks():
    import numpy as np
    import pyarrow as pa

    from quern.operators import retrieval

    g = np.random.default_rng(4)
    q, v = g.normal(size=(37, 5)), g.normal(size=(211, 5))
    v[100:150] = v[7]  # equal vectors: the smaller id first, wherever they stand
    ids = g.permutation(1000)[:211]
    best = retrieval.Best(37, 4, (8, 16))
    for i in range(0, 211, 50):
        best.add(np.arange(37), q, ids[i : i + 50], v[i : i + 50])
    found = best.batch(np.arange(37)).to_pylist()
    scores = np.round(q @ v.T, 12)
    expected = [(a, ids[b]) for a in range(37) for b in np.lexsort((ids, -scores[a]))[:4]]
    assert sorted((x["query_id"], x["vec_id"]) for x in found) == sorted(expected)
    assert retrieval.units(pa.array([[3.0, 4.0], [0.0, 0.0]], pa.list_(pa.float32()))).tolist() == [[0.6, 0.8], [0.0, 0.0]]


def optimized(d):
    return d._jdf.queryExecution().optimizedPlan().toString()


def test_clause_chunks_read_lines_once_and_white_space_is_unicodes(spark):
    from quern.functions.text import SPACES, strip

    texts = [a + "x 　y" + b for a in ("", "  \t", "​") for b in ("", "\x85\n\x0b", "　\r\n", "᠎")] + [SPACES, "", None]
    old = F.regexp_replace("t", r"(?U)^\s+|\s+$", "")
    rows = spark.createDataFrame([(t,) for t in texts], "t string").select(strip("t"), old).collect()
    assert all(a == b for a, b in rows) and rows[-3][0] == ""
    lines = spark.createDataFrame([(1, 0, "## 골절진단 담보"), (1, 1, "제1조"), (1, 2, " 부 칙 "), (1, 3, "긴 특약 아님 이것은")], "id int, line_no int, line string")
    c = clause_headers.chunks(lines)
    assert sorted((r.kind, r.start_line, r.end_line, r.n_articles) for r in c.collect()) == [("addendum", 2, 3, 0), ("coverage", 0, 1, 1)]
    assert "Join" not in optimized(c) and "Join" not in optimized(clause_headers.segments(lines))


def test_small_pages_are_matched_as_rows_and_large_ones_by_tiles(spark, monkeypatch):
    r = random.Random(9)
    box = lambda: (lambda x, y: [x, y, x + r.randrange(5, 40), y + 12.0])(float(r.randrange(60)), float(r.randrange(20)))
    kinds = lambda k: f"id long, page long, {k} long, bbox array<double>"
    sizes = {0: 3, 1: 30, 2: 1}
    cells = spark.createDataFrame([(0, p, i, box()) for p, n in sizes.items() for i in range(n)] + [(0, 0, 99, [1.0, 2.0]), (0, 9, 1, box())], kinds("cell"))
    lines = spark.createDataFrame([(0, p, i, box()) for p, n in sizes.items() for i in range(n)] + [(0, 0, 99, [5.0, 5.0, 1.0, 9.0])], kinds("ord"))
    found = []
    for small in (0, 100, 10_000):  # none, some and all pages are small
        monkeypatch.setattr(spatial, "SMALL", small)
        found.append([sorted((x.page, x.cell, x.ord, x.iou) for x in f(cells, lines).select("page", "cell", F.coalesce("ord", F.lit(-1)).alias("ord"), F.coalesce("iou", F.lit(-1.0)).alias("iou")).collect()) for f in (spatial.best_match, spatial.exclusive_match)])
    assert found[0] == found[1] == found[2] and len(found[0][0]) == 36 and len(found[0][1]) > 10


def test_structure_and_markdown_read_cells_once(spark):
    from quern.operators import table_structure

    rows = [(1, 0, 0, 0, 1, 2, "a"), (1, 0, 0, 1, 1, 1, "b"), (1, 0, 1, 0, 2, None, "c"), (2, 0, 0, 0, 1, 1, "d"), (2, 0, 0, 0, 1, 1, "e"), (3, 0, 0, 2, 1, 1, None), (3, 0, 1, 0, 1, 1, "f")]
    cells = spark.createDataFrame(rows, "id int, table_no int, row int, col int, rowspan int, colspan int, text string")
    p, m = table_structure.structure_problems(cells), tables.markdown_tables(cells)
    assert sorted(map(tuple, p.collect())) == [(1, 0, True, False, True), (2, 0, False, True, False), (3, 0, False, False, False)]
    assert {r.id: r.markdown for r in m.collect()} == {1: "| a | b |\n| --- | --- |\n| c |  |", 2: "| e |\n| --- |", 3: "|  |  |  |\n| --- | --- | --- |\n| f |  |  |"}
    assert "Join" not in optimized(p) and "Join" not in optimized(m)


def test_findings_cut_only_what_they_need_into_words(spark):
    from quern.operators import answers

    long = "go a " + " ".join(f"w{i}" for i in range(300))
    texts = [long, "one two three", "x " * 50, "아 보통 그렇다", "let's thinK so", "", None, "a b " + " ".join(f"v{i}" for i in range(43)), "무보통", "ab-cd,ef gh ij kl mn op"]
    words = F.filter(F.regexp_extract_all("t", F.lit("([A-Za-z0-9가-힣]+)"), F.lit(1)), lambda x: F.length(x) >= 2)
    phrases = F.transform(F.sequence(F.lit(0), F.greatest(F.least(F.size(words) - 3, F.lit(40)) - 1, F.lit(0)), F.lit(3)), lambda i: F.array_join(F.slice(words, i + 1, 4), " "))
    d = spark.createDataFrame([(t, c) for t in texts for c in (long, "v40 v41 v42", "v36 v37 v38 v39", "none")], "t string, c string")
    plain = [F.col("t").rlike("(?iU)" + "|".join(f"(?:{p})" for p in x)) for x in (answers.LEAKS, answers.GENERIC)]
    g = answers.grounded(F.col("t"), F.col("c"))
    for a, b, x, y, u, v in d.select(g, (F.size(words) < 8) | F.exists(phrases, lambda p: F.contains("c", p)), answers.any_of(F.col("t"), answers.LEAKS), plain[0], answers.any_of(F.col("t"), answers.GENERIC), plain[1]).collect():
        assert (a, x, u) == (b, y, v)
    assert "{0,44}" in str(g)
    e = spark.createDataFrame([], "doc_id long, question string, ord int, scope_id string, scope_title string, decision string, answer string, evidence array<struct<article:string,quote:string>>, exclusions_checked boolean, exclusions array<string>, conditions array<string>, confidence double")
    assert answers.merged(e)._jdf.queryExecution().analyzed().toString().count("collect_list") == 1


def test_most_places_of_a_text_are_passed_by_their_first_letter(spark):
    rules = spark.createDataFrame([("A", "keyword", "[x", 1), ("A", "keyword", "^y]", 1), ("B", "keyword", "\\d", 2), ("B", "keyword", "😀", 2), ("C", "exclude", "-z", 3), ("C", "keyword", "tv", 3)], "channel string, kind string, word string, priority int")
    r = rule_classifier.compiled(rules)
    assert r.pattern.startswith("(?=[")
    d = spark.createDataFrame([(i, None, None, t) for i, t in enumerate(["a[x", "^y]", "\\d", "q😀", "tv", "tv-z", "x"])], "id int, metadata array<string>, file_name string, text string")
    assert [x.channel for x in rule_classifier.classify(d, r).orderBy("id").collect()] == ["A", "A", "B", "B", "C", "일반", "일반"]


def test_runs_of_a_stream_are_bounded(spark, monkeypatch):
    rows = [(i, i % 3, 1000 + i, "fail" if i % 4 else "done") for i in range(60)]
    ledger = spark.createDataFrame(rows, "event_id long, key long, at long, event string").select("event_id", "key", F.timestamp_micros("at").alias("ts"), "event")
    runs, real = [], keyed_state.run_once
    monkeypatch.setattr(keyed_state, "run_once", lambda *a: runs.append(real(*a)))
    monkeypatch.setattr(keyed_state, "RUN", 12)
    found = {r.event_id: (r.n_same, r.n_held) for r in keyed_state.arriving(ledger, lambda s: keyed_state.last_mix(s, 5)).collect()}
    assert len(runs) == 5
    for i, k, _, event in rows:
        before = [e for j, q, _, e in rows if q == k and j <= i][-5:]
        assert found[i] == (before.count(event), len(before))


def pairs_of(query, spark, path, texts):
    spark.createDataFrame([(i, x, "s") for i, x in enumerate(texts)], "doc_id long, text string, source string").write.parquet(f"{path}/documents.parquet")
    return {(r.a, r.b): r.similarity for r in query(spark, str(path)).collect()}


def test_structural_pairs_link_copies_too(spark, tmp_path):
    from quern.plans.queries import QUERIES

    one, near = "one two three four five six seven eight nine ten", "one two three four five six seven eight nine tenth"
    found = pairs_of(QUERIES["structural_pairs"], spark, tmp_path, [one, near, one, "other words stand here", near, "", "", one])
    copies = [{0, 2, 7}, {1, 4}]
    assert found.keys() == {(a, b) for a in (0, 1, 2, 4, 7) for b in (0, 1, 2, 4, 7) if a < b}
    assert {k for k, s in found.items() if s == 1.0} == {k for k in found if any(set(k) <= c for c in copies)}


def test_semantic_pairs_link_copies_too(spark, tmp_path):
    from quern.plans.queries import QUERIES

    assert pairs_of(QUERIES["semantic_pairs"], spark, tmp_path, ["a b c", "x y", "c b a", "", "", "a b c"]) == {(0, 2): 1.0, (0, 5): 1.0, (2, 5): 1.0}


def test_structural_similarity_at_a_half_of_the_last_digit(spark, tmp_path):
    """0.9296875: SQL adds exact decimals first."""
    from quern.plans.queries import QUERIES

    assert pairs_of(QUERIES["structural_pairs"], spark, tmp_path, ["a b c".ljust(n, "!") for n in (440, 2816)]) == {(0, 1): 0.929688}


def over_line_items(spark, path, name, rows):
    """The rows of a query over line items (order, part, supplier, number, quantity, discount), and those of its SQL."""
    import duckdb

    import __spark_entry__

    lines = spark.createDataFrame(rows, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double")
    lines.selectExpr("*", "1.0D AS l_extendedprice", "'N' AS l_returnflag", "'F' AS l_linestatus").coalesce(1).write.parquet(f"{path}/lineitem.parquet")
    c = duckdb.connect()
    c.execute(f"CREATE VIEW lineitem AS SELECT * FROM '{path}/lineitem.parquet/*.parquet'")
    found = c.sql(__spark_entry__.oracle_sql()[name])
    plain = lambda x: float(x) if hasattr(x, "as_tuple") else x
    expected = [dict(zip(found.columns, map(plain, r), strict=True)) for r in found.fetchall()]
    in_order = lambda rows: sorted(rows, key=lambda r: (r["id"], r["table_no"]))
    return in_order(r.asDict() for r in __spark_entry__.queries()[name](spark, str(path)).select(*found.columns).collect()), in_order(expected)


def test_the_fixed_gate_adds_up_as_its_sql(spark, tmp_path):
    """The mean of the cells' reliability is 0.7, but added up column by column it is less by the last digit."""
    rows = [(1, 1, 1, 1, 41.0, 0.02), (1, 4, 1, 1, 41.0, 0.02), (1, 12, 1, 3, 26.0, 0.02), (1, 15, 1, 3, 16.0, 0.06), (1, 8, 1, 5, 47.0, 0.02)]
    got, expected = over_line_items(spark, tmp_path, "fixed_table_gate", rows)
    assert got == expected and [(r["header_ok"], r["passed"]) for r in got] == [(True, False)]


def test_the_assessment_adds_up_rows_as_its_sql(spark, tmp_path):
    """Two rows of a table without a first row have equal scores but for the last digit."""
    rows = [(538766, 62750, 3472, 3, 35.0, 0.06), (538766, 73333, 3791, 4, 16.0, 0.03), (538766, 66075, 3363, 7, 25.0, 0.08)]
    got, expected = over_line_items(spark, tmp_path, "table_assessment", rows)
    assert got == expected and [r["header_rows"] for r in got] == ["0", "1"]


def test_the_best_row_is_the_same_in_any_order_of_cells(spark):
    import random

    from quern.operators import table_structure

    row = lambda n, s, texts: [(n, c, t, (s % m) / m, p) for p, (c, t, m) in enumerate(texts)]
    cells = row(2, 3791, [(0, "N F", 7), (1, "16,000만원", 9), (2, "3%", 11), (1, "내용4", 5)]) + row(1, 3363, [(0, "N F", 7), (1, "25,000만원", 9), (2, "8%", 11)])
    rows = [(i, 0, r, c, 1, 1, t, "", x, p) for i in range(40) for r, c, t, x, p in random.Random(i).sample(cells, len(cells))]
    c = spark.createDataFrame(rows, "id int, table_no int, row int, col int, rowspan int, colspan int, text string, ocr_text string, reliability double, part int").coalesce(1)
    assert {tuple(r.header_rows) for r in table_structure.assess(c, parts=4).collect()} == {(2,)}


@pytest.mark.parametrize("name", ["structure_problems", "table_assessment"])
def test_line_items_are_placed_and_shuffled_once_for_their_cells(spark, name):
    from quern.plans.derived_queries import QUERIES

    plan = QUERIES[name](spark, "/root/testdata/sf0.001")._jdf.queryExecution().executedPlan().toString()
    assert (plan.count("Exchange "), plan.count("FileScan"), plan.count("SortMergeJoin")) == (1, 1, 0)


def test_numbers_settle_structural_pairs_before_words_are_compared(spark):
    import random

    from quern.operators import dedup

    r = random.Random(5)
    rows = [(i, "", "", " ".join(r.choices("abcdefghijklmn", k=r.randint(1, 12))) + "!" * r.randint(0, 30), "s") for i in range(300)]
    found = dedup.structural_pairs(spark.createDataFrame(rows, EXAMPLE))
    condition = next(x for x in found._jdf.queryExecution().optimizedPlan().toString().split("\n") if "Join Inner" in x and "a_place" in x)
    assert condition.index("a_place") < condition.index("array_intersect")
    got = {(x.a, x.b): round(x.similarity, 9) for x in found.collect()}
    first = {}
    for i, *_, text, _ in rows:
        first.setdefault((len(text), frozenset(text.replace("!", "").split()[:10])), i)
    expected = {}
    for (n, x), a in first.items():
        for (m, y), b in first.items():
            s = (0.8 + 0.1 * (1 - abs(n - m) / max(n, m)) + 0.3 * len(x & y) / len(x | y)) / 1.2
            if a < b and s >= 0.85:
                expected[a, b] = round(s, 9)
    assert got == expected and len(got) > 100
