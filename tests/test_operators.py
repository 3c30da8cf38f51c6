"""Operators on small inputs with known results."""

import json

from pyspark.sql import functions as F

from quern.functions import text as T
from quern.operators import answers, chunking, classify, dedup, records, retrieval, tables
from quern.sources import files
from quern.streaming import ledger

EXAMPLE = "ord long, instruction string, input string, output string, source string"


def test_exact_dedup(spark):
    e = spark.createDataFrame([(1, "", "test", "This is a test output content", "a"), (2, None, "test", "This is a   test output content", "a"), (3, "", "test", "Different content here now", "a"), (4, "", "", "short", "a"), (5, "", "", "short", "a")], EXAMPLE)
    assert {r.ord for r in dedup.exact(e, 10).collect()} == {1, 3, 4, 5}
    assert dedup.exact(e.limit(0)).count() == 0


def test_greedy_keep_first(spark):
    """a ~ b, b ~ c, but not a ~ c: a and c stay."""
    e = spark.createDataFrame([(i, "", "", "x", "s") for i in range(1, 7)], EXAMPLE)
    pairs = spark.createDataFrame([(1, 2), (2, 3), (3, 4), (5, 6)], "a long, b long")
    assert {r.ord for r in dedup.keep_first(e, pairs).collect()} == {1, 3, 5}


def test_structural_identity_is_one(spark):
    e = spark.createDataFrame([(i, "coverage", "", "policy limit coverage", "s") for i in (1, 2)], EXAMPLE)
    # equal features are one class, whose members have similarity 1 by definition and are no pairs
    assert {r.ord: r["class"] for r in dedup.structural_classes(e).collect()} == {1: 1, 2: 1} and dedup.structural_pairs(e).count() == 0
    nearly = e.unionByName(spark.createDataFrame([(3, "coverage", "", "policy limit coverage!", "s")], EXAMPLE))
    assert [(r.a, r.b, round(r.similarity, 9)) for r in dedup.structural_pairs(nearly).collect()] == [(1, 3, round((0.9 - 0.1 / 22 + 0.3) / 1.2, 9))]


def test_messages_and_thinking(spark):
    d = spark.createDataFrame([("SYS", "USER", ""), ("SYS", "USER", "x" * 101), ("SYS", "USER", "x" * 100)], "instruction string, input string, output string")
    rows = d.select(records.messages().alias("m"), records.think(F.col("output")).alias("t")).collect()
    assert [m.role for m in rows[0].m] == ["system", "user"]
    assert rows[1].t.startswith("<think>") and not rows[2].t.startswith("<think>")


def test_row_sentences_leave_out_unreliable_cells(spark):
    c = spark.createDataFrame([(1, 0, 0, 0, "H1", 1.0), (1, 0, 0, 1, "H2", 1.0), (1, 0, 1, 0, "V1", 0.7), (1, 0, 1, 1, "V2", 0.5)], "id long, table_no int, row int, col int, text string, reliability double")
    assert [r.sentence for r in tables.row_sentences(c).collect()] == ["H1: V1"]


def test_clause_context(spark):
    p = spark.createDataFrame(list(enumerate(["제1장 총칙", "제1조 목적", "본문", "제2장 보상", "본문", "별표1 표", "본문"])), "idx int, text string").withColumn("id", F.lit(1))
    assert [r.clause_title for r in chunking.clause_context(p).orderBy("idx").collect()] == ["제1장 총칙", "제1조 목적", "제1조 목적", "제2장 보상", "제2장 보상", "별표1 표", "별표1 표"]


def test_packing(spark):
    d = spark.createDataFrame([(1, ["a" * 40, "b" * 40, "c" * 200, "d"])], "id long, paragraphs array<string>")
    assert [len(r.text) for r in chunking.pack(d, 100).orderBy("chunk_no").collect()] == [82, 200, 1]


def test_cell_patterns_and_sanity(spark):
    d = spark.createDataFrame([("1,000원",), ("2024-01-02",), ("a1",), ("abc",)], "t string")
    assert [r[0] for r in d.select(tables.pattern_score(F.col("t"))).collect()] == [1.0, 1.0, 0.6, 0.5]
    s = spark.createDataFrame([("ok text here",), ("\x01\x02abc",), ("�" * 3 + "abcdefghijklmn",)], "t string")
    assert [r[0] for r in s.select(T.sane(F.col("t"))).collect()] == [True, False, False]


def test_box_overlap(spark):
    cells = spark.createDataFrame([(1, 1, 0, "", [0.0, 0.0, 10.0, 10.0]), (1, 1, 1, "", [50.0, 50.0, 60.0, 60.0])], "id int, page int, cell int, text string, bbox array<double>")
    lines = spark.createDataFrame([(1, 1, 0, "far", [0.0, 0.0, 4.0, 4.0]), (1, 1, 1, "near", [1.0, 1.0, 10.0, 10.0])], "id int, page int, ord int, text string, bbox array<double>")
    assert {r.cell: r.ocr_text for r in tables.remap(cells, lines).collect()} == {0: "near", 1: None}


def test_split_sizes_are_exact(spark):
    s = records.split(spark.range(103).select(F.col("id")))
    assert {r.split: r["count"] for r in s.groupBy("split").count().collect()} == {"train": 82, "validation": 10, "test": 11}


def test_findings(spark):
    d = spark.createDataFrame([(1, "q", "one two three four five six seven eight nine", "", "", "one two three four five six seven eight", "p", "1"), (2, "q", None, "", "", "let's think step by step about it", "", None)], "id int, instruction string, canonical string, summary string, operational string, output string, product_id string, version string")
    rows = {r.id: (r.codes, r.ok) for r in answers.findings(d).collect()}
    assert rows[1] == ([], True)
    assert "fail:quality.reasoning_leak" in rows[2][0] and "fail:schema.canonical" in rows[2][0] and not rows[2][1]


def test_findings_query_reads_whole_texts(spark, tmp_path):
    from quern.plans.queries import QUERIES

    fill = "plain words of one text. " * 200
    texts = [(1, "go step by step now. " + fill, "s"), (2, fill + "go step by step now. " + fill, "s"), (3, fill, "s")]
    spark.createDataFrame(texts, "doc_id long, text string, source string").write.parquet(f"{tmp_path}/documents.parquet")
    rows = {r.id: r.codes.split(",") for r in QUERIES["distill_findings"](spark, str(tmp_path)).collect()}
    assert ["fail:quality.reasoning_leak" in rows[i] for i in (1, 2, 3)] == [True, True, False]


def test_merge_prefers_not_covered(spark):
    r = spark.createDataFrame([("d", "q", 1, "covered", 1, True, 0, 0.9), ("d", "q", 2, "not_covered", 0, True, 1, 0.8)], "doc_id string, question string, ord int, decision string, n_evidence int, exclusions_checked boolean, n_exclusions long, confidence double")
    m = answers.merge(r).collect()[0]
    assert (m.final_decision, m.confidence, m.n_warnings, m.conflict) == ("not_covered", 0.55, 1, True)


def test_search_in_blocks(spark, monkeypatch):
    v = spark.createDataFrame([(i, [float(i % 3), 1.0, float(i % 5)]) for i in range(40)], "vec_id long, embedding array<double>")
    q = v.filter("vec_id < 10").select(F.col("vec_id").alias("query_id"), "embedding")
    whole = {(r.query_id, r.rank, r.vec_id) for r in retrieval.search(v, q).collect()}
    monkeypatch.setattr(retrieval, "QUERY_BLOCK", 4)
    assert {(r.query_id, r.rank, r.vec_id) for r in retrieval.search(v, q).collect()} == whole


def test_contexts(spark):
    h = spark.createDataFrame([(1, "paraphrase", 1, "p1"), (1, "canonical", 2, "c"), (1, "paraphrase", 3, "p2")], "query_id int, role string, rank int, text string")
    assert retrieval.contexts(h, 1).collect()[0].context == "c\n\np1"


def test_roles_and_risk(spark):
    d = spark.createDataFrame([("상품요약서.pdf", "지급하지 않는 사유")], "n string, t string")
    score, tier = classify.clause_risk(F.col("t"))
    assert tuple(d.select(classify.document_role(F.col("n")), score, tier).collect()[0]) == ("paraphrase", 10, "L2")


def test_files(spark, tmp_path):
    d = spark.createDataFrame([(1, "a"), (2, None)], "id int, t string")
    files.write_jsonl(d, str(tmp_path / "j"))
    (tmp_path / "j" / "part-x.txt").write_text('\n{"id": 3\n')
    back = files.read_jsonl(spark, str(tmp_path / "j"), "id int, t string").collect()
    assert sorted((r.id, r.t) for r in back if r.id is not None and not r["__broken"]) == [(1, "a"), (2, None)]
    (tmp_path / "x.pdf").write_bytes(b"%PDF-1.4\n" + b"0" * 200 + b"%%EOF")
    (tmp_path / "y.pdf").write_bytes(b"no")
    b = spark.read.format("binaryFile").load([str(tmp_path / "x.pdf"), str(tmp_path / "y.pdf")])
    assert sorted(len(r[0]) for r in b.select(files.pdf_problems()).collect()) == [0, 3]
    assert files.list_files(spark, str(tmp_path)).count() == 2


def test_stream_gives_what_a_batch_gives(spark, tmp_path):
    rows = spark.createDataFrame([(i, i % 3, f"2024-01-01 0{i % 5}:00:00", "done" if i % 2 else "fail", float(i)) for i in range(30)], "event_id long, key long, t string, event string, value double").withColumn("ts", F.col("t").cast("timestamp")).drop("t")
    rows.write.parquet(str(tmp_path / "in"))
    stream = spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in"))
    q = ledger.per_window(stream).writeStream.format("memory").queryName("windows").outputMode("complete").trigger(availableNow=True).start()
    q.awaitTermination(120)
    assert sorted(map(tuple, spark.table("windows").collect())) == sorted(map(tuple, ledger.per_window(rows).collect()))
    for _ in range(2):  # a second start finds nothing new
        ledger.follow(stream, str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(120)
    assert json.dumps(spark.read.parquet(str(tmp_path / "out")).count()) == "30"


def test_routes_reports_and_guards(spark, tmp_path):
    d = spark.createDataFrame([(1, "auto"), (2, "auto"), (3, "review")], "id int, route string")
    assert {r.route: r.n for r in files.write_by_route(d, str(tmp_path / "routes")).collect()} == {"auto": 2, "review": 1}
    assert files.markdown_report("t", {"n": 2, "share": 1 / 3}).endswith("| n | 2 |\n| share | 0.3333 |")
    p = spark.createDataFrame([("/d/a", 10), ("/d/../x", 10), ("/e/a", 10), ("/d/b", 100 << 20), (None, 1)], "p string, n long")
    assert [r[0] for r in p.select(files.within(F.col("p"), F.col("n"), "/d")).collect()] == [True, False, False, False, None]


def test_a_cell_that_stands_twice_does_not_break_its_table(spark):
    c = spark.createDataFrame([(1, 0, 0, 0, "a"), (1, 0, 0, 0, "b"), (1, 0, 1, 1, "c")], "id int, table_no int, row int, col int, text string")
    assert tables.markdown_tables(c).first().markdown == "| b |  |\n| --- | --- |\n|  | c |"


def test_best_threshold_and_review(spark):
    s = spark.createDataFrame([(0.1, 0.5), (0.3, 0.9), (0.5, 0.9)], "threshold double, macro_f1 double")
    assert tuple(classify.best_threshold(s).first()) == (0.3, 0.9, "good")
    r = spark.createDataFrame([(False, 0.9, "TM"), (True, 0.9, "TM"), (False, 0.4, "TM"), (False, 0.9, "일반"), (None, None, None)], "m boolean, c double, ch string")
    assert [x[0] for x in r.select(classify.needs_review(F.col("m"), F.col("c"), F.col("ch"))).collect()] == [False, True, True, True, True]


def test_new_operators_take_empty_tables(spark):
    from quern.operators import clause_headers, contracts, record_quality, scope_checks, spatial, table_structure
    from inline_tables import TABLES

    none = lambda name: spark.sql(f"SELECT * FROM VALUES {TABLES[name][1]} AS t({TABLES[name][0]})").limit(0)
    cells, lines = none("grid_cells"), none("clause_lines")
    for out in (
        table_structure.header_rows(table_structure.header_scores(cells)), table_structure.expand_spans(cells), table_structure.structure_problems(cells), clause_headers.segments(lines),
        clause_headers.articles(lines), record_quality.add_scores(none("plain_records")), scope_checks.violations(none("scope_answers"), none("scope_evidence"), none("scope_titles")),
        spatial.grid(none("boxes")), spatial.outside(none("boxes"), none("table_boxes")), contracts.four_stage_filter(none("generated_examples")), contracts.article_groups(none("article_sizes")),
    ):
        assert out.count() == 0


def test_titles_are_found_within_texts(spark):
    from quern.operators import scope_checks

    titles = ["특약", "암 특약", "a", "long title one", "long title two", "", None, "😀😀😀😀😀x"]
    texts = ["위암 특약과", "a long title on", "see long title two!", "", None, "특", "x" * 20_000 + "long title one", "..😀😀😀😀😀x", "long\ntitle one"]
    d = spark.createDataFrame(list(enumerate(texts)), "id int, text string")
    found = scope_checks.mentions(d, spark.createDataFrame([(t,) for t in titles], "title string"))
    assert {(r.id, r.title) for r in found.collect()} == {(i, t) for i, x in enumerate(texts) for t in titles if x and t and t in x}
    assert "NestedLoop" not in (plan := found._jdf.queryExecution().toString()) and "Cartesian" not in plan
    assert scope_checks.mentions(d, spark.createDataFrame([("",)], "title string")).count() == 0


def test_packing_streams_over_sorted_rows(spark):
    import random

    from quern.operators import packing

    r = random.Random(3)
    rows = [(k, i, r.choice([0, 1, 5, 9, 30, None])) for k in (None, 1, 2) for i in range(200)] + [(3, 0, 99)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        got = {(x.k, x.i): x.g for x in packing.greedy_groups(spark.createDataFrame(rows, "k int, i int, n long").repartition(5), "k", "i", "n", 20, "g").collect()}
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")
    for k in (None, 1, 2, 3):
        group, held = 0, None
        for _, i, n in sorted((x for x in rows if x[0] == k), key=lambda x: x[1]):
            if held is not None and held + (n or 0) > 20:
                group, held = group + 1, None
            held = (held or 0) + (n or 0)
            assert got[k, i] == group
    assert packing.greedy_groups(spark.createDataFrame([], "k int, i int, n long"), "k", "i", "n", 20, "g").count() == 0


def test_critique_and_compliance_of_korean_texts(spark):
    from quern.operators import critique

    long = "따라서 보험금을 지급합니다. 그러나 면책에 해당하면 지급하지 않습니다. 또한 약관의 별표에서 정한 금액까지 지급하며 으로 시작합니다. " * 2
    d = spark.createDataFrame([(1, "보험금을 지급합니까", "따라서 보험금을", long), (2, None, None, None), (3, "", "", "짧다."), (4, "a", "b", "x" * 120)], "id int, instruction string, context string, output string")
    rows = {r.id: r for r in critique.critique(d).collect()}
    assert rows[1].coherence == 6.0 and rows[1].completeness == 6.5 and rows[1].korean > 6.5 and rows[1].clarity == 8.0
    assert (rows[2].coherence, rows[2].accuracy, rows[2].completeness, rows[2].korean, rows[2].clarity, rows[2].passed) == (3.0, 4.0, 3.0, 4.0, 3.0, False)
    assert rows[4].coherence == 5.0 and rows[2].verdict == "전면적인 재작성이 필요합니다."
    t = spark.createDataFrame([("메일은 a@b.kr ~입니다",), ("문의 드립니다",), ("문의 님 ~니다",), ("미친 ~니다",), (None,), ("~니다" * 3000,)], "t string")
    got = [(r.x.violations, r.x.passed) for r in t.select(critique.compliance(F.col("t")).alias("x")).collect()]
    assert got == [(["personal_data"], False), (["informal", "no_honorifics"], False), ([], True), (["slur"], False), (["informal"], False), (["too_long"], True)]


def test_validation_says_what_to_do(spark):
    from quern.operators import scope_checks

    a = spark.createDataFrame([(1, "암 특약", "제1조 지급", "지급됩니다", "보장", True), (2, "암 특약", "제 2 조", "골절 특약에서는 아마", "비보장", True), (3, "암 특약", "제1조", "보통 그렇다", "insufficient", None), (4, None, None, None, None, None)], "id int, scope_title string, scope_text string, answer string, decision string, exclusions_checked boolean")
    e = spark.createDataFrame([(1, "제 1 조"), (2, "제3조"), (2, None)], "id int, article string")
    t = spark.createDataFrame([("암 특약",), ("골절 특약",)], "title string")
    got = {r.id: (r.problems, r.severity, r.action) for r in scope_checks.validated(a, e, t).collect()}
    assert got == {1: ([], "none", "accept"), 2: (["other_scope", "foreign_article", "speculation"], "error", "retry"), 3: (["external_reference"], "warning", "accept_with_warning"), 4: ([], "none", "accept")}


def test_merged_answers_as_markdown(spark):
    kind = "doc_id int, question string, ord int, scope_id string, scope_title string, decision string, answer string, evidence array<struct<article:string,quote:string>>, exclusions_checked boolean, exclusions array<string>, conditions array<string>, confidence double"
    r = spark.createDataFrame([(1, "q", 1, "s1", "A", "covered", " yes ", [("a1", "q1")], True, [], ["c"], 0.9), (1, "q", 2, "s2", "B", "not_covered", "no", None, True, ["x"], None, 1.4), (1, "q", 3, "s3", "C", "covered", "so", [], False, None, ["c"], 0.8)], kind)
    m = answers.merged(r).first()
    assert (m.final_decision, m.confidence, m.conflicts) == ("not_covered", 0.55, ["decision_conflict", "exclusion_found"])
    assert m.warnings == ["Missing evidence: s2", "Missing evidence: s3", "Covered without exclusions_checked → downgrade: s3"]
    assert m.conditions == ["c", answers.UNCHECKED] and m.exclusions == ["x"]
    assert "**B** (신뢰도: 55%)" in m.answer and "- **C**: conditional (신뢰도: 55%)" in m.answer and "인용 근거" not in m.answer
    assert answers.merged(r.limit(0)).count() == 0


def test_pruning_at_any_depth(spark):
    kind = "id int, a string, s struct<t:string,u:struct<v:string,w:int>>, l array<struct<x:string,y:int>>, e array<string>, n int"
    r = spark.createDataFrame([(1, " ", ("", (None, None)), [("", None), ("k", None)], [], None), (2, "v", ("t", ("", 3)), [], ["", "z", None], 0), (3, None, None, None, None, None)], kind)
    got = {x.id: x for x in records.without_empty(r, ["id"]).collect()}
    assert got[1].a is None and got[1].s is None and got[1].l == [("k", None)] and got[1].e is None
    assert got[1].removed == ["a", "s.t", "s.u.v", "s.u.w", "l[0].x", "l[0].y", "l[1].y", "n"]
    assert got[2].s == ("t", (None, 3)) and got[2].l is None and got[2].e == ["z"] and got[2].n == 0 and got[2].removed == ["s.u.v"]
    assert got[3].removed[0] == "a" and got[3].s is None


def test_students_get_the_sources_that_were_used(spark):
    from quern.operators import distillation

    t = spark.createDataFrame([(1, "q", "c", "s", "o", "a", ["summary", "canonical"]), (2, "q", "", "s", None, None, ["canonical", "operational"]), (3, "q", "c", "s", "o", "a", None)], "id int, instruction string, canonical string, summary string, operational string, answer string, sources array<string>")
    got = {r.id: (r.context, r.output) for r in distillation.to_student(t).collect()}
    assert got == {1: ("[약관]\nc\n\n[상품요약서]\ns", "a"), 2: ("", ""), 3: ("[약관]\nc", "a")}
    k = spark.createDataFrame([("operation",), ("x",), (None,)], "k string")
    assert [r[0] for r in k.select(distillation.expert(F.col("k"))).collect()] == [2, 0, 0]


def test_merging_shuffles_alike(spark):
    a = spark.createDataFrame([(i % 30, None if i % 7 == 0 else "x") for i in range(60)], "i int, t string")
    first = [(r.i, r.t) for r in records.merged([a, a.limit(5)], ["i", "t"]).orderBy("place").collect()]
    again = [(r.i, r.t) for r in records.merged([a.repartition(5)], ["i", "t"]).orderBy("place").collect()]
    assert first == again and sorted(first, key=str) == sorted({(r.i, r.t) for r in a.collect()}, key=str) and first != sorted(first, key=str)
    assert [(r.i, r.t) for r in records.merged([a], ["i", "t"], 7).orderBy("place").collect()] != first


def test_leaks_say_which(spark):
    d = spark.createDataFrame([("생각해보면 그렇다",), ("go Step by step",), ("let's think, chain of thought",), ("plain",), (None,)], "t string")
    got = [r[0] for r in d.select(answers.leak(F.col("t"))).collect()]
    assert got == [answers.LEAKS[0], answers.LEAKS[6], answers.LEAKS[4], None, None]


def test_files_by_pattern_and_format(spark):
    names = ["/a/x1.pdf", "/a/y.PDF", "/b/x22.pdf", "/b/[z].hwp", "/b/none"]
    d = spark.createDataFrame([(n,) for n in names], "path string")
    import fnmatch

    for pattern in ("*.pdf", "x?.pdf", "[xy]*", "[!xy]*", "*", "[[]z].hwp", "x.pdf", "*+*"):
        assert {r.path for r in files.matching(d, pattern).collect()} == {n for n in names if fnmatch.fnmatchcase(n.split("/")[-1], pattern)}, pattern
    rows = [("a.pdf", b"%PDF-1"), ("a.hwp", b"%PDF-1"), ("b.HWPX", b"PK\x03\x04"), ("c.doc", b""), ("d", None), (None, b"x")]
    c = spark.createDataFrame(rows, "path string, content binary").select(files.dispatch(F.col("path")).alias("x"))
    assert [tuple(r.x) for r in c.collect()] == [("pdf", None), ("hwp", "content is pdf"), ("hwpx", None), (None, "unsupported format: .doc"), (None, "unsupported format: "), (None, None)]


def test_small_record_operators(spark):
    d = spark.createDataFrame([(i, c) for i, c in enumerate(["b", "a", None, "a", "", "c", "b", "a"])], "i int, c string")
    assert {(r.c, r.first) for r in records.ordered_distinct(d, "c", "i").collect()} == {("b", 0), ("a", 1), ("c", 5)}
    want = [("a", 3, 1), ("b", 2, 2), (None, 1, 3), ("", 1, 4), ("c", 1, 5)]
    assert sorted((tuple(r) for r in records.most_common(d, "c", "i").select("c", "n", "place").collect()), key=lambda r: r[2]) == want
    assert sorted((tuple(r) for r in records.most_common(d, "c", "i", 2).select("c", "n", "place").collect()), key=lambda r: r[2]) == want[:2]
    assert {r.i for r in records.capped(d, ["c"], ["i"], 1).collect()} == {0, 1, 2, 4, 5}
    few, more = ({r.id for r in records.sampled(spark.range(1000), ["id"], f).collect()} for f in (0.1, 0.4))
    assert few < more and 60 < len(few) < 140 and records.sampled(spark.range(9), ["id"], 1.0).count() == 9 and records.sampled(spark.range(9), ["id"], 0.0).count() == 0


def test_boxes_turn_with_their_page(spark):
    from quern.operators import spatial

    d = spark.createDataFrame([(t, [0.0, 0.0, 10.0, 20.0], [0.0, 0.0, 100.0, 200.0]) for t in (0, 90, 180, 270, 45)], "turn int, box array<double>, page array<double>")
    width, height = (F.when(F.col("turn").isin(90, 270), a).otherwise(b) for a, b in ((200, 100), (100, 200)))
    got = {r.turn: [round(x, 6) for x in r.b] for r in d.select("turn", spatial.to_page("box", width, height, "page", F.col("turn")).alias("b")).collect()}
    assert got[0] == got[45] == [0, 180, 10, 200] and got[180] == [90, 0, 100, 20] and got[90] == [0, 0, 20, 10] and got[270] == [80, 190, 100, 200]
    p = spark.createDataFrame([([[3.0, 1.0], [5.0, 2.0], [4.0, 9.0]],)], "p array<array<double>>")
    assert p.select(spatial.polygon_box(F.col("p"))).first()[0] == [3.0, 1.0, 5.0, 9.0]


def test_contexts_follow_the_kind_of_question(spark):
    hits = [(q, k, r, i, t) for q, k in ((1, "explanation"), (2, "operation"), (3, "definition"), (4, None)) for i, (r, t) in enumerate([("paraphrase", "p1"), ("canonical", "c"), ("operational", "o"), ("paraphrase", ""), ("paraphrase", "p2")])]
    d = spark.createDataFrame(hits, "query_id int, kind string, role string, rank int, text string")
    got = {r.query_id: (r.context, r.sources) for r in retrieval.contexts_for(d, 1).collect()}
    assert got[1] == (["c", "p1"], "- 약관(canonical)\n- 상품요약서(summary)") and got[2][0] == ["c", "o"] and got[3] == got[4] == (["c"], "- 약관(canonical)")


def test_the_fixed_gate(spark):
    c = spark.createDataFrame([(1, 0, 0, "헤더명", "", None), (1, 0, 1, "", "값입니다", 0.9), (2, 0, 0, "", "", None), (2, 0, 1, "x", "", None)], "id int, table_no int, row int, text string, ocr_text string, ocr_confidence double")
    got = {r.id: (r.fill_rate, r.header_ok, r.passed, r.action) for r in tables.fixed_gate(c).collect()}
    assert got == {1: (1.0, True, True, "index"), 2: (0.5, False, False, "reprocess")}


def test_the_ensemble_sums_what_sources_suggest(spark):
    rows = [(1, "TM " * 10, "(방송).pdf", "방송", 1.0), (2, "nothing", None, None, None), (3, "", "(TM)", "TM", 0.5), (4, None, "x", "new", 1.0), (5, "TM 홈쇼핑", None, "", 1.0)]
    d = spark.createDataFrame(rows, "id int, text string, file_name string, channel_hint string, metadata_quality double")
    got = {r.id: (r.channel, round(r.confidence, 6), r.route) for r in classify.ensemble(d, thresholds={"new": (0.9, 0.3)}).collect()}
    assert got[1] == ("TM", 0.57, "review") and got[2] == (None, 0.0, "unclassified") and got[3] == ("TM", 0.25, "unclassified") and got[4] == ("new", 0.3, "review")
    assert got[5][0] == "TM"  # of equals the smaller priority
    assert [tuple(r) for r in classify.channel_counts(classify.ensemble(d)).select("channel", "n", "percent").collect()] == [("TM", 2, 40.0)]


def test_configurations_are_checked():
    good = {"auto": 0.6, "review": 0.4, "weights": dict(classify.WEIGHTS), "confidence": {"base": 0.3, "location": {"header": 1, "body": 1, "footer": 1}, "frequency": {"coefficient": 1, "max": 1}, "penalty": {"negative": 1}}, "channels": {"TM": {"auto": 0.5}}}
    assert classify.config_problems(good) == []
    assert classify.config_problems(good | {"auto": 0.3}) == ["auto must be above review"]
    assert classify.config_problems(good | {"weights": {"content": 0.5}, "channels": {"TM": {"review": 2}}}) == ["weights.metadata missing", "weights.filename missing", "weights must sum to 1", "channels.TM.review out of range"]
    assert len(classify.config_problems({})) == 2 + 4 + 1 + 6


def test_pages_that_are_tables(spark):
    from quern.operators import spatial

    def line(page, x, y, text, c=0.9):
        return (1, page, text, c, [x - 5.0, y - 4.0, x + 5.0, y + 4.0])

    rows = [line(1, 10, 10, " 담보명 "), line(1, 100, 12, "금액"), line(1, 12, 40, "암"), line(1, 101, 41, "1원", 0.1), line(2, 10, 10, "a"), line(2, 100, 10, "b"), line(3, 10, 10, "a"), line(3, 10, 40, "b"), line(3, 10, 80, "c"), line(3, 10, 120, "d")]
    d = spark.createDataFrame(rows, "id int, page int, text string, confidence double, bbox array<double>")
    t = spatial.page_tables(d).collect()
    assert [(r.page, r.n_rows, r.n_cols, r.n_cells, r.bbox, r.title, r.confidence, r.passed) for r in t] == [(1, 2, 2, 4, [5.0, 6.0, 106.0, 45.0], "담보명", 0.7, True)]
    assert spatial.page_tables(d.limit(0)).count() == 0


def test_review_statistics(spark):
    rows = [(1, 0, "a", "enqueue"), (2, 10, "a", "enqueue"), (3, 30, "a", "resolve"), (4, 40, "a", "resolve"), (5, 50, "a", "enqueue"), (6, 5, "b", "enqueue"), (7, 15, "b", "resolve"), (8, 1, None, "enqueue"), (9, 2, "c", "other")]
    e = spark.createDataFrame(rows, "event_id int, s int, key string, event string").withColumn("ts", F.timestamp_seconds("s"))
    assert tuple(ledger.review_stats(e).first()) == (3, 3, 1, 20.0)
    q = ledger.review_queue(e, 5)
    assert [(r.place, r.key) for r in ledger.dequeued(q, 1).collect()] == [(1, "a")]


def test_retry_prompts(spark):
    from quern.operators import scope_checks

    d = spark.createDataFrame([(["x", "y"],), ([],), (None,)], "p array<string>")
    got = [r[0] for r in d.select(scope_checks.retry_prompt(F.col("p"))).collect()]
    assert got[0].split("\n")[1:3] == ["- x", "- y"] and got[0].endswith(scope_checks.RETRY_RULES[-1]) and got[1] is got[2] is None


def test_clause_chunks_and_paragraphs(spark):
    from quern.operators import clause_headers, table_chunks

    rows = [(1, i, t) for i, t in enumerate(["머리말", "1-2. 암진단비 특별약관", "제1조(목적)", "본문", "골절 담보", "끝"])] + [(2, 0, "아무 제목도 없다"), (2, 1, "제1조")]
    got = sorted(tuple(r) for r in clause_headers.chunks(spark.createDataFrame(rows, "id int, line_no int, line string")).drop("n_chars").collect())
    assert got == [(1, "1:coverage:골절 담보", "coverage", "골절 담보", 4, 5, 0.4, 0, ["short_chunk"]), (1, "1:special_clause:암진단비 특별약관", "special_clause", "암진단비 특별약관", 1, 3, 0.9, 1, ["short_chunk"]), (2, "2:doc", "document", "document", 0, 1, 1.0, 1, ["no_headers"])]
    d = spark.createDataFrame([(1, "제1조 목적\n\n 본문 ", "/a/p1/약관.pdf", None), (2, "x", "요약서.v1.pdf", "given"), (3, None, None, None)], "id int, text string, path string, product_id string")
    rows = [(r.id, r.idx, r.text, r.role, r.product_id, r.version, r.clause_title) for r in table_chunks.paragraph_chunks(d).orderBy("id", "idx").collect()]
    assert rows == [(1, 0, "제1조 목적", "canonical", "p1", "unknown", "제1조 목적"), (1, 2, "본문", "canonical", "p1", "unknown", "제1조 목적"), (2, 0, "x", "paraphrase", "given", "unknown", None)]


def test_reports_in_three_forms():
    row = {"n": 2, "share <1": 1 / 3, "note": "a & b"}
    assert files.report("t", row) == files.markdown_report("t", row)
    assert json.loads(files.report("t", row, "json")) == {"title": "t", "figures": row}
    page = files.report("t<", row, "html")
    assert "<title>t&lt;</title>" in page and "<td>share &lt;1</td><td>0.3333</td>" in page and "a &amp; b" in page


def test_equal_sums_of_an_ensemble_go_by_priority(spark):
    # TM: (0.3 + 0.35 + 0.12) * 0.6; 방송: (0.3 + 0.1 + 0.12) * 0.6 + 0.5 * 0.3; both are 0.462
    text = "tm tm" + "x " * 600 + "tv tv" + " x" * 600
    d = spark.createDataFrame([(1, text, "", "방송", 0.5)], "id long, text string, file_name string, channel_hint string, metadata_quality double")
    assert [(r.channel, round(r.confidence, 6)) for r in classify.ensemble(d).collect()] == [("TM", 0.462)]


def test_a_split_is_by_rank_however_ranges_are_drawn(spark):
    import hashlib

    old = {k: spark.conf.get(k) for k in ("spark.sql.execution.rangeExchange.sampleSizePerPartition", "spark.sql.adaptive.enabled")}
    try:
        spark.conf.set("spark.sql.execution.rangeExchange.sampleSizePerPartition", "3")
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        got = {r.id: r.split for r in records.split(spark.range(5000)).collect()}
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
    order = sorted(range(5000), key=lambda i: hashlib.md5(f"{i}:42".encode()).hexdigest())
    assert got == {i: "train" if k < 4000 else "validation" if k < 4500 else "test" for k, i in enumerate(order)}


def test_a_table_at_a_threshold_passes_in_any_order_of_its_cells(spark):
    import random

    # the mean reliability is 0.7 exactly, but sums in some orders are a little less
    cells = [(0, "담보", None), (0, "가입금액", ""), (0, "10%", ""), (1, "담보", None), (1, "25,000만원", ""), (1, "6%", ""), (2, "암진단비", None), (2, "27,000만원", ""), (2, None, ""), (3, "", "5년"), (3, "49,000만원", ""), (3, None, ""), (6, "N F", None), (6, "45,000만원", ""), (6, None, "")]
    rows = [(i, 0, r, t, o, 0.8 if r % 2 == 0 else 1.7 if r % 3 == 0 else None) for i in range(40) for r, t, o in random.Random(i).sample(cells, len(cells))]
    c = spark.createDataFrame(rows, "id int, table_no int, row int, text string, ocr_text string, ocr_confidence double").coalesce(1)
    assert {(r.avg_reliability, r.action) for r in tables.fixed_gate(c).collect()} == {(0.7, "index")}


def test_the_runs_of_texts_are_not_broadcast(spark):
    from quern.operators import scope_checks

    texts = spark.range(200).select("id", F.concat(F.lit("a title of number "), F.col("id")).alias("text"))
    titles = spark.range(3000).select(F.concat(F.lit("number "), F.col("id")).alias("title"))
    m = scope_checks.mentions(texts, titles)
    plan = m._jdf.queryExecution().executedPlan().toString()
    assert "BuildRight" in plan and "BuildLeft" not in plan
    assert {(r.id, r.title) for r in m.collect()} == {(i, f"number {j}") for i in range(200) for j in range(200) if str(i).startswith(str(j))}
