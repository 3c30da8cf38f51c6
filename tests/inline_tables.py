"""Small tables given in place, for cases that the driver's tables don't hold: columns, and rows in SQL of Spark and, but for type names, DuckDB."""

TABLES = {
    "grid_cells": (
        "id, table_no, row, col, rowspan, colspan, text, ocr_text, reliability",
        "(1,0,0,0,1,1,'담보','',0.9),(1,0,0,1,1,1,'가입금액','',0.95),(1,0,1,0,1,1,'암진단비','',0.9),(1,0,1,1,1,1,'3,000만원','',0.8),(1,0,2,0,1,2,'합계','',0.7),"
        "(1,1,0,0,1,1,'100','',0.4),(1,1,0,1,1,1,'200','',0.4),(1,1,1,0,2,1,'구분','',0.9),(1,1,1,1,1,1,'내용','',0.9),(1,1,1,1,1,1,'내용2','',0.2),"
        "(2,0,0,0,1,1,'상품명','',0.9),(2,0,0,1,1,1,'판매채널','',0.9),(2,0,1,0,1,1,'보험료','',0.9),(2,0,1,1,1,1,'기간','',0.9),(2,0,2,0,1,1,'12.5%','',0.9),(2,0,2,1,1,1,'10년','',0.9),"
        "(3,0,1,0,1,1,'','',0.0),(3,0,1,1,1,1,'','5년',0.5),(3,0,2,0,1,1,CAST(NULL AS STRING),CAST(NULL AS STRING),0.1)",
    ),
    "gate_results": (
        "id, passed, reasons, attempts",
        "(1,true,'',0),(2,false,'low_avg_reliability,pattern_validation_failed',1),(3,false,'low_avg_reliability,header_detection_failed',2),(4,false,'low_fill_rate',0),(5,false,'other',0),(6,false,'structure_validation_failed',3)",
    ),
    "clause_lines": (
        "id, line_no, line",
        "(1,0,'머리말입니다'),(1,1,'- 3 -'),(1,2,'1-2. 암진단비 특별약관'),(1,3,'제1조(목적)'),(1,4,'이 특약은 목적을 정합니다'),(1,5,'제 2 조 (보상)'),(1,6,'본문'),(1,7,'## 골절진단 담보'),(1,8,'내용'),"
        "(1,9,'【별표 1】 장해분류표'),(1,10,'별표 2: 재해분류'),(1,11,'부 칙'),(1,12,'12'),(2,0,'운전자 특약'),(2,1,'제3조'),(2,2,'끝'),(2,3,'(()) [] 특약')",
    ),
    "plain_records": (
        "id, instruction, input, output, text, content",
        "(1,'시스템','질문입니다','답변은 충분히 길어야 하므로 여러 낱말을 넣어 쉰 글자를 넘기도록 이렇게 길게 적어 둡니다. 끝.',CAST(NULL AS STRING),CAST(NULL AS STRING)),(2,'only','','',CAST(NULL AS STRING),CAST(NULL AS STRING)),"
        "(3,CAST(NULL AS STRING),CAST(NULL AS STRING),CAST(NULL AS STRING),'some plain text of a record that has more than ten words in one line.','!!!!! bad aaaaaaa'),(4,CAST(NULL AS STRING),'x',CAST(NULL AS STRING),CAST(NULL AS STRING),''),(5,'a','b','c',CAST(NULL AS STRING),CAST(NULL AS STRING))",
    ),
    "scope_answers": (
        "id, scope_title, scope_text, answer, decision, exclusions_checked, confidence",
        "(1,'암 특약','제1조 암으로 진단 확정된 때 보험금을 지급 합니다','암 진단 때 지급됩니다','보장',true,0.9),(2,'암 특약','제1조 암으로 진단 확정된 때','골절 특약에서는 다릅니다','비보장',false,0.8),"
        "(3,'골절 특약','제2조 골절 때','일반적으로 보장됩니다','insufficient',false,0.4),(4,'골절 특약','제2조 골절로 진단된 때 지급','본문 참조',CAST(NULL AS STRING),CAST(NULL AS BOOLEAN),0.5)",
    ),
    "scope_evidence": ("id, quote, article", "(1,'암으로 진단확정된 때','제1조'),(2,'골절 진단 때 지급','제9조'),(4,'골절로 진단된 때','제2조'),(4,'','')"),
    "scope_titles": ("title", "('암 특약'),('골절 특약'),('입원 특약'),('')"),
    "scope_questions": ("id, question", "(1,'암 특약과 골절 특약은?'),(2,'두 특약의 차이는?'),(3,'보험금은 언제?')"),
    "boxes": (
        "id, page, box, x, y",
        "(1,1,'a',10.0D,10.0D),(1,1,'b',105.0D,14.0D),(1,1,'c',12.0D,26.0D),(1,1,'d',128.0D,40.0D),(1,1,'e',60.0D,41.5D),(1,2,'f',5.0D,5.0D),(1,2,'g',24.0D,19.0D),(1,2,'h',500.0D,34.0D)",
    ),
    "table_boxes": ("id, page, x_min, y_min, x_max, y_max", "(1,1,0.0D,0.0D,110.0D,20.0D),(1,2,400.0D,30.0D,600.0D,40.0D)"),
    "file_names": ("id, name", "(1,'상품(TM).pdf'),(2,'상품(TM전용).pdf'),(3,'상품 TM.pdf'),(4,'상품(방송).pdf'),(5,CAST(NULL AS STRING))"),
    "json_documents": (
        "id, doc",
        '(1,\'{"document":{"source_path":"a.pdf","format":"pdf","parser":"p","encrypted":false,"title":"  암   보험 "},"content":{"paragraphs":["x"]},"tables":[],"assets":{"images":[]},"metadata":{"version":"2024-03","channel":"TM","company":"c"}}\'),'
        '(2,\'{"document":{"source_path":"b.pdf","format":"pdf","parser":"p"},"content":{"paragraphs":[]},"tables":[],"assets":{"images":[]},"product_name":"실손","date":"none","source_file":"b_202312.pdf"}\'),'
        '(3,\'{"document":{"source_path":"","format":"pdf","parser":"p","encrypted":true},"content":{"paragraphs":[]},"tables":[{"table_id":"t","cells":[],"shape":{}},{"table_id":"u","cells":3}],"assets":{"images":[]},"meta":{"name":"운전자","채널":"방송"}}\'),'
        '(4,\'{"content":{"paragraphs":"x"}}\'),(5,\'no json\'),(6,CAST(NULL AS STRING))',
    ),
    "replies": ("id, reply", "(1,' {\"a\": 1} '),(2,concat('```json',chr(10),'{\"a\":',chr(10),'2}',chr(10),'```',chr(10),'so')),(3,concat('```',chr(10),'x',chr(10),'```')),(4,CAST(NULL AS STRING))"),
    "quoted_outputs": ("id, output, canonical, qtype", "(1,'약관은 \"보험금을 지급\"한다','회사는 보험금을 지급 합니다','definition'),(2,'약관은 \"없는 문장입니다\" 한다','회사는 지급','operation'),(3,'인용이 없다','회사는 지급','definition'),(4,'인용이 없다','회사는 지급','comparison'),(5,'','x','definition'),(6,'인용 없음','x',CAST(NULL AS STRING))"),
    "generated_examples": ("ord, instruction, output, overall, korean, passed_checks, n_violations", "(1,'a','x',8.0D,7.0D,true,0),(2,'a','x',9.0D,9.0D,true,0),(3,'b','y',6.9D,9.0D,true,0),(4,'b','y',7.0D,6.0D,true,2),(5,'c','z',9.0D,5.0D,true,0),(6,'d','z',9.0D,9.0D,false,0),(7,'e','z',9.0D,9.0D,true,3)"),
    "article_sizes": ("id, article_no, n_chars", "(1,1,5000),(1,2,7000),(1,3,1),(1,4,30000),(1,5,10),(2,1,10)"),
    "file_paths": ("id, path", "(1,'/data/terms/a.b.PDF'),(2,'c'),(3,'x/.hidden'),(4,CAST(NULL AS STRING))"),
    "merged_batch": ("id, warnings, conflict, conditions, exclusions", "(1,'w1,w2',true,'c2,c1','x'),(2,'',false,'c1',''),(3,'w1',CAST(NULL AS BOOLEAN),'',CAST(NULL AS STRING))"),
    "file_states": ("key, state, elapsed", "('a','done',2.0D),('b','done',4.0D),('c','failed',9.0D),('d','queued',CAST(NULL AS DOUBLE)),('e','running',1.0D),('f','queued',CAST(NULL AS DOUBLE))"),
    "present_files": ("key", "('a'),('z')"),
    "review_events": ("event_id, ts, key, event", "(1,10,'a','enqueue'),(2,11,'b','enqueue'),(3,12,'a','enqueue'),(4,13,'b','resolve'),(5,14,'c','enqueue'),(6,15,'b','enqueue'),(7,16,'d','enqueue'),(8,17,'d','resolve')"),
}
