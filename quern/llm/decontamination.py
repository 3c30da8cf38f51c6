"""Benchmark decontamination by exact word windows.

A window is WINDOW consecutive words of a benchmark item, or all words of an item with fewer. The windows' words become
numbers and the windows tuples of them, in a set that is broadcast after a check of its size; a document's runs of
benchmark words are scanned against it, so a hit is verified word by word. Items beyond the bound are taken in further
blocks, each scanned against all documents, and the hits of all blocks are merged.

Null texts have no words and are clean. Items without words have no window; a null item_id still marks words, but isn't
named. Repeated items count once, repeated documents alike, an empty table on either side gives clean documents or none.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, materialize, read_table, utf8_values, with_fields

WINDOW = 13
#: Characters of benchmark text up to which it is broadcast as one block; a larger one is cut into blocks of about half.
BLOCK_CHARS = 4_000_000
#: Words are runs of digits, letters and everything beyond ASCII; A-Z becomes a-z and any other byte a space.
WORD_BYTES = bytes(i + 32 if 65 <= i <= 90 else i if 48 <= i <= 57 or 97 <= i <= 122 or i >= 128 else 32 for i in range(256))


def words_of(text: bytes) -> list[bytes]:
    return text.translate(WORD_BYTES).split()


class WindowSet:
    """The windows of some items: word numbers, and for each window length a dict from window to the items that have it."""

    def __init__(self, items: list[tuple[int | None, bytes]], width: int = WINDOW):
        self.numbers: dict[bytes, int] = {}
        self.windows: dict[int, dict[tuple, set]] = defaultdict(lambda: defaultdict(set))
        for item_id, text in items:
            w = [self.numbers.setdefault(x, len(self.numbers)) for x in words_of(text)]
            n = min(width, len(w))
            for i in range(len(w) - n + 1 if n else 0):
                self.windows[n][tuple(w[i : i + n])].add(item_id)
        self.windows = {n: dict(x) for n, x in self.windows.items()}
        self.shortest = min(self.windows, default=0)

    def scan(self, text: bytes) -> tuple[int, list[tuple[int, int]], set]:
        """Number of words, the disjoint spans [start, end) of hit words, and the items found."""
        words = words_of(text)
        spans: list[tuple[int, int]] = []
        items: set = set()
        if not self.windows or len(words) < self.shortest:
            return len(words), spans, items
        numbers = list(map(self.numbers.get, words))
        start = 0
        while start < len(numbers):
            try:
                end = numbers.index(None, start)
            except ValueError:
                end = len(numbers)
            if end - start >= self.shortest:
                run = numbers[start:end]
                for n, known in self.windows.items():
                    for i in range(len(run) - n + 1):
                        if (found := known.get(tuple(run[i : i + n]))) is not None:
                            items |= found
                            spans.append((start + i, start + i + n))
            start = end + 1
        return len(words), merged(spans), items


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1] = (out[-1][0], max(e, out[-1][1]))
        else:
            out.append((s, e))
    return out


def blocks_of(benchmark: DataFrame, limit: int) -> list[DataFrame]:
    """The benchmark in parts, by a hash of the item, of about half `limit` characters each; one part if that holds all."""
    total = benchmark.agg(F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("n")).first()["n"]
    parts = -(-total // limit) if total else 1
    if parts == 1:
        return [benchmark]
    part = F.pmod(F.xxhash64("item_id", "text"), F.lit(2 * parts))
    return [benchmark.filter(part == i) for i in range(2 * parts)]


def find_contamination(documents: DataFrame, benchmark: DataFrame, block_chars: int = BLOCK_CHARS) -> DataFrame:
    """documents with n_words long, spans (hit words as disjoint [start, end) word positions), items (ids as strings, sorted, of the items with occurring windows), n_hit long and contaminated boolean (n_hit > 0 and 20 * n_hit >= n_words). Columns with these names are replaced."""
    spark = documents.sparkSession
    bounded_batches(spark, 512)
    documents = documents.drop("n_words", "spans", "items", "n_hit", "contaminated")
    blocks = blocks_of(benchmark.select("item_id", "text").distinct(), block_chars)
    if len(blocks) > 1:
        documents = materialize(documents.withColumn("__row", F.monotonically_increasing_id()), "decontamination")

    def against(block: DataFrame, frame: DataFrame) -> DataFrame:
        held = spark.sparkContext.broadcast(WindowSet([(r["item_id"], (r["text"] or "").encode()) for r in block.collect()]))

        def scanned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            known = held.value
            for batch in batches:
                found = [known.scan(t) for t in utf8_values(batch)]
                batch = batch.append_column("n_words", pa.array([x[0] for x in found], pa.int64()))
                batch = batch.append_column("spans", pa.array([[{"start": s, "end": e} for s, e in x[1]] for x in found], pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))))
                yield batch.append_column("items", pa.array([sorted(str(i) for i in x[2] if i is not None) for x in found], pa.list_(pa.string())))

        schema = with_fields(frame.schema, n_words="long", spans="array<struct<start:int,end:int>>", items="array<string>")
        return frame.mapInArrow(scanned, schema)

    if len(blocks) == 1:
        found = against(blocks[0], documents)
    else:
        hits = None
        for block in blocks:
            one = against(block, documents.select("__row", "text")).drop("text")
            hits = one if hits is None else hits.unionByName(one)
        hits = hits.groupBy("__row").agg(F.max("n_words").alias("n_words"), F.array_sort(F.flatten(F.collect_list("spans"))).alias("s"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
        hits = hits.withColumn("spans", F.expr("""aggregate(s, cast(array() as array<struct<start:int,end:int>>), (a, x) -> case
            when size(a) > 0 and element_at(a, -1).end >= x.start
            then concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'end', greatest(element_at(a, -1).end, x.end))))
            else concat(a, array(x)) end)""")).drop("s")  # fmt: skip
        found = documents.join(hits, "__row").drop("__row")
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda a, x: a + x["end"] - x["start"])
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = find_contamination(read_table(spark, sf_dir, "documents").select("doc_id", "text"), read_table(spark, sf_dir, "benchmark"))
    return found.select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated",
    )


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: the documents that are not contaminated, with their own columns."""
    return find_contamination(docs, read_table(spark, sf_dir, "benchmark")).filter(~F.col("contaminated")).select(*docs.columns)


def remove_spans(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    """documents with text rewritten: the words of hit spans are cut out, with what stands between them; the rest stays as it is."""
    found = find_contamination(documents, benchmark)
    word = "[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import re

        pattern = re.compile(word)
        for batch in batches:
            at = batch.schema.get_field_index("text")
            texts = []
            for text, spans in zip(batch.column(at).to_pylist(), batch.column("spans").to_pylist(), strict=True):
                if spans:
                    places = [m.span() for m in pattern.finditer(text)]
                    for s in reversed(spans):
                        text = text[: places[s["start"]][0]] + text[places[s["end"] - 1][1] :]
                texts.append(text)
            yield batch.set_column(at, batch.schema.field(at), pa.array(texts, batch.schema.field(at).type))

    return found.mapInArrow(cut, found.schema).select(*documents.columns)


ORACLE_SQL = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
b AS (SELECT DISTINCT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bw AS (SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i : i + least(13, len(w)) - 1], ' ') AS win FROM (SELECT *, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)),
n AS (SELECT DISTINCT n FROM bw),
dw AS (SELECT doc_id, i, n, array_to_string(w[i : i + n - 1], ' ') AS win FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, n WHERE len(w) >= n)),
h AS (SELECT DISTINCT dw.doc_id, dw.i, dw.n, bw.item_id FROM dw JOIN bw ON dw.win = bw.win AND dw.n = bw.n),
hit AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM h) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM h) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit, CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (doc_id) LEFT JOIN it USING (doc_id)
"""
