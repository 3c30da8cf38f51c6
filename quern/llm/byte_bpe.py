"""Byte-level BPE by recursive DuckDB queries inside the partitions.

Spark cuts each text into pieces with the tokenizer's pattern. In a task, the distinct pieces that are no token as they
stand become rows (word, position, token); a recursive query joins neighbours with the merge table and contracts in every
word its leftmost pair of least rank, until no word has a pair left. Decoding joins token rows with the vocabulary and
aggregates them in order of position.

Null texts count as empty and have no tokens. Repeated rows are each encoded; an empty table gives an empty result; extra
columns stay unless named like a result.

A long piece is first cut where two bytes meet that stand side by side in no token, as no contraction can span that place.
What is still long would have too many rounds of one contraction each; there a round contracts all places of the least
rank at once, from the left up to the first where that makes a pair of a lesser rank, which gives the same tokens.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import duckdb
import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, read_table, release, with_fields
from quern.llm.piece_cache import PieceCache

VOCABULARY = "byte_bpe_multi_50k.tiktoken"
#: Bytes of a piece above which it is cut, and of a cut part above which a round contracts more than one place.
LONG_PIECE, LONG_PART = 128, 1024
#: Bytes of parts that a query contracts at once, and rounds of a query on a long part: what it holds grows with both.
AT_ONCE, ROUNDS = 160_000, 4
#: Bytes of pieces and tokens that a worker remembers in either of two generations.
REMEMBERED = 64 << 20
LONG_MEMORY_MB = 800
#: The characters that \s stands for in the pattern: Unicode's White_Space.
WHITE = r"\t\n\x0B\f\r\x20\x85\xA0  -     　"

#: Positions of a word are 0, 1, 2, ...; a contraction moves those after it down by one. 2048 is above every position.
ENCODE = """
WITH RECURSIVE step(w, pos, tok, active) AS (
    SELECT w, pos, tok, true FROM start
    UNION ALL (
        WITH s AS (SELECT w, pos, tok FROM step WHERE active),
        best AS (
            SELECT a.w, min(merged::BIGINT * 2048 + a.pos) AS least
            FROM s AS a JOIN s AS b ON a.w = b.w AND b.pos = a.pos + 1 JOIN merges ON a.tok = l AND b.tok = r GROUP BY a.w
        )
        SELECT s.w, CASE WHEN pos > least % 2048 THEN pos - 1 ELSE pos END::INT,
            CASE WHEN pos = least % 2048 THEN (least // 2048)::INT ELSE tok END, least IS NOT NULL
        FROM s LEFT JOIN best ON s.w = best.w WHERE least IS NULL OR pos <> least % 2048 + 1
    )
)
SELECT w, list(tok ORDER BY pos) AS ids FROM step WHERE NOT active GROUP BY w ORDER BY w
"""
#: For long parts: `again` are the pairs of a word's least rank, of which every other one of a run side by side can be
#: contracted, from the left, up to the first place where that makes a pair of a lesser rank.
ENCODE_LONG = """
WITH RECURSIVE step(w, pos, tok, active, round) AS (
    SELECT w, pos, tok, true, 0 FROM start
    UNION ALL (
        WITH s AS (
            SELECT w, pos, tok, round, row_number() OVER o AS i, lag(tok) OVER o AS before, lead(tok) OVER o AS after, lead(tok, 2) OVER o AS next
            FROM step WHERE active AND round < {rounds} WINDOW o AS (PARTITION BY w ORDER BY pos)
        ),
        paired AS (SELECT s.*, min(merged) OVER (PARTITION BY w) AS least, merged = least AS again FROM s LEFT JOIN merges ON tok = l AND after = r),
        runs AS (SELECT w, i, before, next, least, i - row_number() OVER (PARTITION BY w ORDER BY i) AS run FROM paired WHERE again),
        every_other AS (SELECT * FROM runs QUALIFY row_number() OVER (PARTITION BY w, run ORDER BY i) % 2 = 1),
        beside AS (SELECT w, i, least, next, CASE WHEN lag(i) OVER (PARTITION BY w ORDER BY i) = i - 2 THEN least ELSE before END AS before FROM every_other),
        lesser AS (
            SELECT e.w, min(e.i) AS i FROM beside AS e
            LEFT JOIN merges AS a ON a.l = e.before AND a.r = least LEFT JOIN merges AS b ON b.l = least AND b.r = e.next
            WHERE a.merged < least OR b.merged < least GROUP BY e.w
        ),
        chosen AS (SELECT e.w, e.i FROM every_other AS e LEFT JOIN lesser ON e.w = lesser.w WHERE lesser.i IS NULL OR e.i <= lesser.i)
        SELECT p.w, p.pos, CASE WHEN c.i IS NULL THEN p.tok ELSE p.least END::INT, p.least IS NOT NULL, p.round + 1
        FROM paired AS p LEFT JOIN chosen AS c ON p.w = c.w AND p.i = c.i LEFT JOIN chosen AS d ON p.w = d.w AND p.i = d.i + 1 WHERE d.i IS NULL
    )
)
SELECT w, pos, tok, active FROM step WHERE NOT active OR round = {rounds} ORDER BY w, pos
"""
DECODE = "SELECT d, string_agg(hex, '' ORDER BY pos) AS hex FROM tokens JOIN vocabulary USING (tok) GROUP BY d"


def spark_pattern() -> str:
    """The tokenizer's pattern for Spark's regular expressions."""
    p = public_tokenizers.PATTERN
    return p.replace(r"[^\s", f"[^{WHITE}").replace(r"\s", f"[{WHITE}]").replace(r"(?!\S)", f"(?![^{WHITE}])")


def pieces(text: str | Column = "text") -> Column:
    return F.regexp_extract_all(F.coalesce(F.col(text) if isinstance(text, str) else text, F.lit("")), F.lit(spark_pattern()), F.lit(0))


def ranks_of(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class Codec:
    """One vocabulary in an in-memory DuckDB, with the pieces met so far."""

    def __init__(self, path: str):
        self.ranks = ranks_of(path)
        self.bytes = np.array([self.ranks[bytes([i])] for i in range(256)], dtype=np.int32)
        left, right, merged = array("i"), array("i"), array("i")
        self.adjacent = np.zeros((256, 256), bool)
        for token, rank in self.ranks.items():
            octets = np.frombuffer(token, np.uint8)
            self.adjacent[octets[:-1], octets[1:]] = True
            for i in range(1, len(token)):
                a, b = self.ranks.get(token[:i]), self.ranks.get(token[i:])
                if a is not None and b is not None:
                    left.append(a)
                    right.append(b)
                    merged.append(rank)
        self.db = duckdb.connect(config={"threads": 1, "memory_limit": "80MB"})
        self.db.execute("CREATE TABLE merges (l INT, r INT, merged INT)")
        self._load("merges", {"l": left, "r": right, "merged": merged})
        self.db.execute("CREATE TABLE vocabulary (tok INT, hex VARCHAR)")
        self._load("vocabulary", {"tok": list(self.ranks.values()), "hex": [t.hex() for t in self.ranks]})
        self.cache = PieceCache(self.learn, REMEMBERED)

    def _load(self, table: str, columns: dict) -> None:
        rows = pa.table({k: pa.array(v, pa.string() if k == "hex" else pa.int32()) for k, v in columns.items()})
        self.db.register("loading", rows)
        self.db.execute(f"INSERT INTO {table} SELECT * FROM loading")
        self.db.unregister("loading")

    def _positions(self, words: list[bytes]) -> pa.Table:
        """w, pos, tok: every byte of the words as a token in its place."""
        sizes = np.array([len(x) for x in words])
        pos = np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)
        w = np.repeat(np.arange(len(words), dtype=np.int32), sizes)
        return pa.table({"w": w, "pos": pos.astype(np.int32), "tok": self.bytes[np.frombuffer(b"".join(words), np.uint8)]})

    def _contracted(self, words: list[bytes]) -> list[np.ndarray]:
        """The tokens of each word, none of them long."""
        self.db.register("start", self._positions(words))
        ids = self.db.sql(ENCODE).to_arrow_table()["ids"].combine_chunks()
        self.db.unregister("start")
        ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype(np.uint32)
        return [flat[a:b] for a, b in zip(ends[:-1], ends[1:], strict=True)]

    def _contracted_long(self, word: bytes) -> np.ndarray:
        """The tokens of one long word: a few rounds a query, until no pair is left."""
        rows = self._positions([word])
        self.db.execute(f"SET memory_limit = '{LONG_MEMORY_MB}MB'")
        while True:
            self.db.register("start", rows)
            rows = self.db.sql(ENCODE_LONG.format(rounds=ROUNDS)).to_arrow_table()
            self.db.unregister("start")
            if not pc.any(rows["active"]).as_py():
                self.db.execute("SET memory_limit = '80MB'")
                return rows["tok"].to_numpy().astype(np.uint32)
            rows = rows.select(["w", "pos", "tok"])

    def _cut(self, piece: bytes) -> list[bytes]:
        """The piece cut where no token spans."""
        if len(piece) <= LONG_PIECE:
            return [piece]
        octets = np.frombuffer(piece, np.uint8)
        at = np.flatnonzero(~self.adjacent[octets[:-1], octets[1:]]) + 1
        return [piece[a:b] for a, b in zip([0, *at.tolist()], [*at.tolist(), len(piece)], strict=True)]

    def learn(self, pieces: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """All ids of the pieces, one after another, and how many each has."""
        out: list[list[np.ndarray]] = [[] for _ in pieces]
        held: list[tuple[int, int, bytes]] = []

        def contract() -> None:
            for (i, k, _), ids in zip(held, self._contracted([x for _, _, x in held]), strict=True):
                out[i][k] = ids
            held.clear()

        size = 0
        for i, piece in enumerate(pieces):
            data = piece.encode()
            if (rank := self.ranks.get(data)) is not None:
                out[i].append(np.array([rank], dtype=np.uint32))
                continue
            for k, part in enumerate(self._cut(data)):
                out[i].append(self._contracted_long(part) if len(part) > LONG_PART else part)
                if len(part) <= LONG_PART:
                    held.append((i, k, part))
                    size += len(part)
                    if size >= AT_ONCE:
                        contract()
                        size = 0
        if held:
            contract()
        return np.concatenate([x for parts in out for x in parts]), np.array([sum(map(len, parts)) for parts in out])

    def encode(self, texts: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Of texts as lists of pieces: all token ids, and where each text's begin, with the end of the last."""
        return self.cache.encode(texts)

    def decode(self, ids: np.ndarray, bounds: np.ndarray) -> list[bytes]:
        """The bytes of each sequence ids[bounds[i]:bounds[i+1]]. Unknown ids raise an error."""
        n = np.diff(bounds)
        if len(ids) and int(ids.max()) >= len(self.ranks):
            raise ValueError(f"no token {int(ids.max())}")
        tokens = pa.table({"d": np.repeat(np.arange(len(n)), n), "pos": np.arange(len(ids)), "tok": ids.astype(np.int32)})
        self.db.register("tokens", tokens)
        found = self.db.sql(DECODE).to_arrow_table()
        self.db.unregister("tokens")
        out = [b""] * len(n)
        for d, hexed in zip(found["d"].to_pylist(), found["hex"].to_pylist(), strict=True):
            out[d] = bytes.fromhex(hexed)
        return out


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """The worker's codec of a vocabulary file, kept from task to task."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def encode(documents: DataFrame, path: str | None = None) -> DataFrame:
    """documents (text) with token_ids array<int>. path: a vocabulary file that every executor has."""
    bounded_batches(documents.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    documents = documents.drop("token_ids")

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index("__pieces")
            ids, bounds = codec(path).encode(batch.column(at))
            yield batch.remove_column(at).append_column("token_ids", pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids, pa.uint32()).view(pa.int32())))
        release()

    return documents.withColumn("__pieces", pieces()).mapInArrow(encoded, with_fields(documents.schema, token_ids="array<int>"))


def decode(sequences: DataFrame, path: str | None = None) -> DataFrame:
    """sequences (token_ids array<int>, null: none) with decoded binary. Ids outside the vocabulary raise an error."""
    path = path or public_tokenizers.path(VOCABULARY)
    sequences = sequences.drop("decoded")

    def decoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = pc.fill_null(batch.column(batch.schema.get_field_index("token_ids")), [])
            bounds = ids.offsets.to_numpy()
            yield batch.append_column("decoded", pa.array(codec(path).decode(ids.values.to_numpy(zero_copy_only=False)[bounds[0] : bounds[-1]], bounds - bounds[0]), pa.binary()))

    return sequences.mapInArrow(decoded, with_fields(sequences.schema, decoded="binary"))


def digest(sequences: DataFrame) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 (of little-endian unsigned 32-bit ids) and decoded_sha256 of encoded and decoded documents."""

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column(batch.schema.get_field_index("token_ids"))
            ends, flat = ids.offsets.to_numpy(), ids.values.to_numpy().astype("<u4")
            sums = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(ends[:-1], ends[1:], strict=True)]
            plain = [hashlib.sha256(x).hexdigest() for x in batch.column(batch.schema.get_field_index("decoded")).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(batch.schema.get_field_index("doc_id")), pa.array(np.diff(ends), pa.int64()), pa.array(sums), pa.array(plain)], ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"])

    return sequences.mapInArrow(digested, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def digests(documents: DataFrame, path: str | None = None) -> DataFrame:
    """As digest(decode(encode(documents))), in one pass: a task holds one Python worker with one codec, where three steps would hold three."""
    bounded_batches(documents.sparkSession)
    path = path or public_tokenizers.path(VOCABULARY)
    names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]

    def digested(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, bounds = codec(path).encode(batch.column(1))
            flat = ids.astype("<u4")
            sums = [hashlib.sha256(flat[a:b].tobytes()).hexdigest() for a, b in zip(bounds[:-1], bounds[1:], strict=True)]
            plain = [hashlib.sha256(x).hexdigest() for x in codec(path).decode(ids, bounds)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(np.diff(bounds), pa.int64()), pa.array(sums), pa.array(plain)], names)
        release()

    return documents.select("doc_id", pieces().alias("pieces")).mapInArrow(digested, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def op7_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return digests(read_table(spark, sf_dir, "documents"))


def token_digests(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage, the last: each document's id, token count and the digests of its tokens and of what they decode to."""
    return digests(docs)
