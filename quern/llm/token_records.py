"""Token ids as length-delimited binary records, with a separate offset index.

Shard files hold the documents in ascending order of doc_id. A record is

    length of the payload, uint64 | masked crc32 of those 8 bytes, uint32 | payload | masked crc32 of the payload, uint32

all little-endian; the payload is the doc_id as int64, a byte that is 1 if the doc_id is null, a byte with the width of an
id (2 or 4), and the ids as unsigned integers. A masked checksum is the crc32 turned right by 15 bits plus 0xA282EAD8. The
index, a Parquet table, has doc_id, shard, position in the shard, offset, length and n_tokens of every record, so that a
reader can fetch records in any order.

Null texts count as empty: only the end id. Documents with one doc_id stand in the order of their text's hash; null ids
come first. An empty table gives no shard, an empty index and an empty result. Extra columns aren't stored.
"""

from __future__ import annotations

import os
import struct
import uuid
import zlib
from collections.abc import Iterator
from itertools import chain

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, in_chunks, read_table, shared_dir
from quern.llm.piece_cache import PieceCache

VOCABULARY, END_ID = "word_bpe_49k.json", 2
#: Bytes of words and tokens that a worker remembers in either of two generations.
REMEMBERED = 150 << 20
INDEX = "doc_id long, shard int, position int, offset long, length long, n_tokens long"
READ = "doc_id long, shard int, position int, start long, n_tokens long, ids_crc32 long"


def masked(data: bytes) -> int:
    c = zlib.crc32(data)
    return ((c >> 15 | c << 17) + 0xA282EAD8) & 0xFFFFFFFF


def framed(payload: bytes) -> bytes:
    size = struct.pack("<Q", len(payload))
    return b"".join((size, struct.pack("<I", masked(size)), payload, struct.pack("<I", masked(payload))))


def payload_of(doc_id: int | None, ids: np.ndarray, width: int) -> bytes:
    return struct.pack("<qBB", doc_id or 0, doc_id is None, width) + ids.astype(f"<u{width}").tobytes()


def parsed(payload: bytes) -> tuple[int | None, np.ndarray]:
    doc_id, null, width = struct.unpack_from("<qBB", payload)
    return None if null else doc_id, np.frombuffer(payload, f"<u{width}", offset=10).astype("<u4")


def read_record(stream) -> bytes | None:
    """The next payload of a stream, its checksums verified; None at the end."""
    head = stream.read(12)
    if not head:
        return None
    size, check = struct.unpack("<QI", head)
    if masked(head[:8]) != check:
        raise ValueError("damaged length")
    payload, check = stream.read(size), struct.unpack("<I", stream.read(4))[0]
    if masked(payload) != check:
        raise ValueError("damaged payload")
    return payload


class Encoder:
    """The tokenizer, with a cache by what stands between white space: this vocabulary's tokens never span white space."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.width = 2 if self.tokenizer.get_vocab_size() <= 1 << 16 else 4
        self.cache = PieceCache(self.learn, REMEMBERED)

    def learn(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        ids: list[list[int]] = []
        sizes: list[np.ndarray] = []
        for some in in_chunks(words, 500):
            e = self.tokenizer.encode(some, is_pretokenized=True, add_special_tokens=False)
            if None in (of := e.word_ids):  # a special token has no word
                each = [x.ids for x in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
                ids += each
                sizes.append(np.array([len(x) for x in each]))
            else:
                ids.append(e.ids)
                sizes.append(np.bincount(np.array(of, dtype=np.int64), minlength=len(some)))
        n = np.concatenate(sizes)
        return np.fromiter(chain.from_iterable(ids), np.uint32, n.sum()), n

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        # the tokenizer lower-cases all but special tokens, which begin with <|: doing so before finds more words in the cache
        texts = pc.fill_null(texts, "")
        lowered = pc.if_else(pc.match_substring(texts, "<|"), texts, pc.ascii_lower(texts))
        return self.cache.encode(pc.ascii_split_whitespace(lowered))


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def shard_path(folder: str, shard: int) -> str:
    return f"{folder}/part-{shard:06d}.records"


def write_records(documents: DataFrame, folder: str, path: str | None = None, end_id: int = END_ID) -> DataFrame:
    """Write documents (doc_id, text) to shard files below folder, a URI that all executors reach, and the index to folder/index; return the index. A shard is written under another name and then moved, so a repeated task replaces it whole."""
    spark = documents.sparkSession
    bounded_batches(spark, 512)
    path = path or public_tokenizers.path(VOCABULARY)

    def written(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shard = TaskContext.get().partitionId()
        store, root = fs.FileSystem.from_uri(folder)
        out, name, offset, position = None, f"{root}/.{shard}-{uuid.uuid4().hex}", 0, 0
        e = encoder(path)
        for batch in batches:
            if not batch.num_rows:
                continue
            if out is None:
                store.create_dir(root, recursive=True)
                out = store.open_output_stream(name)
            ids, bounds = e.encode(batch.column(1))
            rows = []
            for i, doc_id in enumerate(batch.column(0).to_pylist()):
                own = np.append(ids[bounds[i] : bounds[i + 1]], np.uint32(end_id))
                record = framed(payload_of(doc_id, own, e.width))
                out.write(record)
                rows.append((doc_id, shard, position, offset, len(record), len(own)))
                offset, position = offset + len(record), position + 1
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)], ["doc_id", "shard", "position", "offset", "length", "n_tokens"])
        if out is not None:
            out.close()
            store.move(name, shard_path(root, shard))

    order = ["doc_id", F.xxhash64("text")]
    ranged = documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text").repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.mapInArrow(written, INDEX).write.parquet(f"{folder}/index")
    return spark.read.schema(INDEX).parquet(f"{folder}/index")


def read_records(index: DataFrame, folder: str) -> DataFrame:
    """Read all shards that the index names, in streams: doc_id, shard, position, start (ids of all documents before it), n_tokens and ids_crc32 of every record."""
    spark = index.sparkSession
    totals = index.groupBy("shard").agg(F.sum("n_tokens").alias("n")).orderBy("shard").collect()  # one row a file
    before, shards = 0, []
    for r in totals:
        shards.append((r["shard"], before))
        before += r["n"]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        for batch in batches:
            for shard, start in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows: list[tuple] = []
                with store.open_input_stream(shard_path(root, shard), buffer_size=1 << 20) as stream:
                    position = 0
                    while (payload := read_record(stream)) is not None:
                        doc_id, ids = parsed(payload)
                        rows.append((doc_id, shard, position, start, len(ids), zlib.crc32(ids.tobytes())))
                        start, position = start + len(ids), position + 1
                        if len(rows) == 10_000:
                            yield batch_of(rows)
                            rows = []
                if rows:
                    yield batch_of(rows)

    def batch_of(rows: list[tuple]) -> pa.RecordBatch:
        kinds = (pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], ["doc_id", "shard", "position", "start", "n_tokens", "ids_crc32"])

    tasks = spark.createDataFrame(shards, "shard int, start long").repartition(max(1, len(shards)))
    return tasks.mapInArrow(read, READ)


def fetch(index: DataFrame, folder: str) -> DataFrame:
    """The records of the index rows given, in their order within each partition, found by offset: doc_id, ids array<long>. This is the shuffled read."""

    def fetched(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = fs.FileSystem.from_uri(folder)
        files: dict[int, object] = {}
        for batch in batches:
            out = []
            for shard, offset in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                if shard not in files:
                    if len(files) >= 64:
                        files.pop(next(iter(files))).close()
                    files[shard] = store.open_input_file(shard_path(root, shard))
                files[shard].seek(offset)
                out.append(parsed(read_record(files[shard])))
            yield pa.RecordBatch.from_arrays([pa.array([x[0] for x in out], pa.int64()), pa.array([x[1].astype(np.int64) for x in out], pa.list_(pa.int64()))], ["doc_id", "ids"])

    return index.select("shard", "offset").mapInArrow(fetched, "doc_id long, ids array<long>")


def op3_token_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = shared_dir(spark, "token-records")
    index = write_records(read_table(spark, sf_dir, "documents"), folder)
    return read_records(index, folder).select("doc_id", "start", "n_tokens", "ids_crc32")
