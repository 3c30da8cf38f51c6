"""Helpers shared by the training-data operators."""

from __future__ import annotations

import ctypes
import gc
import tempfile
import uuid
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Bytes that separate words: space and \t \n \v \f \r, the set bytes.split() uses.
ASCII_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def shared_dir(spark: SparkSession, name: str) -> str:
    """A new folder name below spark.checkpoint.dir, which the driver and every executor share."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:  # a single machine, as in tests
        root = "file://" + tempfile.mkdtemp(prefix="quern-")
        spark.conf.set("spark.checkpoint.dir", root)
    return f"{root.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts lineage, survives lost executors."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, name)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_batches(spark: SparkSession, rows: int = 256) -> None:
    """Hold what is read at once, and what one Arrow batch carries to Python workers, to a number of rows, as texts may be long: the defaults of thousands of rows make buffers of tens of megabytes a task."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(rows))
    spark.conf.set("spark.sql.parquet.columnarReaderBatchSize", str(rows))


def fresh(df: DataFrame, name: str) -> str:
    """A name for a helper column that no column of df has, in whatever case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def id_crc32(column: str | Column) -> Column:
    """crc32 of an id as text; a null id counts as empty text."""
    return F.crc32(F.coalesce(F.col(column).cast("string") if isinstance(column, str) else column.cast("string"), F.lit("")))


def utf8_values(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of a batch as UTF-8 bytes; null counts as empty."""
    column = batch.column(batch.schema.get_field_index(name))
    return [x or b"" for x in pc.cast(column, pa.binary() if not pa.types.is_large_string(column.type) else pa.large_binary()).to_pylist()]


def release() -> None:
    """Give memory that a task no longer needs back to the system, as the worker that ran it stays for the next one."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    if hasattr(libc := ctypes.CDLL(None), "malloc_trim"):
        libc.malloc_trim(0)


def in_chunks(values: list, n: int) -> Iterator[list]:
    for i in range(0, len(values), n):
        yield values[i : i + n]


def with_fields(schema: T.StructType, **kinds: str) -> T.StructType:
    """A new schema: that one with further fields, given as name=type in Spark's notation."""
    out = T.StructType(list(schema.fields))
    for name, kind in kinds.items():
        out.add(name, T.DataType.fromDDL(kind))
    return out
