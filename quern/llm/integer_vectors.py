"""Vectors as integers, cut into parts: what the vector operators share."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, fresh, materialize, release, with_fields

#: Rows of one Arrow batch: what a task holds of the bounds of each vector against each centroid or entry.
BATCH = 2048


def finite(vector: str) -> Column:
    """The vector is not null, and none of its components is null, infinite or not a number."""
    good = F.forall(F.col(vector), lambda x: x.isNotNull() & ~F.isnan(x.cast("double")) & (F.abs(x.cast("double")) != float("inf")))
    return F.coalesce(F.col(vector).isNotNull() & good, F.lit(False))


def integers(column: pa.Array, dim: int, scale: int) -> np.ndarray:
    """floor(scale * x) of all components, x as a double, exact. Components whose squared distances may pass a long are refused."""
    flat = pa.concat_arrays(column.chunks) if isinstance(column, pa.ChunkedArray) else column
    values = np.floor(flat.flatten().to_numpy(zero_copy_only=False).astype(np.float64) * scale).reshape(-1, dim)
    most = math.isqrt(2**62 // (4 * dim))
    if values.size and np.abs(values).max() > most:
        raise ValueError(f"a component of {np.abs(values).max():g} after scaling: squared distances of components above {most} do not fit a long")
    return values.astype(np.int64)


def stored_integers(vectors: DataFrame, vector: str, dim: int, scale: int, name: str) -> DataFrame:
    """vectors, written to the shared folder, with a column `name` of their integers as little-endian 64-bit numbers."""
    bounded_batches(vectors.sparkSession, BATCH)

    def added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            v = integers(batch.column(batch.schema.get_field_index(vector)), dim, scale)
            yield batch.append_column(name, pa.array([x.tobytes() for x in v], pa.binary()))
        release()

    return materialize(vectors.mapInArrow(added, with_fields(vectors.schema, **{name: "binary"})), "vectors")


def unpacked(column: pa.Array, dim: int) -> np.ndarray:
    """Stored integers as rows of dim."""
    return np.frombuffer(b"".join(column.to_pylist()), np.int64).reshape(-1, dim)


def group_sums(stored: DataFrame, name: str, dim: int, width: int, groups: int, groups_of: Callable[[np.ndarray], np.ndarray]) -> dict[int, tuple[int, list[int]]]:
    """Of each group that the parts of vectors are put in: how many there are, and the sums of their components. A vector of dim components has parts of `width`; groups_of: from vectors to a group number below `groups` for each part, vector by vector. A task sends one row for each group it met, however many vectors it has."""

    def summed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = np.zeros(groups, np.int64), np.zeros((groups, width), np.int64)
        for batch in batches:
            v = unpacked(batch.column(0), dim)
            g = groups_of(v)
            n += np.bincount(g, minlength=groups)
            np.add.at(sums, g, v.reshape(-1, width))
        met = np.flatnonzero(n)
        yield pa.record_batch([pa.array(met.astype(np.int32)), pa.array(n[met]), pa.array(sums[met].tolist(), pa.list_(pa.int64()))], ["g", "n", "sums"])
        release()

    parts = stored.select(name).mapInArrow(summed, "g int, n long, sums array<long>")
    wide = lambda c: c.cast("decimal(38,0)")
    rows = parts.groupBy("g").agg(F.sum("n").alias("n"), *(F.sum(wide(F.col("sums")[i])).alias(f"s{i}") for i in range(width))).collect()
    return {r["g"]: (r["n"], [int(r[f"s{i}"]) for i in range(width)]) for r in rows}


def moved(old: np.ndarray, sums: dict[int, tuple[int, list[int]]]) -> np.ndarray:
    """Each group's floor of the mean, componentwise; empty groups stay where they were."""
    new = old.copy()
    for g, (n, s) in sums.items():
        new[g] = [x // n for x in s]
    return new


def with_group_totals(scored: DataFrame, key: str, value: str, name: str, most: int = 100_000) -> DataFrame:
    """scored, a stored table, with the sum of `value` over all rows of an equal key (nulls together) as `name`. The sums are joined by broadcast when there are at most `most`; beyond that the rows are salted, so that a key with many rows meets its sum in several tasks."""
    total, salt = fresh(scored, "total_key"), fresh(scored, "salt")
    sums = materialize(scored.groupBy(F.col(key).alias(total)).agg(F.sum(value).alias(name)), "totals")
    if sums.count() <= most:
        return scored.join(F.broadcast(sums), F.col(key).eqNullSafe(F.col(total)), "left").drop(total)
    ways = 16
    salted = sums.withColumn(salt, F.explode(F.sequence(F.lit(0), F.lit(ways - 1))))
    rows = scored.withColumn(salt, F.pmod(F.monotonically_increasing_id(), F.lit(ways)).cast("int"))
    return rows.join(salted, [F.col(key).eqNullSafe(F.col(total)), rows[salt] == salted[salt]], "left").drop(total, salted[salt]).drop(salt)
