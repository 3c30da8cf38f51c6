"""Vectors as short codes: each of their parts as the number of the nearest entry of a codebook, found by VA-file filtering.

A vector is cut into equal parts with a codebook each. The coordinates of a codebook's entries are quantised to a few bits:
cells between marks with about as many entries each. For a query part, a table for each coordinate and cell holds the
least and the largest squared distance to any point of the cell; summed up by an entry's cells they bound its distance from
below and above. Entries whose lower bound isn't above the least upper bound are candidates; these get exact integer
distances, and the nearest wins, ties to the lower index. Tables are integers, so the bounds are exact.

Each round is one pass over the stored vectors: the codebooks, of a fixed size, go to the tasks, and a task sends one sum
for each entry it met. Nothing is shuffled by entry, so an entry that most parts are nearest to costs no task more.

Vectors that are null or have null or non-finite components are left out, as are those that can't be cut alike: with a
length other than the most frequent one (the smaller of equally frequent ones) among lengths of which `parts` is a divisor.
With fewer vectors than entries the codebooks are smaller; of equal ids the smaller integers come first, and null ids last;
repeated rows are vectors of their own; an empty table gives an empty result; extra columns stay unless named like a
result. Components that are so large that distances wouldn't fit a long are refused with an error.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import bounded_batches, fresh, materialize, read_table, release, with_fields
from quern.llm.integer_vectors import BATCH, finite, group_sums, moved, stored_integers, unpacked, with_group_totals

ENTRIES, PARTS, ROUNDS, SCALE = 256, 4, 4, 1024
#: Bits of a quantised coordinate; query parts that are bounded at once.
BITS, BLOCK = 4, 256


class Cells:
    """A codebook's entries with their cells."""

    def __init__(self, entries: np.ndarray):
        self.entries = entries
        # marks[j] to marks[j + 1] is cell j of a coordinate
        order = np.sort(entries, axis=0)
        at = np.linspace(0, len(entries) - 1, (1 << BITS) + 1).astype(int)
        self.marks = order[at]
        inner = self.marks[1:-1]
        self.cells = np.stack([np.searchsorted(inner[:, d], entries[:, d], side="right") for d in range(entries.shape[1])], axis=1)

    def nearest(self, q: np.ndarray, count: list | None = None) -> tuple[np.ndarray, np.ndarray]:
        """The nearest entry of each query part, and the squared distance. count: gets how many exact distances were made."""
        found, distance = np.zeros(len(q), np.int64), np.zeros(len(q), np.int64)
        for i in range(0, len(q), BLOCK):
            found[i : i + BLOCK], distance[i : i + BLOCK] = self.nearest_of_block(q[i : i + BLOCK], count)
        return found, distance

    def nearest_of_block(self, q: np.ndarray, count: list | None) -> tuple[np.ndarray, np.ndarray]:
        # by coordinate, query part and cell: how far the cell's nearest and farthest points are
        x = q.T[:, :, None]
        below, above = self.marks[:-1].T[:, None, :] - x, x - self.marks[1:].T[:, None, :]
        least = np.maximum(np.maximum(below, above), 0) ** 2
        most = np.maximum(np.abs(below), np.abs(above)) ** 2
        lower, upper, own = (np.zeros((len(q), len(self.entries)), np.int64) for _ in range(3))
        for d, cells in enumerate(self.cells.T):
            lower += np.take(least[d], cells, axis=1, out=own, mode="clip")
            upper += np.take(most[d], cells, axis=1, out=own, mode="clip")
        rows, entries = np.nonzero(lower <= upper.min(1)[:, None])
        table = np.full(lower.shape, np.iinfo(np.int64).max)
        for i in range(0, len(rows), 16 * BLOCK):
            r, e = rows[i : i + 16 * BLOCK], entries[i : i + 16 * BLOCK]
            table[r, e] = ((q[r] - self.entries[e]) ** 2).sum(1)
        if count is not None:
            count.append(len(rows))
        found = table.argmin(1)  # the first of equal ones
        return found, table[np.arange(len(q)), found]


def nearest_entries(v: np.ndarray, codebooks: list[Cells]) -> tuple[np.ndarray, np.ndarray]:
    """For each vector and part the nearest entry and the squared distance."""
    found = [c.nearest(p) for p, c in zip(np.split(v, len(codebooks), axis=1), codebooks, strict=True)]
    return np.stack([f for f, _ in found], axis=1), np.stack([d for _, d in found], axis=1)


def common_length(vectors: DataFrame, vector: str, parts: int) -> int:
    """The most frequent length that can be cut into parts; 0 without any."""
    n = F.size(vector).alias("n")
    row = vectors.groupBy(n).agg(F.count("*").alias("rows")).filter((F.col("n") > 0) & (F.col("n") % parts == 0)).orderBy(F.desc("rows"), "n").first()
    return row["n"] if row else 0


def add_codes(vectors: DataFrame, entries: int = ENTRIES, parts: int = PARTS, rounds: int = ROUNDS, scale: int = SCALE, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """The vectors that can be coded, stored, with code string (two hex digits a part) and error long, the squared distances of all parts, and the codebooks by part and entry. entries: 256 at most."""
    vectors = vectors.drop("code", "error")
    kept = vectors.filter(finite(vector))
    dim = common_length(kept, vector, parts)
    if not dim:
        empty = kept.filter(F.lit(False)).select(*vectors.columns, F.lit("").alias("code"), F.lit(0).cast("long").alias("error"))
        return empty, np.zeros((parts, 0, 0), np.int64)
    packed, width = fresh(vectors, "packed"), dim // parts
    stored = stored_integers(kept.filter(F.size(vector) == dim), vector, dim, scale, packed)
    bounded_batches(vectors.sparkSession, BATCH)
    by_components = F.col(vector)
    rows = stored.select(packed).orderBy(F.col(vec_id).asc_nulls_last(), by_components).limit(entries).collect()
    first = np.array([np.frombuffer(bytes(r[0]), np.int64) for r in rows])
    books = np.stack(np.split(first, parts, axis=1))
    size = books.shape[1]
    for _ in range(rounds):
        cells = [Cells(b) for b in books]
        groups = lambda v, c=cells: (nearest_entries(v, c)[0] + size * np.arange(parts)).ravel()
        books = moved(books.reshape(-1, width), group_sums(stored, packed, dim, width, parts * size, groups)).reshape(books.shape)
    final, names = [Cells(b) for b in books], [*vectors.columns, "code", "error"]

    def coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(packed)
            found, distance = nearest_entries(unpacked(batch.column(at), dim), final)
            codes = pa.array([bytes(x).hex() for x in found.astype(np.uint8)], pa.string())
            yield pa.record_batch([*(x for i, x in enumerate(batch.columns) if i != at), codes, pa.array(distance.sum(1))], names)
        release()

    return materialize(stored.mapInArrow(coded, with_fields(vectors.schema, code="string", error="long")), "codes"), books


def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded, books = add_codes(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label"))
    digest = hashlib.sha256(",".join(map(str, books.ravel().tolist())).encode()).hexdigest()
    out = with_group_totals(coded.select("vec_id", "label", "code", "error"), "label", "error", "label_error")
    return out.select("vec_id", "code", "error", "label_error", F.lit(digest).alias("codebooks_sha256"))


def oracle_sql() -> str:
    """The rounds one after another; distances in doubles, exact below 2^53."""
    near = lambda c: f"SELECT vec_id, label, p, v, k, d FROM (SELECT vec_id, label, p, v, k, list_dot_product(list_transform(list_zip(v, c), lambda z: z[1] - z[2]), list_transform(list_zip(v, c), lambda z: z[1] - z[2])) AS d, row_number() OVER (PARTITION BY vec_id, p ORDER BY d, k) AS r FROM e JOIN {c} USING (p)) WHERE r = 1"
    parts = [
        f"i AS (SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"e AS MATERIALIZED (SELECT vec_id, label, p, v[p * len(v) // {PARTS} + 1 : (p + 1) * len(v) // {PARTS}] AS v FROM i, range({PARTS}) t(p))",
        f"c0 AS MATERIALIZED (SELECT p, k, v AS c FROM (SELECT p, row_number() OVER (PARTITION BY p ORDER BY vec_id) - 1 AS k, v FROM e) WHERE k < {ENTRIES})",
    ]
    for i in range(ROUNDS):
        parts.append(f"m{i} AS (SELECT p, k, list(s ORDER BY j) AS c FROM (SELECT p, k, j, floor(sum(x) / count(*)) AS s FROM (SELECT p, k, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM ({near(f'c{i}')})) GROUP BY p, k, j) GROUP BY p, k)")
        parts.append(f"c{i + 1} AS MATERIALIZED (SELECT p, k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (p, k))")
    last = f"c{ROUNDS}"
    return f"""WITH {', '.join(parts)}, a AS MATERIALIZED (SELECT vec_id, label, string_agg(printf('%02x', k::INTEGER), '' ORDER BY p) AS code, CAST(sum(d) AS BIGINT) AS error FROM ({near(last)}) GROUP BY vec_id, label),
h AS (SELECT sha256(string_agg(array_to_string(list_transform(c, lambda x: x::BIGINT), ','), ',' ORDER BY p, k)) AS codebooks_sha256 FROM {last})
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256 FROM a, h"""


ORACLE_SQL = oracle_sql()
