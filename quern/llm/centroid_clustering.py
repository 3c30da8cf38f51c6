"""Clustering around centroids in integers, with most distances screened by block norms.

A vector is cut into segments whose Euclidean norms are stored beside it: a compressed vector. By Cauchy-Schwarz, the sum
over segments of squared differences of norms is at most the squared distance to a centroid, whose norms come with it. Of
each vector the centroid with the least such bound gets an exact integer distance; then only those whose bound isn't above
it do, and the nearest wins, ties to the smaller number. Norms are rounded, so bounds are lowered by more than that can be.

Each round is one pass over the stored vectors: the centroids, a fixed number, go to the tasks, and a task sends one sum a
centroid. Nothing is shuffled by cluster, so that a cluster with most vectors costs no task more.

Vectors that are null, of another length, or with null or non-finite components are left out; with fewer vectors than
centroids each one starts a centroid; ties and repeated rows are vectors of their own, and null ids count as the text
"null"; an empty table gives an empty result; extra columns stay unless named like a result. Components above 2^27 after
scaling are refused with an error, as distances wouldn't fit a long.
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

CENTROIDS, ROUNDS, DIM, SCALE, SEED = 40, 5, 64, 256, 2
SEGMENTS = 8
#: What bounds are lowered by: relative to the squared norms they come from, and at least.
SLACK = 1e-9


def segment_norms(v: np.ndarray) -> np.ndarray:
    """The norm of each of SEGMENTS segments of each row: segments differ by one component at most."""
    squares = (v.astype(np.float64) ** 2).T
    return np.sqrt(np.array([s.sum(0) for s in np.array_split(squares, min(SEGMENTS, len(squares)))])).T


def lower_bounds(norms: np.ndarray, of_centroids: np.ndarray) -> np.ndarray:
    """For each vector and centroid a number no larger than their squared distance."""
    a, b = (norms**2).sum(1)[:, None], (of_centroids**2).sum(1)[None, :]
    return a + b - 2 * norms @ of_centroids.T - SLACK * (a + b + 1)


def nearest(v: np.ndarray, norms: np.ndarray, centroids: np.ndarray, count: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """The nearest centroid of each vector, and the squared distance. count: gets how many exact distances were made."""
    bounds = lower_bounds(norms, segment_norms(centroids))
    first = bounds.argmin(1)
    exact = lambda i, c: ((v[i] - centroids[c]) ** 2).sum(1)
    best = exact(np.arange(len(v)), first)
    rows, others = np.nonzero(bounds <= best[:, None])
    table = np.full(bounds.shape, np.iinfo(np.int64).max)
    table[np.arange(len(v)), first] = best
    fresh_pairs = others != first[rows]
    rows, others = rows[fresh_pairs], others[fresh_pairs]
    for i in range(0, len(rows), 4 * BATCH):
        r, c = rows[i : i + 4 * BATCH], others[i : i + 4 * BATCH]
        table[r, c] = exact(r, c)
    if count is not None:
        count.append(len(v) + len(rows))
    found = table.argmin(1)  # the first of equal ones
    return found, table[np.arange(len(v)), found]


def first_centroids(stored: DataFrame, vec_id: str, packed: str, n: int, seed: int) -> np.ndarray:
    """The n vectors whose ids have the smallest digests, in that order; of equal ids the smaller bytes come first."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(vec_id).cast("string"), F.lit("null"))), 256)
    rows = stored.select(digest.alias("h"), F.col(packed).alias("v")).orderBy("h", "v").limit(n).collect()
    return np.array([np.frombuffer(bytes(r["v"]), np.int64) for r in rows])


def add_clusters(vectors: DataFrame, n: int = CENTROIDS, rounds: int = ROUNDS, dim: int = DIM, scale: int = SCALE, seed: int = SEED, vec_id: str = "vec_id", vector: str = "embedding") -> tuple[DataFrame, np.ndarray]:
    """The vectors that can be clustered, stored, with cluster int and distance long (squared, in integers), and the final centroids."""
    vectors = vectors.drop("cluster", "distance")
    packed = fresh(vectors, "packed")
    kept = vectors.filter((F.size(vector) == dim) & finite(vector))
    stored = stored_integers(kept, vector, dim, scale, packed)
    centroids = first_centroids(stored, vec_id, packed, n, seed)
    bounded_batches(vectors.sparkSession, BATCH)
    schema = with_fields(vectors.schema, cluster="int", distance="long")
    if not len(centroids):
        return stored.select(*vectors.columns, F.lit(0).alias("cluster"), F.lit(0).cast("long").alias("distance")), centroids
    for _ in range(rounds):
        centroids = moved(centroids, group_sums(stored, packed, dim, dim, len(centroids), lambda v, c=centroids: nearest(v, segment_norms(v), c)[0]))
    final, names = centroids, [*vectors.columns, "cluster", "distance"]

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = batch.schema.get_field_index(packed)
            v = unpacked(batch.column(at), dim)
            c, d = nearest(v, segment_norms(v), final)
            kept_columns = [x for i, x in enumerate(batch.columns) if i != at]
            yield pa.record_batch([*kept_columns, pa.array(c.astype(np.int32)), pa.array(d)], names)
        release()

    return materialize(stored.mapInArrow(assigned, schema), "clusters"), final


def digests(centroids: np.ndarray) -> list[str]:
    return [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]


def op12_centroid_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    clustered, centroids = add_clusters(read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding"))
    total = clustered.agg(F.sum("distance")).first()[0]
    sha = F.expr("array(" + ",".join(f"'{x}'" for x in digests(centroids) or [""]) + ")")  # one for each centroid
    out = with_group_totals(clustered.select("vec_id", "cluster", "distance"), "cluster", "distance", "cluster_inertia")
    return out.select("vec_id", "cluster", "distance", "cluster_inertia", F.lit(total).cast("long").alias("inertia"), F.element_at(sha, F.col("cluster") + 1).alias("centroid_sha256"))


def oracle_sql() -> str:
    """The rounds one after another; distances in doubles, exact below 2^53."""
    near = lambda c: f"SELECT vec_id, v, k, d FROM (SELECT vec_id, v, k, list_dot_product(list_transform(list_zip(v, c), lambda z: z[1] - z[2]), list_transform(list_zip(v, c), lambda z: z[1] - z[2])) AS d, row_number() OVER (PARTITION BY vec_id ORDER BY d, k) AS r FROM e, {c}) WHERE r = 1"
    parts = [
        f"e AS MATERIALIZED (SELECT vec_id, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)) AS v FROM embeddings WHERE len(embedding) = {DIM} AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY sha256('{SEED}:' || vec_id)) - 1 AS k, v AS c FROM e ORDER BY sha256('{SEED}:' || vec_id) LIMIT {CENTROIDS})",
    ]
    for i in range(ROUNDS):
        parts.append(f"m{i} AS (SELECT k, list(s ORDER BY j) AS c FROM (SELECT k, j, floor(sum(x) / count(*)) AS s FROM (SELECT k, unnest(v) AS x, generate_subscripts(v, 1) AS j FROM ({near(f'c{i}')})) GROUP BY k, j) GROUP BY k)")
        parts.append(f"c{i + 1} AS MATERIALIZED (SELECT c{i}.k, coalesce(m{i}.c, c{i}.c) AS c FROM c{i} LEFT JOIN m{i} USING (k))")
    return f"WITH {', '.join(parts)}, a AS MATERIALIZED ({near(f'c{ROUNDS}')}) SELECT vec_id, CAST(k AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(sum(d) OVER (PARTITION BY k) AS BIGINT) AS cluster_inertia, CAST(sum(d) OVER () AS BIGINT) AS inertia, sha256(array_to_string(list_transform(c, lambda x: x::BIGINT), ',')) AS centroid_sha256 FROM a JOIN c{ROUNDS} USING (k)"


ORACLE_SQL = oracle_sql()
