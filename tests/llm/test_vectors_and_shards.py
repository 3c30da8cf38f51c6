"""Sharding, clustering and vector codes against brute force: nulls, ties, repeated rows, empty tables, clashing columns."""

import collections
import hashlib
import math
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from quern.llm import centroid_clustering, code_compression, integer_vectors, sharding


def network(x, n, key):
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    b = max(1, -(-n // a))
    while True:
        u, v = x % a, x // a
        for r in range(sharding.ROUNDS):
            h = lambda y: int(hashlib.md5(f"{key}:{r}:{y}".encode()).hexdigest()[:15], 16)  # noqa: E731, B023
            u, v = ((u + h(v)) % a, v) if r % 2 == 0 else (u, (v + h(u)) % b)
        x = v * a + u
        if x < n:
            return x


@pytest.mark.parametrize("n", [1, 2, 3, 25, 91, 1000])
def test_the_permutation_and_its_inverse(spark, n):
    d = spark.range(n).select("id", sharding.permuted(F.col("id"), n, "k").alias("p")).withColumn("back", sharding.permuted(F.col("p"), n, "k", inverse=True))
    rows = d.collect()
    assert [r.p for r in rows] == [network(r.id, n, "k") for r in rows]
    assert sorted(r.p for r in rows) == list(range(n)) and all(r.back == r.id for r in rows)


def test_large_numbers_stay_exact(spark):
    n = 3 * 10**15 + 7
    d = spark.range(5).select((F.lit(n - 1) - F.col("id")).alias("x")).select("x", sharding.permuted(F.col("x"), n).alias("p")).withColumn("back", sharding.permuted(F.col("p"), n, inverse=True))
    assert all(r.p == network(r.x, n, sharding.KEY) and r.back == r.x for r in d.collect())


SHARD_ROWS = [(i, f"text {i}") for i in range(60)] + [(None, None), (None, ""), (7, "text 7"), (7, "text 7"), (7, "other"), (8, "é日本🎉"), (9, "x" * 300_000)] + [(99, "one id with many rows")] * 80


def test_shards_hold_every_row_once(spark, tmp_path):
    d = spark.createDataFrame([(i, t, 1, "a") for i, t in SHARD_ROWS], "doc_id long, text string, shard int, place string")
    seen = None
    for parts in (1, 5):
        placed = sharding.add_places(d.repartition(parts), ["doc_id", "text"], 7)
        assert placed.columns == ["doc_id", "text", "place", "shard", "slot"]
        rows = placed.collect()
        assert collections.Counter((r.doc_id, r.text) for r in rows) == collections.Counter(SHARD_ROWS)
        slots = collections.defaultdict(list)
        for r in rows:
            slots[r.shard].append(r.slot)
        sizes = [len(x) for x in slots.values()]
        assert len(slots) == 7 and max(sizes) - min(sizes) <= 1 and all(sorted(x) == list(range(len(x))) for x in slots.values())
        now = collections.Counter((r.doc_id, r.text, r.shard, r.slot) for r in rows)
        assert seen in (None, now)  # whatever the partitions
        seen = now
    ordered = sorted(SHARD_ROWS, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    at = placed.select("text", sharding.row_at(F.col("shard"), F.col("slot"), len(SHARD_ROWS), 7).alias("n")).collect()
    assert all(ordered[r.n][1] == r.text for r in at)
    sharding.write_shards(placed, str(tmp_path / "shards"), 3)
    back = spark.read.parquet(str(tmp_path / "shards"))
    assert collections.Counter((r.doc_id, r.text, r.shard, r.slot) for r in back.collect()) == seen
    assert sharding.add_places(d.limit(0), ["doc_id"]).count() == 0


def test_the_sharding_query(spark, tmp_path):
    spark.createDataFrame(SHARD_ROWS, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    out = sharding.op11_shards(spark, str(tmp_path))
    assert "Python" not in (plan := out._jdf.queryExecution().toString()) and "Arrow" not in plan
    size = lambda t: len((t or "").encode()) + 8
    order = sorted(SHARD_ROWS, key=lambda r: (r[0] is not None, r[0] or 0, hashlib.md5((r[1] or "").encode()).hexdigest()))
    expected = collections.Counter((i, size(t), zlib.crc32((t or "").encode()), "rows", p % 24, p // 24, None) for k, (i, t) in enumerate(order) for p in [network(k, len(order), sharding.KEY)])
    assert collections.Counter(map(tuple, out.collect())) == expected


def test_a_key_with_most_rows_is_numbered_in_several_tasks(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        rows = spark.range(0, 4000, 1, 4).select(F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(5).alias("k"))
        stored, n = sharding.numbered(rows, ["k"], "n")
        assert n == 4000 and sorted(r.n for r in stored.select("n").collect()) == list(range(4000))
        assert stored.filter("k = 5").select(F.input_file_name()).distinct().count() > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")


def whole(v, scale):
    return [math.floor(scale * float(x)) for x in v]


def good(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def vector_rows(dim):
    g = np.random.default_rng(4)
    rows = [(i, [float(np.float32(x)) for x in g.normal(0, 0.3, dim)], int(i % 3)) for i in range(120)]
    rows += [(200 + i, rows[5][1], None) for i in range(30)]  # a group of copies
    rows += [(3, rows[7][1], 1), (3, rows[7][1], 1), (None, rows[9][1], None)]
    bad = [(300, None, 0), (301, [], 0), (302, [None] * dim, 1), (303, [float("nan")] * dim, 1), (304, [float("inf")] * dim, 2), (305, [0.5] * (dim - 1), 2)]
    return rows, bad


def test_clusters_against_brute_force(spark):
    good_rows, bad = vector_rows(12)
    d = spark.createDataFrame([(*r, 9, "p") for r in good_rows + bad], "vec_id long, embedding array<float>, label int, Distance int, packed string").repartition(4)
    out, centroids = centroid_clustering.add_clusters(d, 6, 5, 12)
    assert out.columns == ["vec_id", "embedding", "label", "packed", "cluster", "distance"]
    v = [(i, whole(x, 256)) for i, x, _ in good_rows]
    c = [x for _, x in sorted(v, key=lambda r: (hashlib.sha256(f"2:{'null' if r[0] is None else r[0]}".encode()).hexdigest(), np.array(r[1], np.int64).tobytes()))[:6]]
    near = lambda x: min((sum((a - b) ** 2 for a, b in zip(x, y, strict=True)), k) for k, y in enumerate(c))
    for _ in range(5):
        own = collections.defaultdict(list)
        for _, x in v:
            own[near(x)[1]].append(x)
        c = [[sum(col) // len(own[k]) for col in zip(*own[k], strict=True)] if own[k] else y for k, y in enumerate(c)]
    assert centroids.tolist() == c
    assert collections.Counter((r.vec_id, r.cluster, r.distance) for r in out.collect()) == collections.Counter((i, near(x)[1], near(x)[0]) for i, x in v)
    assert centroid_clustering.add_clusters(d.limit(0))[0].count() == 0
    few, own = centroid_clustering.add_clusters(d.filter("vec_id in (1, 2)"), 6, 5, 12)
    assert {(r.distance) for r in few.collect()} == {0} and len(own) == 2


def test_bounds_screen_and_lose_nothing():
    g = np.random.default_rng(1)
    c = g.integers(-90, 90, (40, 64))
    v = np.concatenate([c[g.integers(0, 40, 300)] + g.integers(-30, 30, (300, 64)), c, (c[:10] + c[10:20]) // 2, np.zeros((2, 64), int), g.integers(-(2**27), 2**27, (5, 64))])
    counts = []
    found, distance = centroid_clustering.nearest(v, centroid_clustering.segment_norms(v), c, counts)
    every = ((v[:, None, :] - c[None]) ** 2).sum(2)
    assert (found == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert (centroid_clustering.lower_bounds(centroid_clustering.segment_norms(v), centroid_clustering.segment_norms(c)) <= every).all()
    assert sum(counts) < 0.8 * every.size


def test_components_too_large_for_a_long_are_refused():
    import pyarrow as pa

    assert integer_vectors.integers(pa.array([[-0.001, 2.0]], pa.list_(pa.float32())), 2, 256).tolist() == [[-1, 512]]
    with pytest.raises(ValueError, match="do not fit a long"):
        integer_vectors.integers(pa.array([[1e30, 2.0]], pa.list_(pa.float64())), 2, 256)


def test_codes_against_brute_force(spark):
    good_rows, bad = vector_rows(12)
    d = spark.createDataFrame([(*r, 9, "p") for r in good_rows + bad], "vec_id long, embedding array<float>, label int, Code int, packed string").repartition(4)
    for entries in (16, 256):
        out, books = code_compression.add_codes(d, entries, 4, 4, 1024)
        assert out.columns == ["vec_id", "embedding", "label", "packed", "code", "error"]
        v = [(i, [whole(x, 1024)[3 * p : 3 * p + 3] for p in range(4)]) for i, x, _ in good_rows]
        by_id = [x for _, x in sorted(zip([r[0] for r in good_rows], [tuple(r[1]) + (k,) for k, r in enumerate(good_rows)], strict=True), key=lambda r: (r[0] is None, r[0] or 0, r[1]))][:entries]
        c = [[v[x[-1]][1][p] for x in by_id] for p in range(4)]
        near = lambda x, b: min((sum((a - y) ** 2 for a, y in zip(x, e, strict=True)), k) for k, e in enumerate(b))
        for _ in range(4):
            for p in range(4):
                own = collections.defaultdict(list)
                for _, x in v:
                    own[near(x[p], c[p])[1]].append(x[p])
                c[p] = [[sum(col) // len(own[k]) for col in zip(*own[k], strict=True)] if own[k] else e for k, e in enumerate(c[p])]
        assert books.tolist() == c
        expected = collections.Counter((i, "".join(f"{near(x[p], c[p])[1]:02x}" for p in range(4)), sum(near(x[p], c[p])[0] for p in range(4))) for i, x in v)
        assert collections.Counter((r.vec_id, r.code, r.error) for r in out.collect()) == expected
    assert code_compression.add_codes(d.limit(0))[0].count() == 0
    assert code_compression.add_codes(d.filter("vec_id in (300, 301)"))[0].count() == 0


def test_cells_bound_and_lose_nothing():
    g = np.random.default_rng(2)
    entries = np.concatenate([g.integers(-400, 400, (200, 16)), np.repeat(g.integers(-9, 9, (1, 16)), 56, axis=0)])
    q = np.concatenate([entries, g.integers(-500, 500, (300, 16)), np.zeros((1, 16), int)])
    counts = []
    found, distance = code_compression.Cells(entries).nearest(q, counts)
    every = ((q[:, None, :] - entries[None]) ** 2).sum(2)
    assert (found == every.argmin(1)).all() and (distance == every.min(1)).all()
    assert sum(counts) < 0.5 * every.size


@pytest.mark.parametrize("most", [100, 1])
def test_group_totals_by_broadcast_and_salted(spark, most):
    d = spark.createDataFrame([(i, None if i % 4 == 0 else i % 3, i) for i in range(50)], "salt int, k int, v long")
    expected = collections.defaultdict(int)
    for i in range(50):
        expected[None if i % 4 == 0 else i % 3] += i
    rows = integer_vectors.with_group_totals(d, "k", "v", "t", most).collect()
    assert sorted(r.salt for r in rows) == list(range(50)) and all(r.t == expected[r.k] for r in rows)


def test_the_vector_queries_take_empty_tables(spark, tmp_path):
    spark.createDataFrame([], "vec_id long, embedding array<float>, label int").write.parquet(str(tmp_path / "embeddings.parquet"))
    assert centroid_clustering.op12_centroid_clusters(spark, str(tmp_path)).count() == 0
    assert code_compression.op13_vector_codes(spark, str(tmp_path)).count() == 0
