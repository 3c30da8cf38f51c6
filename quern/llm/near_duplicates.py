"""MinHash near-duplicates with bottom-k sketches.

A document's set is that of its hashed shingles; its sketch is the SKETCH smallest. Documents with equal sets are one
class from here on. The classes' sketch values make inverted lists. Two sets as similar as asked share at least the
fraction `overlap` of their sketches (six standard deviations below the mean for the threshold), so each class needs to be
in the lists of its rarest values only, as many as leave fewer than that fraction out. Each such list links its classes to
its first one, and the connected components of these links, the clusters, hold every candidate pair.

Within a cluster the inverted lists give the overlaps of sketches. Of what they let through, the union sketch of two
classes, the SKETCH smallest of both, estimates their similarity, and what passes is compared on full sets. A cluster of
over BLOCK classes or BLOCK_BYTES is first compared with one pivot, the class with the most popular values; classes linked
to it need no comparison with each other. The others, in blocks, are compared with the cluster, of which each class goes
to these blocks only. Links are kept as spanning forests, never as all pairs, and their components are the result.

Lower-cased A-Z and white space make words; null and empty texts have no words, no set and no links; shorter texts than a
shingle are one shingle. Rows of one doc_id are each sketched; their results carry that doc_id. Null ids can be in a
group but don't name it unless all are null. An empty table gives an empty result. Extra columns aren't kept.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import ASCII_LOWER, bounded_batches, materialize, read_table, release, utf8_values, with_fields
from quern.llm.components import connected_components

WORDS, PERCENT = 5, 85
SKETCH, BLOCK, BLOCK_BYTES = 64, 256, 32 << 20
#: What the pipeline calls similar, where the query's contract asks for PERCENT.
STAGE_PERCENT = 80
#: Tables of at most so many rows of a few numbers are broadcast; larger ones are joined by shuffling.
BROADCAST_ROWS = 500_000
#: Odd multipliers of a word's hash by its place in a shingle, unrelated to each other.
PLACES = [np.uint64(xxhash.xxh64_intdigest(i.to_bytes(8, "little")) | 1) for i in range(64)]


def overlap_of(percent: int) -> float:
    """The share of a sketch that two sets at the threshold have in common, but for odds of about one in 10 ** 7. Too low thresholds are refused, as their lists would link what isn't alike."""
    p = percent / 100
    share = p - 6 * math.sqrt(p * (1 - p) / SKETCH)
    if share < 0.25:
        raise ValueError(f"sketches of {SKETCH} can't tell {percent} percent")
    return share


def shingles(text: bytes, n: int = WORDS) -> np.ndarray:
    """The sorted distinct 64-bit hashes of the n-word shingles of a text; of all its words, if fewer."""
    words = text.translate(ASCII_LOWER).split()
    if len(words) < n:
        return np.array([xxhash.xxh64_intdigest(b" ".join(words))] if words else [], dtype=np.uint64)
    h = np.array(list(map(xxhash.xxh64_intdigest, words)), dtype=np.uint64)
    m = len(h) - n + 1
    s = h[:m] * PLACES[0]
    for i in range(1, n):
        s += h[i : i + m] * PLACES[i]
    for shift, factor in ((33, 0xFF51AFD7ED558CCD), (33, 0xC4CEB9FE1A85EC53), (33, 1)):  # mixing, so that the smallest are a random sample
        s ^= s >> np.uint64(shift)
        s *= np.uint64(factor)
    return np.unique(s)


def sketched(documents: DataFrame, words: int) -> DataFrame:
    """doc_id, text_hash, n_shingles, key (of the whole set, null if empty), sketch array<long> of the smallest hashes."""

    def made(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words) for t in utf8_values(batch)]
            keys = [xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None for s in sets]
            sketches = [s[:SKETCH].view(np.int64) for s in sets]
            ends = np.concatenate([[0], np.cumsum([len(s) for s in sketches])]).astype(np.int32)
            flat = np.concatenate(sketches) if sketches else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(2), pa.array([len(s) for s in sets], pa.int64()), pa.array(keys, pa.binary()), pa.ListArray.from_arrays(pa.array(ends), pa.array(flat))], ["doc_id", "text_hash", "n_shingles", "key", "sketch"])
        release()

    kinds = {"text_hash": "long", "n_shingles": "long", "key": "binary", "sketch": "array<long>"}
    return documents.select("doc_id", "text", F.xxhash64("text").alias("text_hash")).mapInArrow(made, with_fields(documents.select("doc_id").schema, **kinds))


def prefixes(classes: DataFrame, overlap: float) -> DataFrame:
    """cid, popularity, values: for every class that has any, its rarest sketch values that other classes have too."""
    values = classes.select("cid", F.size("sketch").alias("s"), F.explode("sketch").alias("v"))
    counts = values.groupBy("v").agg(F.count("*").alias("c")).filter("c > 1")
    own = values.join(counts, "v").groupBy("cid", "s").agg(F.sort_array(F.collect_list(F.struct("c", "v"))).alias("shared"))  # SKETCH at most
    needed = F.greatest(F.lit(1), F.floor(F.col("s") * overlap).cast("int"))
    take = F.col("s") - needed + 1 - (F.col("s") - F.size("shared"))  # values of no other class come first in the prefix
    return own.filter(take > 0).select("cid", F.aggregate("shared", F.lit(0).cast("long"), lambda a, x: a + x["c"]).alias("popularity"), F.slice("shared.v", F.lit(1), take).alias("values"))


def clusters(prefix: DataFrame) -> DataFrame:
    """cid, cluster: components of the classes that meet in a list."""
    rows = prefix.select("cid", F.explode("values").alias("v"))
    first = rows.groupBy("v").agg(F.min("cid").alias("m"), F.count("*").alias("n")).filter("n > 1")
    edges = rows.join(first, "v").filter("cid <> m").select(F.col("cid").alias("a"), F.col("m").alias("b")).distinct()
    return connected_components(edges).select(F.col("node").alias("cid"), F.col("component").alias("cluster"))


def joined_to(large: DataFrame, small: DataFrame, condition, rows: int) -> DataFrame:
    """An inner join that broadcasts `small` only if it has few rows."""
    return large.join(F.broadcast(small) if rows <= BROADCAST_ROWS else small, condition)


def similar(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Exact Jaccard similarity of two sorted sets, at least percent / 100."""
    if 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return 100 * both >= percent * (len(a) + len(b) - both)


def overlaps(a: list[np.ndarray], b: list[np.ndarray], overlap: float) -> np.ndarray:
    """A matrix that is true where the sketches of a set of a and one of b share at least the fraction `overlap` of the smaller one, counted in inverted lists."""
    index: dict[int, list[int]] = {}
    for j, x in enumerate(b):
        for v in x[:SKETCH].tolist():
            index.setdefault(v, []).append(j)
    out = np.zeros((len(a), len(b)), dtype=bool)
    size_b = np.array([min(SKETCH, len(x)) for x in b])
    for i, x in enumerate(a):
        counts = np.zeros(len(b), dtype=np.int32)
        for v in x[:SKETCH].tolist():
            counts[index.get(v, [])] += 1
        out[i] = counts >= np.maximum(1, np.floor(overlap * np.minimum(size_b, min(SKETCH, len(x)))))
    return out


def union_estimate(a: np.ndarray, b: np.ndarray) -> float:
    """The similarity as the union sketch of two sets shows it: the share of the smallest values of either that are in both."""
    both, n = np.unique(np.concatenate([a[:SKETCH], b[:SKETCH]]), return_counts=True)
    n = n[:SKETCH]
    return float((n == 2).sum() / len(n)) if len(n) else 0.0


def linked_pairs(a: list[np.ndarray], b: list[np.ndarray], percent: int, skip) -> Iterator[tuple[int, int]]:
    """The places (i, j) of similar sets, of those that skip(i, j) doesn't exclude: by overlap, then by the union sketch, then exact. skip is asked again and again, as links already found may exclude a pair."""
    overlap = overlap_of(percent)
    passed = overlaps(a, b, overlap)
    for i in range(len(a)):
        for j in np.flatnonzero(passed[i]).tolist():
            if not skip(i, j) and union_estimate(a[i], b[j]) >= overlap and similar(a[i], b[j], percent):
                yield i, j


class Forest:
    def __init__(self):
        self.up: dict[int, int] = {}

    def root(self, x: int) -> int:
        while (y := self.up.setdefault(x, x)) != x:
            self.up[x] = self.up[y]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> None:
        x, y = self.root(x), self.root(y)
        self.up[max(x, y)] = min(x, y)


def sets_of(column: pd.Series) -> list[np.ndarray]:
    return [np.frombuffer(x, dtype=np.uint64) for x in column]


LINKS = "a long, b long"


def verified_links(members: DataFrame, percent: int) -> DataFrame:
    """a, b: a spanning forest of the similar pairs within each cluster. members: cid, cluster, blocks (that the cluster needs; 1: it is small), popularity, hashes binary."""

    def in_cluster(rows: pd.DataFrame) -> pd.DataFrame:
        cids, sets, forest = rows["cid"].tolist(), sets_of(rows["hashes"]), Forest()
        out = []
        for i, j in linked_pairs(sets, sets, percent, lambda i, j: i >= j or forest.root(i) == forest.root(j)):
            forest.join(i, j)
            out.append((cids[i], cids[j]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    small = members.filter("blocks = 1").select("cluster", "cid", "hashes").groupBy("cluster").applyInPandas(in_cluster, LINKS)
    large = members.filter("blocks > 1")
    pivots = large.groupBy("cluster").agg(F.max_by(F.struct("cid", "hashes"), F.struct("popularity", "cid")).alias("pivot"))
    with_pivot = large.select("cluster", "cid", "blocks", "hashes").join(pivots, "cluster")

    def at_pivot(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = batch.to_pydict()
            near = [p["cid"] == c or similar(np.frombuffer(h, np.uint64), np.frombuffer(p["hashes"], np.uint64), percent) for c, h, p in zip(rows["cid"], rows["hashes"], rows["pivot"], strict=True)]
            at = batch.schema.get_field_index("pivot")
            yield batch.set_column(at, "pivot", pa.array([p["cid"] for p in rows["pivot"]], pa.int64())).append_column("near", pa.array(near, pa.bool_()))

    kinds = {"cluster": "long", "cid": "long", "blocks": "int", "hashes": "binary", "pivot": "long", "near": "boolean"}
    seen = materialize(with_pivot.mapInArrow(at_pivot, ", ".join(f"{k} {v}" for k, v in kinds.items())), "pivots")
    to_pivot = seen.filter("near AND cid <> pivot").select(F.col("cid").alias("a"), F.col("pivot").alias("b"))
    # what isn't linked to the pivot, in blocks, against every block of the cluster; the cluster goes to blocks that ask only
    block = F.pmod(F.xxhash64("cid"), F.col("blocks")).cast("int")
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    asked = seen.filter("NOT near").select("cluster", "cid", "hashes", "near", block.alias("q"), every.alias("t"), F.lit(True).alias("asks"))
    asking = seen.filter("NOT near").select("cluster", block.alias("q")).distinct()
    others = seen.select("cluster", "cid", "hashes", "near", block.alias("t")).join(asking, "cluster").withColumn("asks", F.lit(False))

    def in_tile(rows: pd.DataFrame) -> pd.DataFrame:
        a, b, forest = rows[rows["asks"]], rows[~rows["asks"]], Forest()
        ids_a, ids_b = a["cid"].tolist(), b["cid"].tolist()
        anchored = b[b["near"]]["cid"].tolist()
        for x in anchored[1:]:  # linked already, through the pivot
            forest.join(anchored[0], x)
        out = []
        for i, j in linked_pairs(sets_of(a["hashes"]), sets_of(b["hashes"]), percent, lambda i, j: forest.root(ids_a[i]) == forest.root(ids_b[j])):
            forest.join(ids_a[i], ids_b[j])
            out.append((ids_a[i], ids_b[j]))
        return pd.DataFrame(out, columns=["a", "b"]).astype("int64")

    tiles = asked.unionByName(others).groupBy("cluster", "q", "t").applyInPandas(in_tile, LINKS)
    return small.unionByName(to_pivot).unionByName(tiles)


def find_groups(documents: DataFrame, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles, component_id (the smallest doc_id reachable by links of similarity >= percent / 100, the own one included) and kept (doc_id = component_id)."""
    spark = documents.sparkSession
    bounded_batches(spark)
    rows = materialize(sketched(documents, words), "sketches")
    classes = materialize(
        rows.filter("key IS NOT NULL").groupBy("key").agg(F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"), F.first("sketch").alias("sketch"), F.min(F.struct("doc_id", "text_hash")).alias("at")).withColumn("cid", F.monotonically_increasing_id()),
        "classes",
    )
    prefix = materialize(prefixes(classes, overlap_of(percent)), "prefixes")
    grouped = materialize(clusters(prefix), "clusters")
    n = grouped.count()
    sized = classes.select("cid", "key", "at", "n_shingles").join(grouped, "cid").join(prefix.select("cid", "popularity"), "cid")
    blocks = F.ceil(F.greatest(F.count("*") / BLOCK, F.sum("n_shingles") * 8 / BLOCK_BYTES)).cast("int")
    wanted = materialize(sized.join(sized.groupBy("cluster").agg(blocks.alias("blocks")), "cluster").drop("n_shingles"), "wanted")

    def with_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = [shingles(t, words).tobytes() for t in utf8_values(batch)]
            right = [xxhash.xxh3_128_digest(s) == k for s, k in zip(sets, batch.column(batch.schema.get_field_index("key")).to_pylist(), strict=True)]
            at = batch.schema.get_field_index("text")
            yield batch.set_column(at, "hashes", pa.array(sets, pa.binary())).filter(pa.array(right))
        release()

    # by id and text, as an id may be null or stand on many rows
    same = F.col("doc_id").eqNullSafe(F.col("at.doc_id")) & (F.xxhash64("text") == F.col("at.text_hash"))
    texts = joined_to(documents.select("doc_id", "text"), wanted, same, n).select("cid", "cluster", "blocks", "popularity", "key", "text")
    members = texts.mapInArrow(with_sets, "cid long, cluster long, blocks int, popularity long, key binary, hashes binary").drop("key").dropDuplicates(["cid"])
    linked = connected_components(verified_links(materialize(members, "members"), percent))
    named = linked.join(classes.select(F.col("cid").alias("node"), "rep"), "node")
    least = named.groupBy("component").agg(F.min("rep").alias("component_id"))
    renamed = materialize(named.join(least, "component").select(F.col("node").alias("cid"), "component_id"), "renamed")
    keyed = classes.select("cid", "key", "rep").join(renamed, "cid", "left").select("key", F.coalesce("component_id", "rep").alias("component_id"))
    out = rows.select("doc_id", "n_shingles", "key").join(keyed, "key", "left")
    component = F.when(F.col("key").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return find_groups(read_table(spark, sf_dir, "documents"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pipeline stage: of each group of rows linked at STAGE_PERCENT or more, the one with the smallest id, with its own columns; null ids come last, and of rows with one id the first numbered stays. Rows are told apart by a number, so ids may be null or repeated."""
    numbered = materialize(docs.withColumn("__row", F.monotonically_increasing_id()), "numbered")
    groups = find_groups(numbered.select(F.col("__row").alias("doc_id"), "text"), percent=STAGE_PERCENT).select(F.col("doc_id").alias("__row"), "component_id")
    groups = materialize(groups.join(numbered.select("__row", "doc_id"), "__row"), "groups")
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "__row"))
    kept = groups.groupBy("component_id").agg(first.alias("first")).select(F.col("first.__row").alias("__row"))
    gone = materialize(groups.select("__row").join(kept, "__row", "left_anti"), "dropped")
    return numbered.join(F.broadcast(gone) if gone.count() <= BROADCAST_ROWS else gone, "__row", "left_anti").drop("__row")


ORACLE_SQL = """
WITH RECURSIVE words AS (
    SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS w
    FROM documents
),
sets AS (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
        ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))) END AS shingles FROM words
),
each AS (SELECT doc_id, len(shingles) AS n, unnest(shingles) AS shingle FROM sets),
links AS (
    SELECT a.doc_id AS a, b.doc_id AS b FROM each AS a JOIN each AS b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
    GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))
),
reach(doc_id, other) AS (
    SELECT a, b FROM links UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON reach.other = links.a
),
least AS (SELECT doc_id, min(other) AS other FROM reach GROUP BY doc_id)
SELECT doc_id, len(shingles)::BIGINT AS n_shingles, least(doc_id, coalesce(other, doc_id)) AS component_id, doc_id <= coalesce(other, doc_id) AS kept
FROM sets LEFT JOIN least USING (doc_id)
"""
