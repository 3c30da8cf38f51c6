"""Sharding by a permutation of row numbers that can be computed.

Rows are numbered from 0 in the order of given columns; a keyed Feistel network with cycle walking permutes the numbers
0 to N - 1. Permuted number p stands in shard p mod S at slot p div S, so shards differ by one row at most, slots have no
gaps, and anyone who knows N, S and the key can compute where a row is, or with the inverse which row is at a place. The
round function is md5 of text, which every engine has.

Numbers come from one shuffle into ranges, each sorted, with the ranges' sizes added up: no task sees all rows. Rows that
are equal in all ordering columns are told apart by where they were read, so one key with many rows is split over ranges
too. If equal rows differ in other columns, these decide nothing: order by what makes rows distinct, as the query does.

Null texts have no bytes; nulls order first; repeated rows get places of their own, as do equal texts, whose groups this
law doesn't keep together; an empty table gives an empty result; very long texts count by their sizes alone; extra columns
stay unless named like a result. Built-in functions only.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import fresh, materialize, read_table

SHARDS, KEY, ROUNDS = 24, "quern", 6
#: Bits of monotonically_increasing_id() that number rows within a partition.
IN_PARTITION = 33
#: Bytes that a record takes besides its text.
FRAME = 8


def sides(n: int) -> tuple[int, int]:
    """a and b with a * b >= n, where a * b - n is below a, so about the root of n: the Feistel network's halves count to a and b."""
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def feistel(x: Column, n: int, key: str, inverse: bool = False) -> Column:
    """One pass of the network over numbers below a * b. Each round adds a digest of one half to the other, which subtracting it undoes."""
    a, b = sides(n)
    one, sign = F.lit(1).cast("long"), F.lit(-1 if inverse else 1).cast("long")
    digest = lambda r, y, m: F.conv(F.substring(F.md5(F.concat(F.lit(f"{key}:"), r.cast("string"), F.lit(":"), y.cast("string"))), 1, 15), 16, 10).cast("long") % m

    def turn(s: Column, r: Column) -> Column:
        """Even rounds change the half below a, odd ones that below b."""
        even = r % 2 == 0
        u = F.when(even, F.pmod(s["u"] + sign * digest(r, s["v"], F.lit(a)), F.lit(a).cast("long"))).otherwise(s["u"])
        v = F.when(even, s["v"]).otherwise(F.pmod(s["v"] + sign * digest(r, s["u"], F.lit(b)), F.lit(b).cast("long")))
        return F.struct(u.alias("u"), v.alias("v"))

    order = range(ROUNDS - 1, -1, -1) if inverse else range(ROUNDS)
    halves = F.struct((x % a * one).alias("u"), F.floor(x / F.lit(a).cast("decimal(20,0)")).cast("long").alias("v"))
    done = F.aggregate(F.array(*map(F.lit, order)), halves, turn)
    return F.transform(F.array(done), lambda s: s["v"] * F.lit(a).cast("long") + s["u"])[0]


def permuted(x: Column, n: int, key: str = KEY, inverse: bool = False) -> Column:
    """The number below n that x, one below n, goes to; inverse: the one it comes from.

    Cycle walking: what the network puts at n or above goes through it again. As the network is one to one, a walk meets
    no number twice, so it ends after as many steps as there are numbers from n to a * b. Few rows walk at all, and only
    for these is the list of steps made: a * b - n rows at most, each looking at as many steps, together fewer than n.
    """
    a, b = sides(n)
    first = feistel(x, n, key, inverse)
    if a * b == n:
        return first
    # the first number is held by a lambda's variable, else each use would compute it anew; the list of steps hangs on it so as not to be a constant in the plan
    walk = lambda p: F.aggregate(F.sequence(F.lit(1).cast("long"), F.lit(a * b - n).cast("long") + p * 0), p, lambda v, _: F.when(v < n, v).otherwise(feistel(v, n, key, inverse)))
    return F.transform(F.array(first), lambda p: F.when(p < n, p).otherwise(walk(p)))[0]


def numbered(rows: DataFrame, by: list[str], name: str) -> tuple[DataFrame, int]:
    """rows, stored, with their numbers in the order of the columns `by` as a column `name`, and how many there are."""
    place, part = fresh(rows, "place"), fresh(rows, "part")
    order = [*by, place]
    sorted_rows = rows.withColumn(place, F.monotonically_increasing_id()).repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order).drop(place)
    stored = materialize(sorted_rows.withColumn(name, F.monotonically_increasing_id()), "numbered")
    sizes = stored.groupBy(F.shiftright(name, IN_PARTITION).alias(part)).agg(F.count("*").alias("n")).orderBy(part).collect()  # a row for each range
    before, total = {}, 0
    for r in sizes:
        before[r[part]], total = total, total + r["n"]
    starts = F.expr("array(" + ",".join(f"{before.get(i, 0)}L" for i in range(max(before, default=0) + 1)) + ")")
    return stored.withColumn(name, F.element_at(starts, (F.shiftright(name, IN_PARTITION) + 1).cast("int")) + F.col(name).bitwiseAND((1 << IN_PARTITION) - 1)), total


def add_places(rows: DataFrame, by: list[str], shards: int = SHARDS, key: str = KEY) -> DataFrame:
    """rows with shard int and slot long: shuffled by the key, reproducibly, whatever partitions they come in. by: columns that order the rows."""
    rows = rows.drop(*(c for c in ("shard", "slot") if c not in by))
    number = fresh(rows, "number")
    with_numbers, n = numbered(rows, by, number)
    place = fresh(rows, "at")
    placed = with_numbers.withColumn(place, permuted(F.col(number), n, key))
    return placed.select(*rows.columns, (F.col(place) % shards).cast("int").alias("shard"), F.floor(F.col(place) / F.lit(shards).cast("decimal(20,0)")).cast("long").alias("slot"))


def row_at(shard: Column, slot: Column, n: int, shards: int = SHARDS, key: str = KEY) -> Column:
    """The number, in the rows' order, of the row that stands at a slot of a shard."""
    return permuted(slot.cast("long") * shards + shard, n, key, inverse=True)


def write_shards(placed: DataFrame, path: str, parts: int | None = None) -> None:
    """The shards as folders of Parquet files, each file a run of slots in order. One shard goes to as many tasks as its share of the rows asks for."""
    order = ["shard", "slot"]
    dealt = placed.repartitionByRange(parts, *order) if parts else placed.repartitionByRange(*order)
    dealt.sortWithinPartitions(*order).write.partitionBy("shard").parquet(path)


def op11_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = read_table(spark, sf_dir, "documents").select(
        "doc_id", (F.octet_length(text) + FRAME).cast("long").alias("size"), F.crc32(text).alias("text_crc32"), F.md5(text).alias("digest")
    )
    placed = add_places(rows, ["doc_id", "digest"])
    return placed.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


#: The same network and walk as a recursion; CRC-32 by a table of 256 remainders that its polynomial gives.
ORACLE_SQL = f"""WITH RECURSIVE g(i, k, x) AS (SELECT i, 0, i FROM range(256) t(i) UNION ALL SELECT i, k + 1, CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384) ELSE x >> 1 END FROM g WHERE k < 8),
crc AS (SELECT list(x ORDER BY i) AS t FROM g WHERE k = 8),
bytes AS (SELECT doc_id, coalesce(text, '') AS text, list_transform(regexp_extract_all(hex(encode(coalesce(text, ''))), '..'), lambda y: ('0x' || y)::BIGINT) AS b FROM documents),
d AS (SELECT doc_id, len(b) + {FRAME} AS size, xor(list_reduce(list_prepend(4294967295, b), lambda c, y: xor(c >> 8, t[(xor(c, y) & 255) + 1])), 4294967295) AS text_crc32,
  row_number() OVER (ORDER BY doc_id NULLS FIRST, md5(text)) - 1 AS i FROM bytes, crc),
n AS (SELECT n, a, (n + a - 1) // a AS b FROM (SELECT count(*) AS n, CAST(floor(sqrt(greatest(0, count(*) - 1))) AS BIGINT) + 1 AS a FROM documents)),
w AS (SELECT i, 0 AS r, i % a AS u, i // a AS v FROM d, n
  UNION ALL SELECT i, CASE WHEN r = {ROUNDS} THEN 0 ELSE r + 1 END,
    CASE WHEN r < {ROUNDS} AND r % 2 = 0 THEN (u + ('0x' || left(md5('{KEY}:' || r || ':' || v), 15))::BIGINT % a) % a ELSE u END,
    CASE WHEN r < {ROUNDS} AND r % 2 = 1 THEN (v + ('0x' || left(md5('{KEY}:' || r || ':' || u), 15))::BIGINT % b) % b ELSE v END
  FROM w, n WHERE r < {ROUNDS} OR v * a + u >= n),
p AS (SELECT i, v * a + u AS p FROM w, n WHERE r = {ROUNDS} AND v * a + u < n)
SELECT doc_id, size, text_crc32, 'rows' AS law, CAST(p % {SHARDS} AS INTEGER) AS shard, p // {SHARDS} AS slot, CAST(NULL AS INTEGER) AS grown_shard FROM d JOIN p USING (i)"""
