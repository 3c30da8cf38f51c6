"""Windows over the order of a whole table, without a task that sees it all.

Rows are dealt into ranges of the ordering columns, sorted in each, and numbered by adding up the ranges' sizes. A frame of
the last n rows then needs, besides a block of consecutive numbers, the n rows before it: each block is a group with these
as a halo, so blocks are of one size whatever the values, and a frame's counts are differences of running counts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quern.operators.dedup import stored

#: Bits of monotonically_increasing_id() that number rows within a partition.
IN_PARTITION = 33
#: Rows of a block: what one window's group holds, besides the halo.
BLOCK = 100_000


def numbered(rows: DataFrame, by: list[str], name: str = "n") -> DataFrame:
    """rows, stored, with their place (0 first) in the order of `by`, nulls first. Rows that are equal in all of these are dealt by where they were read, so that none of them gathers in one task."""
    salt = f"__{name}_salt"
    order = [*by, salt]
    ranged = rows.withColumn(salt, F.monotonically_increasing_id()).repartitionByRange(*map(F.col, order)).sortWithinPartitions(*order).drop(salt)
    kept = stored(ranged.withColumn(name, F.monotonically_increasing_id()), "numbered")
    sizes = kept.groupBy(F.shiftright(name, IN_PARTITION).alias("part")).agg(F.count("*").alias("rows")).orderBy("part").collect()  # a row for each range
    starts, total = {}, 0
    for r in sizes:
        starts[r["part"]], total = total, total + r["rows"]
    before = F.expr("array(" + ",".join(f"{starts.get(i, 0)}L" for i in range(max(starts, default=0) + 1)) + ")")
    return kept.withColumn(name, F.element_at(before, (F.shiftright(name, IN_PARTITION) + 1).cast("int")) + F.col(name).bitwiseAND((1 << IN_PARTITION) - 1))


def with_halo(rows: DataFrame, number: str, last: int, block: int) -> DataFrame:
    """Each row once as a row of its block (own) and once more for each later block whose first rows look back at it; `number` counts from 0."""
    at = F.col(number)
    home = F.floor(at / F.lit(block)).cast("long")
    return rows.withColumn("__block", F.explode(F.sequence(home, F.floor((at + last) / F.lit(block)).cast("long")))).withColumn("__own", F.col("__block") == home)


def rolling_counts(events: DataFrame, kinds: list[str], last: int = 1000, by: tuple[str, ...] = ("ts", "event_id"), block: int = BLOCK) -> DataFrame:
    """event_id, ts, event, n_frame and counts, an array with for each of `kinds` how many of the last `last` events, each one included, are of it. One row for each event."""
    placed = with_halo(numbered(events.select(*dict.fromkeys([*by, "event_id", "ts", "event"])), list(by)), "n", last, block)
    upto = Window.partitionBy("__block").orderBy("n")
    running = [F.count_if(F.col("event").eqNullSafe(k)).over(upto.rowsBetween(Window.unboundedPreceding, 0)).alias(f"__c{i}") for i, k in enumerate(kinds)]
    summed = placed.select("*", *running)
    frames = [(F.col(f"__c{i}") - F.lag(f"__c{i}", last, 0).over(upto)) for i in range(len(kinds))]
    return summed.select("event_id", "ts", "event", F.least(F.col("n") + 1, F.lit(last)).alias("n_frame"), F.array(*frames).alias("counts"), "__own").filter("__own").drop("__own")


def rolling_shares(events: DataFrame, kinds: list[str], last: int = 1000, block: int = BLOCK) -> DataFrame:
    """event_id, kind, n, n_frame, share: a row for each event and kind."""
    c = rolling_counts(events, kinds, last, block=block)
    names = F.array(*map(F.lit, kinds))
    x = c.select("event_id", "n_frame", F.explode(F.arrays_zip(names.alias("kind"), F.col("counts").alias("n"))).alias("x"))
    return x.select("event_id", "x.kind", "x.n", "n_frame", (F.col("x.n") / F.col("n_frame")).alias("share"))


def first_offence(counts: Column, n_frame: Column, expected: list[tuple[str, float]], most: float = 0.2) -> Column:
    """The first of expected (kind, share), in order, whose share is more than `most` off, as kind, share, level; critical beyond twice that. Null if none is."""
    share = lambda i: F.get(counts, F.lit(i)) / n_frame
    cases = [(F.abs(share(i) - e) > most, F.struct(F.lit(k).alias("kind"), share(i).alias("share"), F.when(F.abs(share(i) - e) > 2 * most, "critical").otherwise("warning").alias("level"))) for i, (k, e) in enumerate(expected)]
    return F.coalesce(*(F.when(c, s) for c, s in cases))


def rolling_alerts(events: DataFrame, expected: dict[str, float], last: int = 1000, most: float = 0.2, block: int = BLOCK) -> DataFrame:
    """event_id, ts, kind, share, level of each event after which some kind's share of the last `last` is off: the first such kind in the order of `expected`."""
    c = rolling_counts(events, list(expected), last, block=block)
    found = c.withColumn("x", first_offence(F.col("counts"), F.col("n_frame"), list(expected.items()), most)).filter("x IS NOT NULL")
    return found.select("event_id", "ts", "x.kind", "x.share", "x.level")
