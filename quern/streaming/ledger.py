"""The work ledger: an append-only table of events (key, ts, event_id, event, elapsed, error), from which all queue state follows.

A batch reads it whole, a stream as it grows: the functions take either, but for those that say they need a batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

STATES = {"queued": "queued", "start": "processing", "done": "done", "fail": "failed"}


def current_state(ledger: DataFrame) -> DataFrame:
    """key, state, ts: what the last event of each key says."""
    last = ledger.groupBy("key").agg(F.max_by("event", F.struct("ts", "event_id")).alias("event"), F.max("ts").alias("ts"))
    names = F.create_map(*(F.lit(x) for kv in STATES.items() for x in kv))
    return last.select("key", F.element_at(names, F.col("event")).alias("state"), "ts")


def retries(ledger: DataFrame, most: int = 3) -> DataFrame:
    """key, failures, dead: failures since the last success, and whether they used up all attempts."""
    success = F.max(F.when(F.col("event") == "done", F.struct("ts", "event_id"))).over(Window.partitionBy("key"))
    since = ledger.withColumn("__s", success).filter((F.col("event") == "fail") & (F.col("__s").isNull() | (F.struct("ts", "event_id") > F.col("__s"))))
    return since.groupBy("key").agg(F.count("*").alias("failures")).withColumn("dead", F.col("failures") >= most)


def stale(ledger: DataFrame, now: str, ttl_s: int = 900) -> DataFrame:
    """key, ts of work that started more than ttl_s seconds before `now` and hasn't ended."""
    s = current_state(ledger).filter("state = 'processing'")
    return s.filter(F.unix_timestamp(F.lit(now).cast("timestamp")) - F.unix_timestamp("ts") > ttl_s).select("key", "ts")


def pending(candidates: DataFrame, ledger: DataFrame) -> DataFrame:
    """Candidates (key) that are in no state but failed: those to enqueue."""
    taken = current_state(ledger).filter("state <> 'failed'").select("key")
    return candidates.join(taken, "key", "left_anti")


def latency(ledger: DataFrame, last: int = 1000) -> DataFrame:
    """One row over the last `last` ended events with a time: n, average, p95 (the value at floor(.95 n), from 0), least, most, and the percentage that failed. `last` rows at most are ordered in one task."""
    ended = ledger.filter(F.col("event").isin("done", "fail") & F.col("elapsed").isNotNull()).orderBy(F.desc("ts"), F.desc("event_id")).limit(last)
    values = F.array_sort(F.collect_list("elapsed"))
    return ended.agg(F.count("*").alias("n"), F.round(F.avg("elapsed"), 6).alias("avg_s"), F.get(values, F.least(F.floor(F.lit(0.95) * F.count("*")), F.count("*") - 1).cast("int")).alias("p95_s"), F.min("elapsed").alias("min_s"), F.max("elapsed").alias("max_s"), F.round(100.0 * F.count_if(F.col("event") == "fail") / F.count("*"), 6).alias("fail_percent"))


def errors(ledger: DataFrame) -> DataFrame:
    """error, n, percent of all failures."""
    f = ledger.filter("event = 'fail'").groupBy(F.coalesce("error", F.lit("unknown")).alias("error")).agg(F.count("*").alias("n"))
    return f.withColumn("percent", F.round(100.0 * F.col("n") / F.sum("n").over(Window.partitionBy()), 6))


def distribution(events: DataFrame, last: int = 1000) -> DataFrame:
    """event, share among the last `last` events."""
    recent = events.orderBy(F.desc("ts"), F.desc("event_id")).limit(last)
    n = recent.groupBy("event").agg(F.count("*").alias("n"))
    return n.select("event", (F.col("n") / F.sum("n").over(Window.partitionBy())).alias("share"))


def anomalies(shares: DataFrame, expected: dict[str, float], most: float = 0.2) -> DataFrame:
    """event, expected, share, level where a share is more than `most` off; critical beyond twice that. Absent events have share 0."""
    spark = shares.sparkSession
    e = spark.createDataFrame(sorted(expected.items()), "event string, expected double")
    d = e.join(shares, "event", "left").withColumn("share", F.coalesce("share", F.lit(0.0)))
    off = F.abs(F.col("share") - F.col("expected"))
    return d.filter(off > most).select("event", "expected", F.round("share", 6).alias("share"), F.when(off > 2 * most, "critical").otherwise("warning").alias("level"))


def per_window(events: DataFrame, length: str = "1 hour", slide: str | None = None, delay: str = "10 minutes") -> DataFrame:
    """Counts and sums of value per event in event-time windows; on a stream, rows later than `delay` are dropped by the watermark."""
    w = F.window("ts", length, slide) if slide else F.window("ts", length)
    e = events.withWatermark("ts", delay) if events.isStreaming else events
    return e.groupBy(w.alias("w"), "event").agg(F.count("*").alias("n"), F.round(F.sum("value"), 4).alias("total")).select(F.col("w.start").alias("window_start"), "event", "n", "total")


def sessions(events: DataFrame, gap: str = "30 minutes", delay: str = "10 minutes") -> DataFrame:
    """key, session_start, n: runs of a key's events with no pause of `gap`."""
    e = events.withWatermark("ts", delay) if events.isStreaming else events
    return e.groupBy(F.session_window("ts", gap).alias("w"), "key").agg(F.count("*").alias("n")).select("key", F.col("w.start").alias("session_start"), "n")


def once(events: DataFrame, delay: str = "10 minutes") -> DataFrame:
    """Events without repeated arrivals of one event_id."""
    return events.withWatermark("ts", delay).dropDuplicatesWithinWatermark(["event_id"]) if events.isStreaming else events.dropDuplicates(["event_id"])


def follow(ledger, folder: str, checkpoint: str):
    """Append a ledger stream to a table, each batch once: the query's checkpoint holds what was taken, so a restart goes on from there."""
    return ledger.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()


def progress(states: DataFrame) -> DataFrame:
    """One row from states (key, state, elapsed): how many are queued, running, done and failed, the percentage that is over, and the seconds left at the mean of what is done, for one worker."""
    n = lambda x: F.count_if(F.col("state") == x)
    s = states.agg(*(n(x).alias(x) for x in ("queued", "running", "done", "failed")), F.count("*").alias("total"), F.avg(F.when(F.col("state") == "done", F.col("elapsed"))).alias("mean_s"))
    over = F.col("done") + F.col("failed")
    return s.select("*", F.round(100.0 * over / F.nullif("total", F.lit(0)), 6).alias("percent"), F.round((F.col("queued") + F.col("running")) * F.col("mean_s"), 6).alias("left_s")).drop("mean_s")


def reconcile(listed: DataFrame, present: DataFrame) -> DataFrame:
    """key and where it is missing: what is listed as done without an output, and outputs that nothing lists."""
    a, b = listed.select("key").distinct(), present.select("key").distinct()
    return a.join(b, "key", "left_anti").withColumn("missing", F.lit("output")).unionByName(b.join(a, "key", "left_anti").withColumn("missing", F.lit("list")))


def review_queue(events: DataFrame, most: int = 1000) -> DataFrame:
    """Who waits for review, from events (event_id, ts, key, event: enqueue or resolve): keys whose first enqueue since their last resolve is open, oldest first, numbered; beyond `most` they are marked as over the limit. Events without a key are left out."""
    events = events.filter("key IS NOT NULL")
    last = events.filter("event = 'resolve'").groupBy("key").agg(F.max(F.struct("ts", "event_id")).alias("resolved"))
    waiting = events.filter("event = 'enqueue'").join(last, "key", "left").filter(F.col("resolved").isNull() | (F.struct("ts", "event_id") > F.col("resolved")))
    first = waiting.groupBy("key").agg(F.min(F.struct("ts", "event_id")).alias("since"))
    # the oldest `most` are few; the others need no place
    head = first.orderBy("since").limit(most).withColumn("place", F.row_number().over(Window.orderBy("since")))
    return first.join(F.broadcast(head.select("key", "place")), "key", "left").select("key", F.col("since.ts").alias("since"), "place", F.col("place").isNull().alias("over_limit"))


def dequeued(queue: DataFrame, n: int = 10) -> DataFrame:
    """The first n of what review_queue() gives, oldest first: place, key, since. To take them, append a resolve event for each."""
    return queue.filter(F.col("place") <= n).select("place", "key", "since")


def review_stats(events: DataFrame) -> DataFrame:
    """One row from events (event_id, ts, key, event: enqueue or resolve): how many entered the queue (an enqueue of a key that already waits doesn't), were resolved, and wait, and the mean seconds from entering to the first resolve after it. Events without a key are left out."""
    w = Window.partitionBy("key").orderBy("ts", "event_id")
    e = events.filter("key IS NOT NULL AND event IN ('enqueue', 'resolve')").withColumn("before", F.lag("event").over(w))
    entered = (F.col("event") == "enqueue") & F.coalesce(F.col("before") != "enqueue", F.lit(True))
    e = e.withColumn("since", F.when(entered, F.col("ts"))).withColumn("since", F.last("since", ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0)))
    left = (F.col("event") == "resolve") & F.coalesce(F.col("before") == "enqueue", F.lit(False))
    waited = F.when(left, (F.unix_micros(F.col("ts").cast("timestamp")) - F.unix_micros(F.col("since").cast("timestamp"))) / 1e6)
    s = e.agg(F.count_if(entered).alias("enqueued"), F.count_if(F.col("event") == "resolve").alias("resolved"), F.count_if(left).alias("left_queue"), F.round(F.avg(waited), 3).alias("mean_wait_s"))
    return s.select("enqueued", "resolved", (F.col("enqueued") - F.col("left_queue")).alias("waiting"), "mean_wait_s")
