"""Keyed state over a stream of ledger events: retries up to the dead letter, and the mix of each key's last events.

Each key's events go to one task in the order they arrive: those of one micro-batch by ts and event_id. State is in RocksDB
with its changes in the query's checkpoint, so a restarted or moved task goes on from the last committed batch. A key's
state is bounded: one number, or its last `last` events.
"""

from __future__ import annotations

from collections import Counter, deque
from collections.abc import Callable, Iterator

from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from quern.operators.dedup import shared_folder

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ORDER = ["ts", "event_id"]
#: Events of a run at most, as a key's events of one are put in order together.
RUN = 1_000_000


def in_order(rows: Iterator[Row]) -> list[Row]:
    """One key's events of one micro-batch."""
    return sorted(rows, key=lambda r: tuple((r[c] is None, r[c]) for c in ORDER))


class RetryCounter(StatefulProcessor):
    """Counts a key's failures since its last success; a row leaves for each failure."""

    def __init__(self, most: int):
        self.most = most

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.failures = handle.getValueState("failures", "n long")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = self.failures.get()
        n = before = held[0] if held else 0
        for x in in_order(rows):
            if x.event == "done":
                n = 0
            elif x.event == "fail":
                n += 1
                yield Row(key=key[0], event_id=x.event_id, ts=x.ts, failures=n, action="retry" if n < self.most else "failed")
        if n != before:
            self.failures.update((n,))

    def close(self) -> None:
        pass


class LastEvents(StatefulProcessor):
    """Holds a key's last events; a row leaves for each event, with how many of them are of its kind."""

    def __init__(self, last: int):
        self.last = last

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.events = handle.getListState("events", "event string")

    def handleInputRows(self, key, rows, timerValues) -> Iterator[Row]:
        held = deque(x[0] for x in self.events.get())
        counts = Counter(held)
        for x in in_order(rows):
            held.append(x.event)
            counts[x.event] += 1
            if len(held) > self.last:
                counts[held.popleft()] -= 1
            yield Row(key=key[0], event_id=x.event_id, ts=x.ts, event=x.event, n_same=counts[x.event], n_held=len(held))
        self.events.put([(x,) for x in held])

    def close(self) -> None:
        pass


def kind_of_ts(ledger: DataFrame) -> str:
    return ledger.schema["ts"].dataType.simpleString()


def retry_actions(ledger: DataFrame, most: int = 3) -> DataFrame:
    """A stream of key, event_id, ts, failures, action for each failure in a ledger stream: "failed", to the dead letter, from the `most`-th since the last success on, else "retry". Events without a key or a kind change nothing."""
    schema = f"key long, event_id long, ts {kind_of_ts(ledger)}, failures long, action string"
    known = ledger.filter("key IS NOT NULL AND event IN ('done', 'fail')").select("key", "event_id", "ts", "event")
    return known.groupBy("key").transformWithState(RetryCounter(most), schema, "Append", "None")


def last_mix(ledger: DataFrame, last: int = 1000) -> DataFrame:
    """A stream of key, event_id, ts, event, n_same, n_held for each event of a ledger stream: how many of the key's last `last` events, it included, are of its kind, and how many these are."""
    schema = f"key long, event_id long, ts {kind_of_ts(ledger)}, event string, n_same long, n_held long"
    known = ledger.filter("key IS NOT NULL AND event IS NOT NULL").select("key", "event_id", "ts", "event")
    return known.groupBy("key").transformWithState(LastEvents(last), schema, "Append", "None")


def run_once(stream: DataFrame, folder: str, checkpoint: str) -> None:
    """Take what is new into the table at `folder`, each batch once, and end. Started again with the same checkpoint it goes on from there."""
    spark = stream.sparkSession
    before = spark.conf.get(PROVIDER, None)
    spark.conf.set(PROVIDER, ROCKSDB)
    try:
        q = stream.writeStream.format("parquet").option("path", folder).option("checkpointLocation", checkpoint).outputMode("append").trigger(availableNow=True).start()
    finally:
        spark.conf.set(PROVIDER, before) if before else spark.conf.unset(PROVIDER)
    q.awaitTermination()


def arriving(ledger: DataFrame, of: Callable[[DataFrame], DataFrame], parts: int = 3) -> DataFrame:
    """What of(stream) makes of a ledger whose events arrive in runs by ts and event_id: each run is written as files that a fresh start of the stream takes, going on with the state that the ones before left in the checkpoint."""
    spark, root = ledger.sparkSession, shared_folder(ledger.sparkSession, "arriving")
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    at = ledger.select(micros.alias("at"))
    parts = max(parts, -(-ledger.count() // RUN))
    bounds = sorted({int(x) for x in at.approxQuantile("at", [i / parts for i in range(1, parts)], 0.001)})
    for low, high in zip([None, *bounds], [*bounds, None], strict=True):
        above = F.lit(True) if low is None else micros > low
        below = F.lit(True) if high is None else micros <= high
        ledger.filter(above & below).write.mode("append").parquet(f"{root}/in")
        run_once(of(spark.readStream.schema(ledger.schema).parquet(f"{root}/in")), f"{root}/out", f"{root}/checkpoint")
    return spark.read.parquet(f"{root}/out")
