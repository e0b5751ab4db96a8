"""Attempt ledger as a stream: item state per key, lease expiry by event time, idempotent enqueue."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, functions as F, types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..operators.contracts import enqueue
from ..operators.ledger import CHANGES, NAMES, Item, apply_event, expire

STATE_SCHEMA = "items array<struct<work_id string, state string, attempts int, worker_id string, lease_expires_at double, max_attempts int>>"
#: Groups of items that share a state: every call to the store is a round trip, and a group costs as many as an item alone.
BUCKETS = 2048
#: The store that keeps the state of ``transformWithState`` queries.
STATE_STORE = {"spark.sql.streaming.stateStore.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"}


class _Ledger(StatefulProcessor):
    """The items of one bucket and one timer, at the end of the first lease to pass."""

    def __init__(self, max_attempts: int):
        self.max_attempts = max_attempts

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.stored = handle.getValueState("items", STATE_SCHEMA)

    def _items(self) -> dict[str, Item]:
        stored = self.stored.get()
        return {work: Item(*item) for work, *item in stored[0]} if stored else {}

    def _keep(self, items: dict[str, Item]) -> None:
        first = min((item.lease_expires_at for item in items.values() if item.state == "running"), default=None)
        due = None if first is None else math.ceil(first * 1000)
        set_ = list(self.handle.listTimers())
        for at in set_:
            if at != due:
                self.handle.deleteTimer(at)
        if due is not None and due not in set_:
            self.handle.registerTimer(due)
        self.stored.update(([(work, *item) for work, item in items.items()],))

    def handleInitialState(self, key, initialState, timerValues) -> None:
        new = {work: Item("pending", 0, None, None, int(limit)) for work, limit in zip(initialState["work_id"], initialState["max_attempts"])}
        self._keep({**self._items(), **new})

    def handleInputRows(self, key, rows, timerValues):
        items, out = self._items(), []
        # a micro-batch holds few events of one bucket
        for event in pd.concat(list(rows)).sort_values(["at", "seq"]).itertuples(index=False):
            item = items.get(event.work_id) or Item("pending", 0, None, None, self.max_attempts)
            items[event.work_id], changes = apply_event(item, event)
            out += [(event.work_id, *c) for c in changes]
        self._keep(items)
        yield pd.DataFrame(out, columns=NAMES)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        items, out = self._items(), []
        # all leases that the watermark has passed, as a timer set now would wait for the next micro-batch
        now = max(timerValues.getCurrentWatermarkInMs(), expiredTimerInfo.getExpiryTimeInMs()) / 1000
        for work, item in items.items():
            items[work], changes = expire(item, now)
            out += [(work, *c) for c in changes]
        self._keep(items)
        yield pd.DataFrame(out, columns=NAMES)

    def close(self) -> None:
        pass


def ledger_changes(events: DataFrame, lateness: str = "10 minutes", max_attempts: int = 3, items: DataFrame | None = None,
                   buckets: int = BUCKETS) -> DataFrame:
    """Stream of state changes per work item, by the rule of ``operators.ledger``.

    ``events``: ts, work_id, seq, kind, worker_id, at (epoch seconds), lease_seconds, status. State is
    five values an item, kept and read by ``buckets`` of items, each with a timer at its first lease end,
    so a lease ends once the watermark passes it, without any event of the item. ``items`` (work_id,
    max_attempts) is the initial state, a batch table; other items may be claimed ``max_attempts``
    times. A checkpoint goes with its number of buckets. The session needs the settings of ``STATE_STORE``.
    """
    work = F.col("work_id").cast("string")
    bucket = F.pmod(F.xxhash64(work), F.lit(buckets)).cast("int").alias("bucket")
    keyed = events.withWatermark("ts", lateness).select(
        bucket, "ts", work.alias("work_id"), "seq", "kind", "worker_id", F.col("at").cast("double").alias("at"),
        F.col("lease_seconds").cast("double").alias("lease_seconds"), "status").groupBy("bucket")
    first = None if items is None else items.select(bucket, work.alias("work_id"), F.col("max_attempts").cast("int").alias("max_attempts")).groupBy("bucket")
    return keyed.transformWithStateInPandas(_Ledger(max_attempts), CHANGES, "append", "eventtime", initialState=first)


def enqueue_stream(items: DataFrame, folder: str, progress: str, doc: str = "document"):
    """Adds each micro-batch of (``work_id``, ``doc``) to the stored items of ``folder``; starts and returns the query.

    Known ids with the same identity are ignored, another identity is written to ``folder/conflicts``.
    Ids live in the stored table, not in the stream's state. A batch writes folders of its own number
    and reads those of lower numbers, so a batch that is repeated after a failure changes nothing.
    """
    schema = items.schema

    def step(batch: DataFrame, number: int) -> None:
        new, clash = enqueue(stored_items(batch.sparkSession, folder, schema, number), batch, doc)
        new.write.mode("overwrite").parquet(f"{folder}/items/batch={number}")
        clash.write.mode("overwrite").parquet(f"{folder}/conflicts/batch={number}")

    return items.writeStream.foreachBatch(step).option("checkpointLocation", progress).trigger(availableNow=True).start()


def stored_items(spark, folder: str, schema, before: int | None = None) -> DataFrame:
    """The items stored in ``folder``, of batches before one, or all; a folder without any is empty."""
    try:
        found = spark.read.schema(T.StructType([*schema.fields, T.StructField("batch", T.IntegerType())])).parquet(f"{folder}/items")
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)
    return (found if before is None else found.where(F.col("batch") < before)).drop("batch")


def idempotent_enqueue(items: DataFrame) -> DataFrame:
    """First arrival of every work id; repeats are dropped however late they come.

    Ids are kept for good in the stream's state: a row per id. No watermark is set, as it would forget them.
    """
    return items.dropDuplicates(["work_id"])


def enqueue_conflicts(items: DataFrame) -> DataFrame:
    """Work ids that arrive with more than one identity, however far apart: an error to report.

    For the output modes complete and update; the identities are kept for good, two per id.
    """
    return (items.groupBy("work_id").agg(F.min("identity").alias("low"), F.max("identity").alias("high"))
            .where("low <> high").select("work_id"))
