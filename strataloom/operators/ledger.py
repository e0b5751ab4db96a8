"""The work ledger: one rule for claims, renewals and results, attempts, item states, status counts."""

from __future__ import annotations

from collections import namedtuple

import pandas as pd
from pyspark.sql import DataFrame, functions as F

STATES = ("pending", "running", "completed", "failed")
#: What an item is at one time; ``attempts`` counts the claims it has had.
Item = namedtuple("Item", "state attempts worker_id lease_expires_at max_attempts")
#: The state a finish leads to; any other status is retried while attempts are left.
FINISHED = {"succeeded": "completed", "failed": "failed"}
CHANGES = "work_id string, attempt int, at double, seq bigint, change string, state string, worker_id string, lease_expires_at double"
NAMES = [c.split()[0] for c in CHANGES.split(", ")]


def expire(item: Item, now: float) -> tuple[Item, list[tuple]]:
    """A lease that has passed at ``now`` ends the attempt: the item is pending again, or failed after its last one."""
    if item.state != "running" or item.lease_expires_at > now:
        return item, []
    state = "pending" if item.attempts < item.max_attempts else "failed"
    return (item._replace(state=state, worker_id=None, lease_expires_at=None),
            [(item.attempts, item.lease_expires_at, -1, "lease_expired", state, None, None)])


def apply_event(item: Item, event) -> tuple[Item, list[tuple]]:
    """The item after ``event`` (kind, at, seq, worker_id, lease_seconds, status), and the changes made: the one rule of batch and stream.

    A claim takes a pending item while attempts are left; under a live lease or past the limit it changes
    nothing. Renew and finish need the live lease of the same worker. Leases that have passed end first.
    """
    item, changes = expire(item, event.at)
    if event.kind == "claim":
        if item.state != "pending" or item.attempts >= item.max_attempts:
            return item, changes
        item, change = item._replace(state="running", attempts=item.attempts + 1, worker_id=event.worker_id, lease_expires_at=event.at + event.lease_seconds), "claimed"
    elif item.state != "running" or item.worker_id != event.worker_id:
        return item, changes
    elif event.kind == "renew":
        item, change = item._replace(lease_expires_at=event.at + event.lease_seconds), "renewed"
    else:
        state = FINISHED.get(event.status, "pending" if item.attempts < item.max_attempts else "failed")
        item, change = item._replace(state=state, worker_id=None, lease_expires_at=None), event.status
    return item, [*changes, (item.attempts, event.at, event.seq, change, item.state, item.worker_id, item.lease_expires_at)]


def ledger_changes(events: DataFrame, items: DataFrame, now: float | None = None) -> DataFrame:
    """Every change of state, from whole histories; with ``now``, leases that have passed by then end too.

    ``events``: work_id, seq, kind (claim, renew, finish), worker_id, at (epoch seconds), lease_seconds,
    status. ``items``: work_id, max_attempts; events of other items change nothing. Events are applied
    in the order of (at, seq) as a sorted stream, so a task holds one item's state however long its history.
    """
    doubles = [F.col(c).cast("double").alias(c) for c in ("at", "lease_seconds")]
    rows = events.select(F.col("work_id").cast("string").alias("work_id"), "seq", "kind", "worker_id", *doubles, "status").unionByName(
        items.select(F.col("work_id").cast("string").alias("work_id"), F.col("max_attempts").cast("int").alias("max_attempts")), allowMissingColumns=True)

    def fold(batches):
        work, item = None, None

        def close(out):
            if item is not None and now is not None:
                out += [(work, *c) for c in expire(item, now)[1]]

        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                if row.work_id != work:
                    close(out)
                    work, item = row.work_id, None
                if not pd.isna(row.max_attempts):  # the item sorts before its events
                    item = Item("pending", 0, None, None, int(row.max_attempts))
                elif item is not None:
                    item, changes = apply_event(item, row)
                    out += [(work, *c) for c in changes]
            yield pd.DataFrame(out, columns=NAMES)
        out = []
        close(out)
        yield pd.DataFrame(out, columns=NAMES)

    # NULLs first: the row of the item has neither time nor number
    return rows.repartition("work_id").sortWithinPartitions("work_id", "at", "seq").mapInPandas(fold, CHANGES)


def attempt_table(changes: DataFrame) -> DataFrame:
    """(work_id, attempt, worker_id, claimed_at, lease_expires_at, finished_at, status) of every attempt.

    The lease is that of the last claim or renewal; an attempt without an end is running.
    """
    c = F.col
    place = F.struct("at", "seq")
    leased, ended = c("change").isin("claimed", "renewed"), ~c("change").isin("claimed", "renewed")
    return changes.groupBy("work_id", "attempt").agg(
        F.max(F.when(c("change") == "claimed", c("worker_id"))).alias("worker_id"), F.min(F.when(c("change") == "claimed", c("at"))).alias("claimed_at"),
        F.max_by(F.when(leased, c("lease_expires_at")), F.when(leased, place)).alias("lease_expires_at"),
        F.max(F.when(ended, c("at"))).alias("finished_at"), F.coalesce(F.max(F.when(ended, c("change"))), F.lit("running")).alias("status"))


def item_states(changes: DataFrame, items: DataFrame) -> DataFrame:
    """(work_id, state, attempts, max_attempts, worker_id, lease_expires_at) of every item: what its last change left."""
    ended = ~F.col("change").isin("claimed", "renewed")  # nothing of an attempt follows its end
    last = changes.groupBy("work_id").agg(F.max(F.struct("attempt", ended.alias("ended"), "at", "seq", "state", "worker_id", "lease_expires_at")).alias("__l"))
    return items.select(F.col("work_id").cast("string").alias("work_id"), "max_attempts").join(last, "work_id", "left").select(
        "work_id", F.coalesce("__l.state", F.lit("pending")).alias("state"), F.coalesce("__l.attempt", F.lit(0)).alias("attempts"), "max_attempts",
        F.col("__l.worker_id").alias("worker_id"), F.col("__l.lease_expires_at").alias("lease_expires_at"))


def ledger_status(states: DataFrame) -> DataFrame:
    """Items and attempts per state, all four states present."""
    counted = states.groupBy("state").agg(F.count("*").alias("items"), F.sum("attempts").alias("attempts"))
    names = states.sparkSession.createDataFrame([(s,) for s in STATES], "state string")
    return names.join(counted, "state", "left").select(
        "state", F.coalesce("items", F.lit(0)).alias("items"), F.coalesce("attempts", F.lit(0)).alias("attempts"))
