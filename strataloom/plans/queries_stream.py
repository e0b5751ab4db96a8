"""Streaming queries: the events table read as a stream to its end, result written and read back."""

from __future__ import annotations

import uuid
from contextlib import contextmanager

from pyspark.sql import DataFrame, functions as F

from ..session import checkpoint_dir
from ..streaming import incremental as I, ledger as L
from .queries_audit import LEDGER_SQL, ledger_events, ledger_items
from .registry import query


def _stream(t, table: str) -> DataFrame:
    """The table as a stream: a folder of files, or one file, which a stream finds by its name beside others."""
    path, stream = f"{t.folder}/{table}.parquet", t.spark.readStream.schema(getattr(t, table).schema)
    if I.is_folder(t.spark, path):
        return stream.parquet(path)
    return stream.option("pathGlobFilter", f"{table}.parquet").parquet(t.folder)


def _finish(t, stream: DataFrame, mode: str) -> DataFrame:
    """Run a stream over what there is; complete results replace each other, others add up."""
    out = f"{checkpoint_dir(t.spark)}/stream-{uuid.uuid4().hex}"
    write = "overwrite" if mode == "complete" else "append"

    def step(batch: DataFrame, _: int) -> None:
        batch.write.mode(write).parquet(f"{out}/rows")

    stream.writeStream.outputMode(mode).foreachBatch(step).option("checkpointLocation", f"{out}/progress").trigger(
        availableNow=True).start().awaitTermination()
    return t.spark.read.parquet(f"{out}/rows")


@query("stream_running_summary", """
SELECT event_type, count(*) AS records, count(*) FILTER (value >= 20) AS succeeded, count(*) FILTER (value < 20) AS failed, round(avg(value), 6) AS mean_value
FROM events GROUP BY 1""")
def stream_running_summary(t):
    events = _stream(t, "events").select("event_type", "value", F.when(F.col("value") >= 20, "succeeded").otherwise("failed").alias("status"))
    return _finish(t, I.running_summary(events, ["event_type"], ["value"]), "complete").withColumn("mean_value", F.round("mean_value", 6))


@query("stream_best_epoch", """
SELECT user_id AS run, arg_min(event_id, value * 1e12 + event_id) AS best_epoch, min(value) AS best_loss, max(event_id) AS latest_epoch FROM events GROUP BY 1""")
def stream_best_epoch(t):
    events = _stream(t, "events").select(F.col("user_id").alias("run"), F.col("event_id").alias("epoch"), F.col("value").alias("valid_loss"))
    return _finish(t, I.best_epoch_stream(events), "complete")


@query("stream_resume", "SELECT doc_id, 'succeeded' AS status FROM documents")
def stream_resume(t):
    """Every document processed once, whatever batches it comes in."""
    folder = f"{checkpoint_dir(t.spark)}/resume-{uuid.uuid4().hex}"
    done = lambda todo: todo.withColumn("status", F.lit("succeeded"))
    I.stream_resume(_stream(t, "documents").select("doc_id"), folder, "run", ["doc_id"], done, f"{folder}/progress").awaitTermination()
    return t.spark.read.parquet(f"{folder}/results").select("doc_id", "status")


@query("stream_enqueue", """
WITH i AS (SELECT user_id::VARCHAR AS work_id, (json_extract(props, '$.k')::BIGINT % 2)::VARCHAR AS parity FROM events),
g AS (SELECT work_id, min(parity) AS lo, max(parity) AS hi FROM i GROUP BY 1)
SELECT work_id, CASE WHEN hi <> lo THEN 'conflict' ELSE lo END AS outcome FROM g WHERE work_id::BIGINT % 2 = 0
UNION ALL SELECT work_id, CASE WHEN lo <> '0' OR hi <> '0' THEN 'conflict' ELSE 'stored' END FROM g WHERE work_id::BIGINT % 2 = 1""")
def stream_enqueue(t):
    """Events enqueue their user as work; odd users are stored before, with identity 0, and keep it."""
    folder = f"{checkpoint_dir(t.spark)}/enqueue-{uuid.uuid4().hex}"
    work = lambda df: df.select(F.col("user_id").cast("string").alias("work_id"), F.concat(
        F.lit('{"k":'), (F.get_json_object("props", "$.k").cast("bigint") % 2).cast("string"), F.lit("}")).alias("document"))
    before = t.events.where("user_id % 2 = 1").select(F.col("user_id").cast("string").alias("work_id"), F.lit('{"k":0}').alias("document")).distinct()
    before.write.parquet(f"{folder}/items/batch=-1")
    L.enqueue_stream(work(_stream(t, "events")), folder, f"{folder}/progress").awaitTermination()
    clash = t.spark.read.schema("work_id string").parquet(f"{folder}/conflicts").select("work_id", F.lit("conflict").alias("outcome")).distinct()
    known = t.spark.read.schema("work_id string, document string, batch int").parquet(f"{folder}/items").select(
        "work_id", F.when(F.col("batch") < 0, "stored").otherwise(F.get_json_object("document", "$.k")).alias("outcome"))
    return known.join(clash, "work_id", "left_anti").union(clash)


@query("stream_ledger", LEDGER_SQL.format(now="(SELECT epoch_us(max(ts)) // 1000 / 1000 - 3600 FROM events)") + """
SELECT work_id::VARCHAR AS work_id, attempt, tm AS at, seq, change, state FROM changes""")
def stream_ledger(t):
    """Every change of state of the events read as a ledger; leases end as the watermark passes them."""
    with _settings(t.spark, L.STATE_STORE):
        changes = _finish(t, L.ledger_changes(ledger_events(_stream(t, "events")), "1 hour", items=ledger_items(t.events)), "append")
    return changes.select("work_id", "attempt", "at", "seq", "change", "state")


@contextmanager
def _settings(spark, values: dict[str, str]):
    """Session settings for as long as a query runs."""
    before = {k: spark.conf.get(k, None) for k in values}
    for k, v in values.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)
