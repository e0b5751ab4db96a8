"""Streams against their batch twins."""

import pytest
from pyspark.sql import functions as F

from strataloom.operators.ledger import ledger_changes
from strataloom.streaming import incremental as I, ledger as L

EVENTS = "ts timestamp, work_id string, seq bigint, kind string, worker_id string, at double, lease_seconds double, status string"


def run(spark, stream, name, mode="append"):
    q = stream.writeStream.format("memory").queryName(name).outputMode(mode).trigger(availableNow=True).start()
    q.awaitTermination()
    return spark.table(name).collect()


def put(spark, path, rows, n):
    df = spark.createDataFrame([(*r,) for r in rows], EVENTS.replace("ts timestamp", "t double")).withColumn("ts", F.timestamp_seconds("t")).drop("t")
    df.select("ts", "work_id", "seq", "kind", "worker_id", "at", "lease_seconds", "status").coalesce(1).write.mode("append").parquet(str(path))


def event(at, work, seq, kind, worker, lease=None, status=None):
    return (1000.0 + at, work, seq, kind, worker, 1000.0 + at, lease, status)


@pytest.fixture
def state_store(spark):
    for k, v in L.STATE_STORE.items():
        spark.conf.set(k, v)
    yield
    for k in L.STATE_STORE:
        spark.conf.unset(k)


def test_ledger_stream(spark, tmp_path, state_store):
    src = tmp_path / "ev"
    put(spark, src, [event(0, "w", 1, "claim", "a", 10.0), event(1, "v", 2, "claim", "a", 100.0), event(2, "v", 3, "renew", "b", 100.0),
                     event(3, "v", 4, "finish", "a", None, "retryable"), event(4, "v", 5, "claim", "b", 100.0), event(5, "v", 6, "finish", "b", None, "succeeded"),
                     event(6, "v", 7, "claim", "c", 10.0)], 0)
    put(spark, src, [event(5000, "z", 8, "claim", "a", 1e6)], 1)
    put(spark, src, [event(9000, "z", 9, "renew", "a", 1e6)], 2)
    put(spark, src, [event(9500, "z", 10, "renew", "a", 1e6)], 3)
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(src))
    rows = run(spark, L.ledger_changes(stream, "10 seconds", max_attempts=2), "ledger_out")
    v = [(r["change"], r["state"]) for r in rows if r["work_id"] == "v"]
    assert v == [("claimed", "running"), ("retryable", "pending"), ("claimed", "running"), ("succeeded", "completed")]
    # the lease of w passes without any event of w
    assert [(r["change"], r["state"], r["attempt"]) for r in rows if r["work_id"] == "w"] == [("claimed", "running", 1), ("lease_expired", "pending", 1)]


def test_ledger_stream_equals_batch(spark, tmp_path, state_store):
    """Random histories in several micro-batches, limits from a table: the same changes as the batch rule at the last watermark."""
    import random

    rng, rows = random.Random(9), []
    for k in range(600):
        kind = rng.choice(["claim", "claim", "renew", "finish"])
        rows.append(event(7.0 * k, f"w{rng.randrange(12)}", k, kind, f"a{rng.randrange(2)}", rng.choice([0.0, 5.0, 200.0, 900.0]), rng.choice(["succeeded", "failed", "retryable", "retryable", "retryable"])))
    for part in range(3):
        put(spark, tmp_path / "ev", rows[200 * part:200 * part + 200], part)
    items = spark.createDataFrame([(f"w{k}", 1 + k) for k in range(12)], "work_id string, max_attempts int")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "ev"))
    got = run(spark, L.ledger_changes(stream, "60 seconds", items=items), "ledger_equal")
    batch = ledger_changes(spark.read.schema(EVENTS).parquet(str(tmp_path / "ev")), items, 1000.0 + 7.0 * 599 - 60)
    plain = lambda rows: sorted((r["work_id"], r["attempt"], r["at"], r["seq"], r["change"], r["state"], str(r["worker_id"])) for r in rows)
    assert plain(got) == plain(batch.collect())


def test_ledger_stream_keeps_items_by_bucket(spark, tmp_path, state_store):
    """Sixty items in four buckets: a state and a timer a bucket, the changes those of the batch; a lease may end between two milliseconds."""
    rows = [event(float(k), f"w{k}", k, "claim", "a", 50.0004 + k % 7) for k in range(60)] + [event(70.0, "w59", 60, "finish", "a", None, "succeeded")]
    put(spark, tmp_path / "ev", rows[:40], 0)
    put(spark, tmp_path / "ev", rows[40:], 1)
    put(spark, tmp_path / "ev", [event(90.0, "w0", 61, "claim", "b", 500.0)], 2)
    items = spark.createDataFrame([(f"w{k}", 1 + k % 3) for k in range(60)], "work_id string, max_attempts int")
    stream = spark.readStream.schema(EVENTS).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "ev"))
    q = L.ledger_changes(stream, "5 seconds", items=items, buckets=4).writeStream.format("memory").queryName("ledger_buckets").outputMode("append").trigger(availableNow=True).start()
    q.awaitTermination()
    batch = ledger_changes(spark.read.schema(EVENTS).parquet(str(tmp_path / "ev")), items, 1085.0)
    plain = lambda rows: sorted((r["work_id"], r["attempt"], r["at"], r["seq"], r["change"], r["state"]) for r in rows)
    assert plain(spark.table("ledger_buckets").collect()) == plain(batch.collect())
    assert 0 < max(p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress if p["stateOperators"]) <= 4 * 3  # a value and two rows of a timer


def test_enqueue_stream(spark, tmp_path):
    """Stored ids, a stored identity that differs, a repeat in a later batch, and a batch that runs twice."""
    schema = "work_id string, document string"
    src, folder = tmp_path / "src", str(tmp_path / "work")
    spark.createDataFrame([("old", '{"k": 1}'), ("known", '{"k": 1}')], schema).write.parquet(f"{folder}/items/batch=-1")
    for rows in ([("old", '{"k": 2}'), ("known", '{"k": 1}'), ("n1", '{"k": 1, "z": 2}'), ("n1", '{"z": 2, "k": 1}')], [("n1", '{"k": 1, "z": 2}'), ("n2", '{"k": 5}')], [("n2", '{"k": 6}')]):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(src))
        L.enqueue_stream(spark.readStream.schema(schema).parquet(str(src)), folder, str(tmp_path / "progress")).awaitTermination()
    stored = L.stored_items(spark, folder, spark.createDataFrame([], schema).schema)
    assert sorted(r["work_id"] for r in stored.collect()) == ["known", "n1", "n2", "old"]
    assert sorted(r["work_id"] for r in spark.read.parquet(f"{folder}/conflicts").collect()) == ["n2", "old"]
    # a batch that is repeated reads only what came before it, and writes the same
    L.enqueue_stream(spark.readStream.schema(schema).parquet(str(src)), folder, str(tmp_path / "again")).awaitTermination()
    again = L.stored_items(spark, folder, stored.schema)
    assert {r["work_id"]: r["document"] for r in again.collect()}["old"] == '{"k": 1}'
    assert L.stored_items(spark, str(tmp_path / "none"), stored.schema).count() == 0


def test_enqueue_is_idempotent(spark, tmp_path):
    df = spark.createDataFrame([(0.0, "w1", "i1"), (1.0, "w1", "i1"), (2.0, "w2", "i1"), (3.0, "w2", "i2")], "t double, work_id string, identity string")
    df.withColumn("ts", F.timestamp_seconds("t")).drop("t").write.parquet(str(tmp_path / "i"))
    schema = "work_id string, identity string, ts timestamp"
    read = lambda: spark.readStream.schema(schema).parquet(str(tmp_path / "i"))
    assert len(run(spark, L.idempotent_enqueue(read()), "enq")) == 2
    clash = L.enqueue_conflicts(read())
    assert [r["work_id"] for r in run(spark, clash, "clash", "complete")] == ["w2"]


def test_enqueue_keeps_ids_for_good(spark, tmp_path):
    """A repeat and a second identity days after the first arrival, in later micro-batches."""
    for day, work, identity in [(0, "w1", "i1"), (0, "w2", "i1"), (3, "w3", "i1"), (6, "w4", "i1"), (9, "w1", "i1"), (9, "w2", "i2")]:
        spark.createDataFrame([(86400.0 * day, work, identity)], "t double, work_id string, identity string").select(
            "work_id", "identity", F.timestamp_seconds("t").alias("ts")).coalesce(1).write.mode("append").parquet(str(tmp_path / "i"))
    read = lambda: spark.readStream.schema("work_id string, identity string, ts timestamp").option("maxFilesPerTrigger", 1).parquet(str(tmp_path / "i"))
    assert sorted(r["work_id"] for r in run(spark, L.idempotent_enqueue(read()), "enq_late")) == ["w1", "w2", "w3", "w4"]
    assert [r["work_id"] for r in run(spark, L.enqueue_conflicts(read()), "clash_late", "complete")] == ["w2"]


def test_resume_processes_only_what_is_open(spark, tmp_path):
    work = spark.createDataFrame([(i,) for i in range(6)], "id int")
    seen = []

    def process(todo):
        seen.append(sorted(r["id"] for r in todo.collect()))
        return todo.withColumn("status", F.when(F.col("id") == 3, "failed").otherwise("succeeded"))

    folder = str(tmp_path / "run")
    I.resume(spark, work.where("id < 4"), folder, "identity-1", ["id"], process)
    out = I.resume(spark, work, folder, "identity-1", ["id"], process)
    I.resume(spark, work, folder, "identity-1", ["id"], process, retry_failed=True)
    assert seen == [[0, 1, 2, 3], [4, 5], [3]] and out.count() == 6
    with pytest.raises(I.RunMismatch):
        I.resume(spark, work, folder, "identity-2", ["id"], process)


def test_stream_resume_and_ingest(spark, tmp_path):
    spark.createDataFrame([(1,), (2,), (2,)], "id int").write.parquet(str(tmp_path / "w"))
    go = lambda: I.stream_resume(spark.readStream.schema("id int").parquet(str(tmp_path / "w")), str(tmp_path / "r"), "x", ["id"],
                                 lambda d: d.withColumn("status", F.lit("succeeded")), str(tmp_path / "c")).awaitTermination()
    go()
    spark.createDataFrame([(2,), (3,)], "id int").write.mode("append").parquet(str(tmp_path / "w"))
    go()
    assert sorted(r["id"] for r in spark.read.parquet(str(tmp_path / "r/results")).collect()) == [1, 2, 3]
    raw = tmp_path / "raw"
    raw.mkdir()
    got = []
    step = lambda df, _: got.append(sorted(r["path"].rsplit("/", 1)[1] for r in df.select("path").collect()))
    for name in ("1abc-assembly1.cif", "2abc-assembly1.cif"):
        (raw / name).write_text("data_X\n")
        I.run_available(I.ingest_files(spark, str(raw)), step, str(tmp_path / "ic")).awaitTermination()
    assert [g for g in got if g] == [["1abc-assembly1.cif"], ["2abc-assembly1.cif"]]


def test_running_summary_and_best_epoch(spark, tmp_path):
    spark.createDataFrame([("a", "succeeded", 1.0), ("a", "failed", None), ("b", "succeeded", 3.0)], "g string, status string, m double").write.parquet(str(tmp_path / "s"))
    s = spark.readStream.schema("g string, status string, m double").parquet(str(tmp_path / "s"))
    rows = {r["g"]: (r["records"], r["succeeded"], r["failed"], r["mean_m"]) for r in run(spark, I.running_summary(s, ["g"], ["m"]), "summ", "complete")}
    assert rows == {"a": (2, 1, 1, 1.0), "b": (1, 1, 0, 3.0)}
    spark.createDataFrame([("r", 1, 0.5), ("r", 2, 0.4), ("r", 3, 0.4)], "run string, epoch int, valid_loss double").write.json(str(tmp_path / "e"))
    e = spark.readStream.schema("run string, epoch int, valid_loss double").json(str(tmp_path / "e"))
    assert [(r["best_epoch"], r["best_loss"], r["latest_epoch"]) for r in run(spark, I.best_epoch_stream(e), "best", "complete")] == [(2, 0.4, 3)]


def test_stream_of_a_table_in_parts(spark, tmp_path):
    """A table is one file or a folder of part files."""
    from strataloom.plans import load_queries
    from strataloom.plans.registry import QUERIES

    load_queries()
    spark.createDataFrame([(k,) for k in range(9)], "doc_id bigint").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    assert sorted(r["doc_id"] for r in QUERIES["stream_resume"](spark, str(tmp_path)).collect()) == list(range(9))
