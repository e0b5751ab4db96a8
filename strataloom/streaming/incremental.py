"""Resumable evaluation, incremental ingest, running summaries and the run binding guard."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession, functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.audit import pending

FILE_SCHEMA = "path string, modificationTime timestamp, length bigint, content binary"


class RunMismatch(RuntimeError):
    """A stored run has another identity than the current inputs."""


def _exists(spark: SparkSession, path: str) -> bool:
    jvm = spark._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).exists(target)


def is_folder(spark: SparkSession, path: str) -> bool:
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(target).isDirectory()


def bind_run(spark: SparkSession, folder: str, identity: str) -> None:
    """Allow appends to ``folder`` only under the identity it was started with."""
    path = f"{folder}/run"
    if _exists(spark, path):
        stored = spark.read.json(path).select("identity").first()[0]
        if stored != identity:
            raise RunMismatch(f"{folder} belongs to run {stored}")
    else:
        spark.createDataFrame([(identity,)], "identity string").coalesce(1).write.json(path)


def resume(
    spark: SparkSession, work: DataFrame, folder: str, identity: str, keys: Sequence[str],
    process: Callable[[DataFrame], DataFrame], retry_failed: bool = False,
) -> DataFrame:
    """Process the work rows without a valid result in ``folder`` and append their results.

    ``process`` maps work rows to result rows with ``keys`` and ``status``. Results carry the run
    identity; a stored row of another identity does not count as done. Returns all valid results;
    the newest result of a key is the valid one.
    """
    bind_run(spark, folder, identity)
    path = f"{folder}/results"
    todo = work
    if _exists(spark, path):
        done = latest_results(spark.read.parquet(path).where(F.col("run_identity") == identity), keys)
        todo = pending(work, done, keys, retry_failed)
    fresh = process(todo).withColumn("run_identity", F.lit(identity)).withColumn("finished_at", F.current_timestamp())
    fresh.write.mode("append").parquet(path)
    return latest_results(spark.read.parquet(path).where(F.col("run_identity") == identity), keys)


def latest_results(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    rest = [c for c in results.columns if c not in keys]
    return results.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col("finished_at")).alias("__r")).select(
        *keys, *[F.col(f"__r.{c}").alias(c) for c in rest])


def stream_resume(
    work: DataFrame, folder: str, identity: str, keys: Sequence[str],
    process: Callable[[DataFrame], DataFrame], checkpoint: str, **options: str,
) -> StreamingQuery:
    """The same as a stream: every micro-batch is checked against the results already there, so a
    replayed batch adds nothing."""
    def step(batch: DataFrame, _: int) -> None:
        resume(batch.sparkSession, batch.dropDuplicates(list(keys)), folder, identity, keys, process)

    return work.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).options(**options).trigger(availableNow=True).start()


def ingest_files(spark: SparkSession, root: str, pattern: str = "*.cif*") -> DataFrame:
    """Stream of files that appeared below ``root`` since the last run, with their contents."""
    return (spark.readStream.format("binaryFile").schema(FILE_SCHEMA).option("recursiveFileLookup", True)
            .option("pathGlobFilter", pattern).load(root))


def run_available(stream: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Process what has arrived and stop; progress is kept in ``checkpoint``."""
    return stream.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def running_summary(results: DataFrame, by: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """Counts and means per group, refreshed with every batch (output mode ``complete``)."""
    return results.groupBy(*by).agg(
        F.count("*").alias("records"), F.count_if(F.col("status") == "succeeded").alias("succeeded"),
        F.count_if(F.col("status") == "failed").alias("failed"), *[F.avg(m).alias(f"mean_{m}") for m in metrics])


def best_epoch_stream(metrics: DataFrame, run: str = "run", epoch: str = "epoch", loss: str = "valid_loss") -> DataFrame:
    """Best epoch per run so far (output mode ``complete`` or ``update``)."""
    return metrics.groupBy(run).agg(
        F.min(F.struct(loss, epoch)).alias("__b"), F.max(epoch).alias("latest_epoch")).select(
        run, F.col(f"__b.{epoch}").alias("best_epoch"), F.col(f"__b.{loss}").alias("best_loss"), "latest_epoch")
