"""Writers: lists, splits, indexes, outcomes, manifests, FASTA, ledgers and sharded tables."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as X


def write_targets(rows: DataFrame, path: str) -> None:
    """Target list as sorted CSV parts with a header; part order is chain order."""
    rows.orderBy("CHAINID").write.mode("overwrite").csv(path, header=True)


def write_split_files(splits: DataFrame, folder: str, cluster: str = "cluster", split: str = "split") -> None:
    """Valid and test cluster ids, sorted, one per line; train is what is in neither."""
    for name in ("valid", "test"):
        splits.where(F.col(split) == name).select(cluster).distinct().orderBy(cluster).select(
            F.col(cluster).cast("string").alias("value")).write.mode("overwrite").text(f"{folder}/{name}_clusters")


def chain_index(rows: DataFrame, columns: Sequence[str]) -> DataFrame:
    return rows.select("chain_id", "entry_id", "cluster", *columns)


def record_index(rows: DataFrame, extra: Sequence[Column] = ()) -> DataFrame:
    """One row per entry: its chains and the set of their clusters, both sorted."""
    return rows.groupBy("entry_id").agg(
        F.array_sort(F.collect_list("chain_id")).alias("chains"),
        F.array_sort(F.collect_set("cluster")).alias("clusters"), *extra)


def write_index(df: DataFrame, path: str, order: Sequence[str]) -> None:
    """Index sorted by key, so that look-ups prune by statistics."""
    df.repartitionByRange(*order).sortWithinPartitions(*order).write.mode("overwrite").parquet(path)


def write_outcomes(outcomes: DataFrame, path: str) -> None:
    """One folder per status: ok, skipped, failed, deferred, quarantined."""
    outcomes.write.mode("overwrite").partitionBy("status").parquet(path)


def outcome_histogram(outcomes: DataFrame, status: str = "status", reason: str = "reason") -> DataFrame:
    """Rows per reason, with ``ok`` for kept ones."""
    return outcomes.groupBy(F.when(F.col(status) == "ok", "ok").otherwise(F.col(reason)).alias("outcome")).agg(
        F.count("*").alias("n"))


def build_manifest(outcomes: DataFrame, filters: dict[str, object], totals: DataFrame | None = None) -> DataFrame:
    """One-row build record: filters, totals and the outcome histogram as a sorted map."""
    histogram = outcome_histogram(outcomes)
    row = histogram.agg(
        F.sum("n").alias("inputs"),
        F.map_from_entries(F.array_sort(F.collect_list(F.struct("outcome", "n")))).alias("outcomes"))
    for key, value in filters.items():
        row = row.withColumn(f"filter_{key}", F.lit(value))
    return row if totals is None else row.crossJoin(totals)


def to_json_row(df: DataFrame, out: str = "json") -> DataFrame:
    return df.select(F.to_json(F.struct("*")).alias(out))


def fasta_lines(df: DataFrame, record: str, chain: str, cluster: str, sequence: str, width: int = 80) -> DataFrame:
    """One FASTA text per record: header, then lines of ``width``."""
    return df.select(F.col(record), X.fasta_record(
        F.col(record), F.col(chain), F.col(cluster), F.col(sequence), width).alias("value"))


def write_fasta(df: DataFrame, path: str, record: str, chain: str, cluster: str, sequence: str) -> None:
    fasta_lines(df, record, chain, cluster, sequence).orderBy(record).select("value").write.mode("overwrite").text(path)


def write_json_rows(df: DataFrame, path: str, order: Sequence[str] = ()) -> None:
    """JSON lines; the commit protocol publishes all parts or none."""
    (df.orderBy(*order) if order else df).write.mode("overwrite").json(path)


def export_ledger(items: DataFrame, attempts: DataFrame, folder: str, payload_schema: str = "map<string,string>") -> None:
    """Work items and attempts as ordered JSON lines with payloads and results parsed."""
    write_json_rows(
        items.withColumn("payload", F.from_json("payload", payload_schema)).withColumn(
            "result", F.from_json("result", payload_schema)),
        f"{folder}/work-items", ["created_at", "work_id"])
    write_json_rows(attempts.withColumn("result", F.from_json("result", payload_schema)), f"{folder}/attempts", ["work_id", "attempt"])


def report_rows(df: DataFrame, columns: dict[str, str], order: Sequence[Column], n: int) -> DataFrame:
    """Top-n rows as one formatted text line each: ``name=value`` pairs, missing values as NA."""
    top = df.orderBy(*order).limit(n)
    parts = [F.concat(F.lit(f"{c}="), X.report_value(F.col(c), kind)) for c, kind in columns.items()]
    return top.select(*columns, F.concat_ws(" ", *parts).alias("line"))


def write_shards(df: DataFrame, plan: DataFrame, id: str, path: str) -> None:
    """Rows laid out by planned shard, one folder per shard; payloads meet the plan on the id."""
    placed = df.join(plan.select(id, "shard"), id)
    placed.repartitionByRange("shard").sortWithinPartitions("shard", id).write.mode("overwrite").partitionBy("shard").parquet(path)


def file_checksums(df_binary: DataFrame) -> DataFrame:
    """(path, bytes, sha256) of files read with the binaryFile source."""
    return df_binary.select("path", F.col("length").alias("bytes"), F.sha2("content", 256).alias("sha256"))
