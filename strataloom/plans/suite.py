"""Benchmark dataflow: funnel, stratified selection, identity, companion FASTA and its audit."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, functions as F

from ..functions import text as X
from ..functions.canonical import canonical_text, text_identity
from ..operators import audit, greedy as G
from ..sources import sinks


def make_suite(targets: DataFrame, splits: DataFrame, low: int, high: int, n_bins: int, count: int, seed: int) -> dict[str, DataFrame]:
    """``records``, ``bins`` and ``funnel`` of a suite drawn from the valid split.

    ``targets``: chain_id, cluster, sequence, hash, deposition, resolution.
    """
    bins = G.length_bins(low, high, n_bins)
    rows = targets.withColumn("sequence", F.upper("sequence")).withColumn("length", F.length("sequence")).withColumn(
        "sequence_sha256", F.sha2("sequence", 256)).join(splits.where("split = 'valid'").select("cluster", "split"), "cluster", "left")
    steps = [("valid_split_rows", F.col("split") == "valid"), ("length_eligible_rows", F.col("length").between(low, high)),
             ("canonical_rows", F.col("sequence").rlike(f"^[{X.CANONICAL}]+$"))]
    rank = [X.rank_hash(seed, F.col("chain_id"), F.col("sequence_sha256")), F.col("chain_id")]
    funnel = G.eligibility_funnel(rows, steps, ("cluster", "sequence_sha256"), rank)
    eligible = rows.where(steps[0][1] & steps[1][1] & steps[2][1]).drop("split")
    records = G.stratified_pick(eligible, "chain_id", "length", "cluster", "sequence_sha256", bins, count, seed)
    per_bin = G.greedy_unique(eligible.withColumn("label", G.bin_label(F.col("length"), bins)), rank, ("cluster", "sequence_sha256"), ["label"]).groupBy(
        "label").agg(F.count("*").alias("eligible"))
    table = targets.sparkSession.createDataFrame(bins, "label string, min_length int, max_length int")
    picked = records.groupBy(F.col("length_bin").alias("label")).agg(F.count("*").alias("selected"))
    summary = table.join(per_bin, "label", "left").join(picked, "label", "left").na.fill(0, ["eligible", "selected"])
    return {"records": records, "bins": summary, "funnel": funnel}


def suite_identity(records: DataFrame, selection: dict) -> str:
    """Id of a suite from its selection and its at most 1000 records."""
    rows = [json.loads(r[0]) for r in records.orderBy("record_id").select(
        F.to_json(F.struct("record_id", "chain_id", "cluster", "sequence_sha256", "length", "length_bin"))).limit(G.MAX_PICKS + 1).collect()]
    if len(rows) > G.MAX_PICKS:
        raise ValueError("not a suite")
    return "pdb-valid-" + text_identity(canonical_text({"selection": selection, "records": rows}))[:20]


def publish_suite(suite: dict[str, DataFrame], folder: str) -> None:
    suite["records"].write.mode("overwrite").parquet(f"{folder}/records")
    suite["bins"].coalesce(1).write.mode("overwrite").parquet(f"{folder}/bins")
    sinks.write_fasta(suite["records"].coalesce(1), f"{folder}/fasta", "record_id", "chain_id", "cluster", "sequence")


def verify_suite(spark, folder: str, count: int, low: int, high: int) -> DataFrame:
    """Audit of a published suite, companion FASTA included."""
    from ..sources.tables import read_fasta

    records, bins = spark.read.parquet(f"{folder}/records"), spark.read.parquet(f"{folder}/bins")
    fasta = read_fasta(spark, f"{folder}/fasta").select(F.element_at(F.split("header", " "), 1).alias("record_id"), "sequence")
    both = records.select("record_id", "sequence")
    from ..operators.expect import expect_empty, set_difference
    return audit.suite_audit(records, bins, count, low, high).unionByName(expect_empty({"companion_fasta": set_difference(both, fasta)}))
