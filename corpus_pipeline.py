"""The corpus pipeline: toxicity, line dedup, n-gram Jaccard join, benchmark decontamination, source mixing.

Each stage takes ``(spark, docs, sf_dir)`` and returns what it keeps, with the columns of ``docs``;
the last adds ``tokens``, ``topic``, ``rate`` and ``copies``. NULLs in any column, empty and long
texts, repeated rows and extra columns pass through as the operators' docstrings say; no stage
drops a row for them, but the last, which keeps the rows it draws (rows without text have no tokens to draw).
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession, functions as F

from strataloom.llm import decontamination, jaccard_join, line_dedup, mixing, toxicity
from strataloom.llm.common import TEXT_BATCH_ROWS, prepare
from strataloom.session import checkpoint_dir


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that score 0.7 or more; the model learns from the labels that are not held out."""
    prepare(spark, TEXT_BATCH_ROWS)
    return toxicity.without_toxic(docs, toxicity.train(docs, _table(spark, sf_dir, "labels")))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts later matching lines; a document of which no word is left goes."""
    prepare(spark)
    return line_dedup.without_repeats(docs, least_tokens=1)


def jaccard_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps one document of each class of near duplicates."""
    prepare(spark)
    return jaccard_join.one_of_each(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that hold a benchmark window."""
    prepare(spark)
    return decontamination.decontaminate(docs, _table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Draws documents by the raked source, language and topic weights."""
    prepare(spark)
    return mixing.mix(docs, mixing.mixing_rates(docs)).where(F.col("copies") > 0)


STAGES = [
    ("toxicity", toxicity_stage),
    ("line dedup", line_dedup_stage),
    ("n-gram Jaccard join", jaccard_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
]
#: The first stage is a trained model, which SQL cannot express; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what a stage returns is written and read again by the next one."""
    docs = _table(spark, sf_dir, "documents")
    folder = f"{checkpoint_dir(spark)}/pipeline-{uuid.uuid4().hex}"
    for k, (_, stage) in enumerate(STAGES):
        out = stage(spark, docs, sf_dir)
        if k == len(STAGES) - 1:
            return out
        out.write.parquet(f"{folder}/{k}")
        docs = spark.read.parquet(f"{folder}/{k}")
    return docs
