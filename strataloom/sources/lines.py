"""Text lines with their position in the file, without a single-task pass."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window as W, functions as F


def numbered_lines(spark: SparkSession, path: str) -> DataFrame:
    """(file, line, value): 1-based line numbers per file.

    Each split numbers its own lines; the splits of a file are then offset by the line counts
    of the splits before them, which is one small row per split.
    """
    lines = spark.read.text(path).select(
        "value", F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("__block"), F.monotonically_increasing_id().alias("__id"))
    blocks = lines.groupBy("file", "__block").agg(F.count("*").alias("__n"), F.min("__id").alias("__first"))
    before = W.partitionBy("file").orderBy("__block").rowsBetween(W.unboundedPreceding, -1)
    offsets = blocks.select("file", "__block", "__first", F.coalesce(F.sum("__n").over(before), F.lit(0)).alias("__before"))
    return lines.join(offsets, ["file", "__block"]).select(
        "file", (F.col("__before") + F.col("__id") - F.col("__first") + 1).alias("line"), "value")


def last_per(df: DataFrame, keys: list[str], line: str = "line") -> DataFrame:
    """The row with the highest line number per key: later lines win."""
    rest = [c for c in df.columns if c not in keys]
    return df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.col(line)).alias("__r")).select(
        *keys, *[F.col(f"__r.{c}").alias(c) for c in rest])
