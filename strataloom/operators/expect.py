"""Expectations: named rules over rows and tables, reported as rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, functions as F


class ExpectationFailed(RuntimeError):
    """A rule that must hold does not."""


def expect(df: DataFrame, rules: Mapping[str, Column], id: str | None = None) -> DataFrame:
    """(rule, checked, failed, example): all row rules in one pass. A NULL verdict is a failure."""
    verdict = {name: F.coalesce(rule, F.lit(False)) for name, rule in rules.items()}
    wide = df.agg(
        F.count("*").alias("checked"),
        *[F.count_if(~v).alias(f"f{i}") for i, v in enumerate(verdict.values())],
        *[(F.min(F.when(~v, F.col(id))).cast("string") if id else F.lit(None).cast("string")).alias(f"e{i}")
          for i, v in enumerate(verdict.values())])
    entries = F.array(*[
        F.struct(F.lit(name).alias("rule"), F.col(f"f{i}").alias("failed"), F.col(f"e{i}").alias("example"))
        for i, name in enumerate(verdict)])
    return wide.select("checked", F.explode(entries).alias("r")).select("r.rule", "checked", "r.failed", "r.example")


def expect_empty(violations: Mapping[str, DataFrame]) -> DataFrame:
    """Report over tables that must have no rows: failed is their row count."""
    out = None
    for name, df in violations.items():
        row = df.agg(F.lit(name).alias("rule"), F.count("*").alias("checked"), F.count("*").alias("failed"), F.lit(None).cast("string").alias("example"))
        out = row if out is None else out.unionByName(row)
    return out


def enforce(report: DataFrame) -> DataFrame:
    """Raise with all broken rules of a report (it has a row per rule), else hand it back."""
    broken = report.where("failed > 0").collect()
    if broken:
        raise ExpectationFailed("; ".join(f"{r['rule']}: {r['failed']}" for r in broken))
    return report


def duplicates(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).where("n > 1")


def set_difference(left: DataFrame, right: DataFrame) -> DataFrame:
    """Rows of one table that the other lacks, with the side they are on, copies counted."""
    return left.exceptAll(right).withColumn("side", F.lit("left_only")).unionByName(
        right.exceptAll(left).withColumn("side", F.lit("right_only")))


def close(a: Column, b: Column, absolute: float = 1e-9, relative: float = 1e-9) -> Column:
    return F.abs(a - b) <= F.greatest(F.lit(absolute), F.lit(relative) * F.greatest(F.abs(a), F.abs(b)))
