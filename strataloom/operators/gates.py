"""Comparisons of evaluations and the gates on them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from .expect import close


def delta_table(evaluations: DataFrame, baseline: str, datasets: Sequence[str], metric: str = "nll") -> DataFrame:
    """(label, <dataset>, <dataset>_delta ...): each label against the baseline, datasets as columns.

    Two evaluations of one label and dataset, or no evaluation of the baseline, are an error.
    """
    once = evaluations.groupBy("label", "dataset").agg(F.count("*").alias("__n"), F.max(metric).alias("__v")).select(
        "label", "dataset", F.when(F.col("__n") > 1, F.raise_error(F.concat_ws(" ", F.lit("evaluated twice:"), "label", "dataset")).cast("double")).otherwise(F.col("__v")).alias("__v"))
    wide = once.groupBy("label").pivot("dataset", list(datasets)).agg(F.max("__v"))
    of_base = F.col("label") == baseline
    base = wide.agg(F.count_if(of_base).alias("__n"), *[F.max(F.when(of_base, F.col(d))).alias(f"__{d}") for d in datasets])
    # an aggregate without keys: exactly one row
    known = lambda d: F.when(F.col("__n") == 1, F.col(f"__{d}")).otherwise(F.raise_error(F.lit(f"no evaluation of the baseline {baseline}")).cast("double"))
    return wide.crossJoin(base).select("label", *datasets, *[(F.col(d) - known(d)).alias(f"{d}_delta") for d in datasets])


def gate(evaluations: DataFrame, baseline: str, main: str, guard: str, max_regression: float = 0.001, metric: str = "nll") -> DataFrame:
    """Candidates with ``passed``: better than the baseline on ``main``, and on ``guard`` not worse
    by more than ``max_regression``."""
    table = delta_table(evaluations, baseline, [main, guard], metric).where(F.col("label") != baseline)
    return table.withColumn("passed", F.coalesce(
        (F.col(f"{main}_delta") < 0) & (F.col(f"{guard}_delta") <= max_regression), F.lit(False)))


def select_candidate(gated: DataFrame, main: str) -> DataFrame:
    """The passing candidate with the lowest main metric, ties by label."""
    return gated.where("passed").orderBy(main, "label").limit(1)


def population_match(evaluations: DataFrame, by: Sequence[str] = ("dataset",), expected: DataFrame | None = None) -> DataFrame:
    """Per dataset: all evaluations saw the same ordered ids, and as many as expected."""
    out = evaluations.groupBy(*by).agg(
        F.count("*").alias("evaluations"), (F.min("ids_sha256") == F.max("ids_sha256")).alias("same_ids"),
        (F.min("records") == F.max("records")).alias("same_count"), F.max("records").alias("records"))
    if expected is not None:
        out = out.join(expected.withColumnRenamed("records", "expected_records"), list(by), "left").withColumn(
            "complete", F.col("records") == F.col("expected_records"))
    return out


def promotion_rules(expected_records: dict[str, int], max_regression: float = 0.001, tolerance: float = 1e-12) -> dict[str, Column]:
    """Rules over a promotion row: populations, one checkpoint, deltas recomputed, signs.

    Columns: main_records, guard_records, summary_sha256, checkpoint_sha256, and for main and
    guard: baseline_nll, selected_nll and recorded_delta as ``main_...`` and ``guard_...``.
    """
    c = F.col
    rules = {f"{name}_records": c(f"{name}_records") == n for name, n in expected_records.items()}
    rules["same_checkpoint"] = c("summary_sha256") == c("checkpoint_sha256")
    for name in ("main", "guard"):
        rules[f"{name}_delta"] = F.abs(c(f"{name}_selected_nll") - c(f"{name}_baseline_nll") - c(f"{name}_recorded_delta")) <= tolerance
    rules["main_improves"] = c("main_recorded_delta") < 0
    rules["guard_holds"] = c("guard_recorded_delta") <= max_regression
    return rules


def record_join(designs: DataFrame, experimental: DataFrame, predicted: DataFrame, baseline: DataFrame, key: str) -> DataFrame:
    """Designs with their experimental reference, native prediction and baseline metrics by record.

    ``problem`` names the first reference that is missing.
    """
    tag = lambda df, name: df.select(key, F.struct(*[c for c in df.columns if c != key]).alias(name))
    out = designs
    for name, df in (("experimental", experimental), ("native_prediction", predicted), ("baseline", baseline)):
        out = out.join(tag(df, name), key, "left")
    return out.withColumn("problem", F.coalesce(*[
        F.when(F.col(n).isNull(), f"missing_{n}") for n in ("experimental", "native_prediction", "baseline")]))


def recorded_equals(recorded: Column, recomputed: Column, tolerance: float = 1e-12) -> Column:
    return F.coalesce(close(recorded, recomputed, tolerance, 0.0), F.lit(False))
