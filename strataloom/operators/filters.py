"""Row filters with a recorded reason: the first failing rule of a cascade."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import finite_double


def method_allowed(method: Column, allow: Sequence[str]) -> Column:
    """Any allowed name is a substring of the upper-cased method; an empty list allows all."""
    if not allow:
        return F.lit(True)
    upper = F.upper(F.coalesce(method, F.lit("")))
    names = F.array(*[F.lit(a) for a in allow])
    return F.exists(names, lambda a: F.contains(upper, a))


def date_in_range(date: Column, first: str | None = None, last: str | None = None) -> Column:
    """Inclusive on both sides; a missing date fails."""
    ok = date.isNotNull()
    if first:
        ok = ok & (date >= F.lit(first).cast("date"))
    if last:
        ok = ok & (date <= F.lit(last).cast("date"))
    return F.coalesce(ok, F.lit(False))


def usable_resolution(*candidates: Column) -> Column:
    """First finite positive resolution among the candidates."""
    return F.coalesce(*[F.when(finite_double(c) > 0, finite_double(c)) for c in candidates])


def first_reason(rules: Sequence[tuple[str, Column]]) -> Column:
    """Name of the first rule whose *failure* condition holds; NULL when none does."""
    return F.coalesce(*[F.when(F.coalesce(failed, F.lit(False)), F.lit(name)) for name, failed in rules])


def reason_cascade(df: DataFrame, rules: Sequence[tuple[str, Column]], status: str = "status", reason: str = "reason") -> DataFrame:
    """Adds ``reason`` (first failing rule) and ``status`` (ok or skipped)."""
    return df.withColumn(reason, first_reason(rules)).withColumn(
        status, F.when(F.col(reason).isNull(), "ok").otherwise("skipped"))


def metadata_rules(allow: Sequence[str], first: str | None, last: str | None, max_resolution: float) -> list[tuple[str, Column]]:
    """Cheap rules on index metadata, checked before a file is read. Missing values pass here."""
    resolution = usable_resolution(F.col("resolution"))
    method = F.col("method")
    return [
        ("method", method.isNotNull() & (method != "") & ~method_allowed(method, allow)),
        ("date", F.col("date").isNotNull() & ~date_in_range(F.col("date"), first, last)),
        ("resolution", resolution > max_resolution),
    ]


def content_rules(allow: Sequence[str], first: str | None, last: str | None, max_resolution: float) -> list[tuple[str, Column]]:
    """Rules after parsing: metadata first, file header as fallback. Missing values fail."""
    method = F.coalesce(F.nullif("method", F.lit("")), "header_method")
    date = F.coalesce("date", F.col("header_date").try_cast("date"))
    resolution = usable_resolution(F.col("resolution"), F.col("header_resolution"))
    return [
        ("method", ~method_allowed(method, allow)),
        ("date", ~date_in_range(date, first, last)),
        ("resolution", resolution.isNull() | (resolution > max_resolution)),
        ("no_atoms", F.coalesce("atom_rows", F.lit(0)) == 0),
    ]


def oversize_rules(max_chains: int, max_context: int) -> list[tuple[str, Column]]:
    """Deferral reasons of entries that are too big to keep whole; 0 turns the length rule off."""
    return [
        ("too_many_chains", F.col("context_chains") > max_chains),
        ("context_too_long", F.lit(max_context > 0) & (F.col("context_length") > max_context)),
    ]


def training_filter(rows: DataFrame, max_resolution: float, last_date: str, resolution: str = "resolution", date: str = "deposition") -> DataFrame:
    return rows.where((F.col(resolution) <= max_resolution) & (F.col(date) <= F.lit(last_date).cast("date")))


def size_matches(actual: Column, expected: Column) -> Column:
    """Equal within 4096 bytes or 0.2 percent, whichever is more; both positive."""
    return (actual > 0) & (expected > 0) & (
        F.abs(actual - expected) <= F.greatest(F.lit(4096.0), expected * F.lit(0.002)))


def file_completeness(manifest: DataFrame, files: DataFrame, key: str = "relpath") -> DataFrame:
    """Manifest against files on disk: complete, missing, size_mismatch or unexpected."""
    m = manifest.select(key, F.col("size").alias("expected"))
    f = files.select(key, F.col("length").alias("actual"))
    state = (
        F.when(F.col("actual").isNull(), "missing").when(F.col("expected").isNull(), "unexpected")
        .when(size_matches(F.col("actual"), F.col("expected")), "complete").otherwise("size_mismatch"))
    return m.join(f, key, "full_outer").withColumn("state", state)


def rename_fields(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(mapping)
