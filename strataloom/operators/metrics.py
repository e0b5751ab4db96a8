"""Losses, scores, summaries, correlations, paired deltas, superposition and fingerprints."""

from __future__ import annotations

import hashlib
import re
from collections.abc import Sequence

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as X
from ..functions.vector import distance
from ..session import checkpointed
from .pairs import contact_agreement
from .scale import bounds, join_groups, quantile_of_counts, row_numbers, value_counts

TRAINING_TOKENS = 2000.0
SMOOTHING = 0.1


# ---------------------------------------------------------------- token losses

def ratio(total: Column, weight: Column) -> Column:
    """``total / weight``, NULL where the weight is 0."""
    return F.when(weight != 0, total / weight)


def masked_mean(df: DataFrame, group: Sequence[str], loss: Column, mask: Column, hit: Column | None = None) -> DataFrame:
    """Masked loss per group: nll, perplexity, tokens and, with ``hit``, accuracy.

    Sums are taken over all rows first, so groups without tokens give NULL instead of a mean.
    """
    m = mask.cast("double")
    out = df.groupBy(*group).agg(
        F.sum(m).alias("tokens"), F.sum(loss * m).alias("__loss"),
        *([F.sum(hit.cast("double") * m).alias("__hit")] if hit is not None else []))
    nll = ratio(F.col("__loss"), F.col("tokens"))
    columns = [*group, "tokens", nll.alias("nll"), F.exp(nll).alias("perplexity")]
    if hit is not None:
        columns.append(ratio(F.col("__hit"), F.col("tokens")).alias("accuracy"))
    return out.select(*columns)


def token_loss(log_probs: Column, label: Column) -> Column:
    return -F.get(log_probs, label.cast("int"))


def token_hit(log_probs: Column, label: Column) -> Column:
    """The most probable label is the true one; the lowest of equal ones counts."""
    return F.array_position(log_probs, F.array_max(log_probs)) - 1 == label


def masked_nll(df: DataFrame, group: Sequence[str], log_probs: str, label: str, mask: str) -> DataFrame:
    lp, y = F.col(log_probs), F.col(label)
    return masked_mean(df, group, token_loss(lp, y), F.col(mask), token_hit(lp, y))


def smoothed_loss(log_probs: Column, label: Column, weight: float = SMOOTHING) -> Column:
    """Cross entropy against the one-hot label with ``weight`` spread over all labels."""
    n = F.size(log_probs)
    total = F.lit(1.0 + weight)
    uniform = F.aggregate(log_probs, F.lit(0.0), lambda acc, x: acc + x) * F.lit(weight) / n
    return -(uniform + F.get(log_probs, label.cast("int"))) / total


def smoothed_nll(df: DataFrame, group: Sequence[str], log_probs: str, label: str, mask: str, training: bool = True) -> DataFrame:
    """Smoothed loss per group; training divides by the constant 2000, inference by the tokens."""
    m = F.col(mask).cast("double")
    total = F.sum(smoothed_loss(F.col(log_probs), F.col(label)) * m)
    return df.groupBy(*group).agg((total / TRAINING_TOKENS if training else ratio(total, F.sum(m))).alias("smoothed_nll"))


def structure_scores(df: DataFrame, structure: Sequence[str], repeat: str, loss: Column, designed: Column, mask: Column) -> DataFrame:
    """Score (designed residues) and global score (all), mean and population deviation over repeats."""
    d, m = designed.cast("double") * mask.cast("double"), mask.cast("double")
    per = df.groupBy(*structure, repeat).agg(
        ratio(F.sum(loss * d), F.sum(d)).alias("score"), ratio(F.sum(loss * m), F.sum(m)).alias("global_score"))
    return per.groupBy(*structure).agg(
        F.avg("score").alias("score_mean"), F.stddev_pop("score").alias("score_std"),
        F.avg("global_score").alias("global_score_mean"), F.stddev_pop("global_score").alias("global_score_std"))


def sequence_recovery(df: DataFrame, group: Sequence[str], native: Column, designed: Column, designable: Column) -> DataFrame:
    """Designable positions, mutations and recovery per group of residue rows."""
    out = df.groupBy(*group).agg(
        F.count_if(designable).alias("designable"), F.count_if(designable & (native != designed)).alias("mutations"))
    return out.withColumn("recovery", 1 - ratio(F.col("mutations"), F.col("designable")))


def string_recovery(native: Column, designed: Column) -> tuple[Column, Column]:
    """(positions compared, mutations) of two texts position by position."""
    n = F.least(F.length(native), F.length(designed))
    differ = F.zip_with(F.split(F.substr(native, F.lit(1), n), ""), F.split(F.substr(designed, F.lit(1), n), ""), lambda a, b: a != b)
    return n, F.size(F.filter(differ, lambda x: x))


# ---------------------------------------------------------------- summaries

def to_long(df: DataFrame, keys: Sequence[str], metrics: Sequence[str]) -> DataFrame:
    """(keys, metric, value) with one row per metric."""
    return df.unpivot(list(keys), [F.col(m).cast("double").alias(m) for m in metrics], "metric", "value")


def counts_summary(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    """count, mean, exact median, min, max per keys of a table of values and counts; a value may come in several rows."""
    stats = checkpointed(counts.groupBy(*keys).agg(
        (F.sum(F.col("value") * F.col("n")) / F.sum("n")).alias("mean"), F.min("value").alias("min"), F.max("value").alias("max"), *bounds("value")))
    found = ["__total", "__lo", "__hi"]
    median = quantile_of_counts(counts, keys, "value", 0.5, "median", stats.select(*keys, *found))
    return join_groups(stats.select(*keys, F.col("__total").alias("count"), "mean", "min", "max"), median, keys)


def metric_summary(df: DataFrame, metrics: Sequence[str], group: str | None = None) -> DataFrame:
    """Summary per metric, overall (scope ``overall``) and per value of ``group``.

    The rows are read once, into counts per distinct value; both scopes come from those.
    """
    keys = ["metric"] if group is None else [group, "metric"]
    counts = checkpointed(value_counts(to_long(df, keys[:-1], metrics), keys, "value"))
    scopes = F.array(F.lit("overall"), *([] if group is None else [F.col(group).cast("string")]))
    return counts_summary(counts.select(F.explode(scopes).alias("scope"), "metric", "value", "n"), ["scope", "metric"])


def model_summary(df: DataFrame, model: str, record: str, metrics: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """Summaries by model and by record and model."""
    fine = checkpointed(value_counts(to_long(df, [model, record], metrics), [record, model, "metric"], "value"))
    return (counts_summary(fine, [model, "metric"]),
            counts_summary(fine, [record, model, "metric"]))


def safe_corr(x: Column, y: Column) -> Column:
    """Pearson correlation as an aggregate; NULL below two rows or without variance.

    Merged partial variances of equal values can come out above zero by rounding, so whether values vary is told by their range.
    """
    both = x.isNotNull() & y.isNotNull()
    x, y = F.when(both, x.cast("double")), F.when(both, y.cast("double"))
    spread = F.var_pop(x) * F.var_pop(y)
    vary = (F.min(x) < F.max(x)) & (F.min(y) < F.max(y))
    return F.when((F.count(x) >= 2) & vary & (spread > 0), F.covar_pop(x, y) / F.sqrt(F.when(spread > 0, spread)))


def flatten_metrics(df: DataFrame, fields: dict[str, str], keys: Sequence[str], complement: dict[str, str] | None = None) -> DataFrame:
    """Nested result fields as named columns; ``complement`` adds ``name = 1 - other``."""
    out = df.select(*keys, *[F.col(path).cast("double").alias(name) for name, path in fields.items()])
    for name, other in (complement or {}).items():
        out = out.withColumn(name, 1 - F.col(other))
    return out


# ---------------------------------------------------------------- comparisons

def pair_arms(df: DataFrame, keys: Sequence[str], arm: str, baseline: str, candidate: str, metrics: Sequence[str]) -> DataFrame:
    """Candidate minus baseline per key that has both arms. One aggregation, no self join."""
    pick = lambda m, a: F.max(F.when(F.col(arm) == a, F.col(m)))
    wide = df.where(F.col(arm).isin(baseline, candidate)).groupBy(*keys).agg(
        (F.max(F.col(arm) == baseline) & F.max(F.col(arm) == candidate)).alias("__both"),
        *[pick(m, a).alias(f"__{tag}_{m}") for m in metrics for tag, a in (("b", baseline), ("c", candidate))])
    return wide.where("__both").select(*keys, *[(F.col(f"__c_{m}") - F.col(f"__b_{m}")).alias(m) for m in metrics])


def paired_delta(
    df: DataFrame, keys: Sequence[str], arm: str, baseline: str, candidate: str,
    metrics: Sequence[str], lower_is_better: Sequence[str] = (),
) -> DataFrame:
    """(metric, pairs, mean_delta, wins): wins count strict improvements in the metric's direction."""
    long = to_long(pair_arms(df, keys, arm, baseline, candidate, metrics), keys, metrics)
    better = F.when(F.col("metric").isin(*lower_is_better) if lower_is_better else F.lit(False), F.col("value") < 0).otherwise(F.col("value") > 0)
    return long.groupBy("metric").agg(
        F.count("value").alias("pairs"), F.avg("value").alias("mean_delta"), F.count_if(better).alias("wins"))


def seed_summary(deltas: DataFrame, delta: str, group: Sequence[str] = ()) -> DataFrame:
    """Wins, mean, least and greatest delta over seeds; lower is better."""
    out = deltas.groupBy(*group).agg(
        F.count("*").alias("seeds"), F.count_if(F.col(delta) < 0).alias("wins"), F.avg(delta).alias("mean_delta"),
        F.min(delta).alias("min_delta"), F.max(delta).alias("max_delta"))
    return out.withColumn("status", F.when(F.col("wins") == F.col("seeds"), "consistently_improved")
                          .when(F.col("wins") > 0, "mixed").otherwise("not_improved"))


def arm_delta(df: DataFrame, population: Sequence[str], arm: str, official: str, selected: str, metrics: Sequence[str] = ("nll", "perplexity", "accuracy")) -> DataFrame:
    """Metric deltas of two arms on one population, improved when the loss went down."""
    out = pair_arms(df, population, arm, official, selected, metrics)
    return out.withColumn("status", F.when(F.col(metrics[0]) < 0, "improved").otherwise("not_improved"))


def recovery_check(df: DataFrame, model: str, recovery: str, recorded: DataFrame, tolerance: float = 1e-12) -> DataFrame:
    """Mean recovery per model against the recorded one."""
    mean = df.groupBy(model).agg(F.avg(recovery).alias("mean_recovery"))
    return mean.join(recorded.select(model, F.col("mean_recovery").alias("recorded")), model, "full_outer").withColumn(
        "ok", F.coalesce(F.abs(F.col("mean_recovery") - F.col("recorded")) <= tolerance, F.lit(False)))


def run_summary(selected: DataFrame, results: DataFrame, key: str, seconds: str | None = None, peak: str | None = None) -> DataFrame:
    """Selected, succeeded, failed and pending records, run status, time and peak memory."""
    cols = [key, F.col("status").alias("__s")]
    cols += [F.col(seconds).cast("double").alias("__t")] if seconds else [F.lit(None).cast("double").alias("__t")]
    cols += [F.col(peak).cast("double").alias("__p")] if peak else [F.lit(None).cast("double").alias("__p")]
    joined = selected.select(key).join(results.select(*cols), key, "left")
    good = F.col("__s") == "succeeded"
    out = joined.agg(
        F.count("*").alias("selected"), F.count_if(good).alias("succeeded"), F.count_if(F.col("__s") == "failed").alias("failed"),
        F.count_if(F.col("__s").isNull()).alias("pending"), F.sum(F.when(good, F.col("__t"))).alias("total_seconds"),
        F.avg(F.when(good, F.col("__t"))).alias("mean_seconds"), F.max(F.when(good, F.col("__p"))).alias("peak"))
    return out.withColumn("status", F.when(F.col("succeeded") == F.col("selected"), "passed").when(F.col("failed") > 0, "failed").otherwise("running"))


def inventory(rows: DataFrame, cluster: str, files: DataFrame | None = None, expected: dict[str, int] | None = None) -> DataFrame:
    """Rows, clusters, files and bytes, and whether they are the expected ones."""
    out = rows.agg(F.count("*").alias("n_rows"), F.count_distinct(cluster).alias("n_clusters"))
    if files is not None:
        out = out.crossJoin(files.agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes")))
    ok = F.lit(True)
    for name, value in (expected or {}).items():
        ok = ok & (F.col(name) == value)
    return out.withColumn("as_expected", ok)


def kept_totals(rows: DataFrame, kept: DataFrame, key: str, totals: dict[str, str]) -> DataFrame:
    """Sums over the rows whose key was kept."""
    return rows.join(kept.select(key), key, "left_semi").agg(*[F.sum(c).alias(n) for n, c in totals.items()])


# ---------------------------------------------------------------- ordered-id fingerprint

def _streamed_digests(batches):
    """(group row, count, digest) of rows that arrive sorted by group and order: each list is hashed as it passes."""
    last, digest, n = None, None, 0
    for batch in batches:
        columns = batch.to_pydict()
        for g, v in zip(columns["__group"], columns["__v"]):
            if digest is not None and g == last:
                digest.update(b"\n")
            else:
                if digest is not None:
                    yield pa.RecordBatch.from_pylist([{"__group": last, "n_ids": n, "ids_sha256": digest.hexdigest()}], schema=_DIGESTS)
                last, digest, n = g, hashlib.sha256(), 0
            digest.update((v or "").encode("utf-8"))
            n += 1
    if digest is not None:
        yield pa.RecordBatch.from_pylist([{"__group": last, "n_ids": n, "ids_sha256": digest.hexdigest()}], schema=_DIGESTS)


_DIGESTS = pa.schema([("__group", pa.string()), ("n_ids", pa.int64()), ("ids_sha256", pa.string())])


def fingerprint(df: DataFrame, group: Sequence[str], order: Sequence[str | Column], id: str) -> DataFrame:
    """(group, n_ids, ids_sha256): SHA-256 of the newline-joined ids in order, one definition at every size.

    The digest is sequential, so a group is read by one task, but as a stream: Spark sorts (and
    spills) its ids and the task holds a batch of them at a time.
    """
    rows = df.select(F.to_json(F.struct(*group) if group else F.struct(F.lit(0))).alias("__group"), F.col(id).cast("string").alias("__v"), *[
        (F.col(o) if isinstance(o, str) else o).alias(f"__o{i}") for i, o in enumerate(order)])
    keys = [f"__o{i}" for i in range(len(order))]
    digests = rows.repartition("__group").sortWithinPartitions("__group", *keys).select("__group", "__v").mapInArrow(
        _streamed_digests, "__group string, n_ids bigint, ids_sha256 string")
    if not group:
        return digests.select("n_ids", "ids_sha256")
    names = df.select(*group).distinct().withColumn("__group", F.to_json(F.struct(*group)))
    return names.join(digests, "__group").select(*group, "n_ids", "ids_sha256")


# ---------------------------------------------------------------- superposition

_AXES = "xyz"


#: Squarings of the fit matrix: directions that differ by one part in 10^12 in what they explain are told apart.
SQUARINGS = 40


#: The symmetric 4x4 matrix, row by row, whose greatest eigenvalue is the sum of products after the best rotation;
#: ``xy`` stands for the centred sum of model x times native y.
_QUATERNION_MATRIX = """array(xx + yy + zz, yz - zy, zx - xz, xy - yx,
  yz - zy, xx - yy - zz, xy + yx, zx + xz,
  zx - xz, xy + yx, yy - xx - zz, yz + zy,
  xy - yx, zx + xz, yz + zy, zz - xx - yy)"""
#: The square of the symmetric matrix m, scaled to trace one.
_SQUARED = "transform(sequence(0, 15), i -> (" + " + ".join(f"m[4 * (i div 4) + {k}] * m[{4 * k} + i % 4]" for k in range(4)) + ") / aggregate(m, 0D, (t, v) -> t + v * v))"
_ROTATION = """array(array(w * w + x * x - y * y - z * z, 2 * (x * y - w * z), 2 * (x * z + w * y)),
  array(2 * (x * y + w * z), w * w - x * x + y * y - z * z, 2 * (y * z - w * x)),
  array(2 * (x * z - w * y), 2 * (y * z + w * x), w * w - x * x - y * y + z * z))"""


def superpose(df: DataFrame, record: Sequence[str], native: str, model: str, mask: Column) -> DataFrame:
    """(record, n, rotation, shift, rmsd): least-squares fit of the model onto the native points.

    The fit needs seventeen sums a record, which are aggregated like any other. The rotation is the
    quaternion that belongs to the greatest eigenvalue of a 4x4 matrix of them; squaring the matrix again and again
    leaves that direction alone (any of them where several fit equally well), and its quotient is
    the eigenvalue. A quaternion never mirrors. Records of fewer than three points have no fit.
    """
    points = df.where(mask).select(*record, *[F.col(f"{side}.{a}").cast("double").alias(f"__{name}{a}") for side, name in ((native, "a"), (model, "b")) for a in _AXES])
    sums = [f"sum(__{side}{a}) AS __{side}{a}" for side in "ab" for a in _AXES]
    products = [f"sum(__b{i} * __a{j}) - sum(__b{i}) * sum(__a{j}) / count(*) AS {i}{j}" for i in _AXES for j in _AXES]
    spread = " + ".join(f"sum(__{c} * __{c}) - sum(__{c}) * sum(__{c}) / count(*)" for c in (side + a for side in "ab" for a in _AXES))
    rows = points.groupBy(*record).agg(F.count("*").alias("n"), *[F.expr(e) for e in (*sums, f"struct({', '.join(products)}) AS __p", f"{spread} AS __g")]).where("n >= 3")
    rows = rows.withColumn("__k", F.expr(re.sub(r"\b([xyz]{2})\b", r"__p.\1", _QUATERNION_MATRIX)))
    # no eigenvalue is below minus half the spread, so none of the shifted ones is negative
    rows = rows.withColumn("__m", F.expr(f"aggregate(sequence(1, {SQUARINGS}), transform(__k, (v, i) -> v + IF(i % 5 = 0, greatest(__g / 2, 1e-100D), 0D)), (m, t) -> {_SQUARED})"))
    rows = rows.withColumn("__top", F.expr("array_position(array(__m[0], __m[5], __m[10], __m[15]), greatest(__m[0], __m[5], __m[10], __m[15]))"))
    rows = rows.withColumn("__q", F.expr("slice(__m, CAST(4 * __top - 3 AS INT), 4)"))
    rows = rows.withColumn("__q", F.expr("transform(__q, v -> v / sqrt(aggregate(__q, 0D, (t, u) -> t + u * u)))"))
    root = "aggregate(transform(__k, (v, i) -> v * __q[i div 4] * __q[i % 4]), 0D, (t, v) -> t + v)"
    rows = rows.select("*", F.expr(re.sub(r"\b([wxyz])\b", lambda found: f"__q[{'wxyz'.index(found[1])}]", _ROTATION)).alias("rotation"),
                       F.expr(f"sqrt(greatest((__g - 2 * {root}) / n, 0D))").alias("rmsd"))
    moved = ", ".join(f"(__a{a} - rotation[{i}][0] * __bx - rotation[{i}][1] * __by - rotation[{i}][2] * __bz) / n" for i, a in enumerate(_AXES))
    return rows.select(*record, "n", "rotation", F.expr(f"array({moved})").alias("shift"), "rmsd")


def tm_scale(length: Column) -> Column:
    """Distance scale of the TM score, at least 0.5."""
    return F.greatest(F.lit(0.5), F.lit(1.24) * F.cbrt(F.greatest(length - 15, F.lit(0)).cast("double")) - F.lit(1.8))


def structure_metrics(df: DataFrame, record: Sequence[str], idx: str, native: str, model: str, mask: str, length: str | None = None) -> DataFrame:
    """lDDT, RMSD and TM scores (over resolved and over all positions) per record.

    ``df``: one row per position with native and model points as structs and a mask of resolved
    positions; the full length is ``length`` or the number of rows.
    """
    from ..functions.vector import rigid

    used = F.col(mask)
    fit = superpose(df, record, native, model, used)
    total = df.groupBy(*record).agg((F.max(length) if length else F.count("*")).cast("bigint").alias("__length"))
    fitted = df.where(used).join(fit, list(record)).join(total, list(record)).withColumn(
        "__d", distance(F.col(native), rigid(F.col("rotation"), F.col("shift"), F.col(model))))
    score = lambda size: F.sum(1 / (1 + F.pow(F.col("__d") / tm_scale(size), F.lit(2.0)))) / F.max(size)
    global_ = fitted.groupBy(*record).agg(
        F.max("n").alias("resolved"), F.max("__length").alias("length"),
        F.max("rmsd").alias("ca_rmsd"),
        score(F.col("n")).alias("tm_resolved"), score(F.col("__length")).alias("tm_full"))
    points = df.where(used).select(
        *record, idx, F.array(*[F.col(f"{native}.{a}") for a in _AXES]).alias("__n"), F.array(*[F.col(f"{model}.{a}") for a in _AXES]).alias("__m"))
    local = contact_agreement(points, record, idx, "__n", "__m").select(*record, F.col("lddt").alias("ca_lddt"))
    return global_.join(local, list(record), "left")


def evaluate_records(df: DataFrame, record: str, metric, schema: str) -> DataFrame:
    """A caller's own metric per record; a record it fails on becomes a ``failed`` row.

    ``metric`` maps one record's pandas frame to a dict of the ``schema`` columns. A record must
    fit a task; use ``structure_metrics`` for the built-in metrics.
    """
    from pyspark.sql import types as T

    names = [f.name for f in T._parse_datatype_string(schema).fields]

    def run(key, pdf):
        try:
            values, status, error = metric(pdf), "succeeded", None
        except Exception as problem:
            values, status, error = {}, "failed", f"{type(problem).__name__}: {problem}"
        return pd.DataFrame([[key[0], status, error, *[values.get(n) for n in names]]], columns=[record, "status", "error", *names])

    kind = df.schema[record].dataType.simpleString()
    return df.groupBy(record).applyInPandas(run, f"{record} {kind}, status string, error string, {schema}")
