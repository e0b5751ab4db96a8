"""Cluster union over shared content, split assignment, inheritance and leak counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.text import rank_hash
from ..session import checkpointed
from .scale import row_numbers, with_group_agg


class NotConverged(RuntimeError):
    """An iterative operator used up its rounds."""


def _edge_state(edges: DataFrame) -> tuple:
    row = edges.agg(
        F.count("*").alias("n"),
        F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("h"),
    ).first()
    return row["n"], row["h"]


def _with_least(pairs: DataFrame) -> DataFrame:
    """(u, v, low): each pair with the least ``v`` of its ``u``.

    The minimum is combined map-side, so a hub holding most pairs sends one row per task; in the
    join that follows, adaptive execution splits the hub's partition.
    """
    return pairs.join(pairs.groupBy("u").agg(F.min("v").alias("low")), "u")


def connected_labels(edges: DataFrame, max_rounds: int = 50) -> DataFrame:
    """(node, label) with the least node of each connected component as its label.

    ``edges`` has columns ``u`` and ``v`` of one orderable type. Large-star and small-star
    steps alternate until the edge set stops changing, which takes a logarithmic number of
    rounds. Only nodes with a label below their own id are returned.
    """
    edges = checkpointed(
        edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    state = _edge_state(edges)
    for _ in range(max_rounds):
        if state[0] == 0:
            break
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).where("v > u").select(F.col("v").alias("u"), F.least("low", "u").alias("v"))
        small = _with_least(large.distinct())
        stars = small.select(F.explode(F.array(
            F.struct(F.col("v").alias("u"), F.col("low").alias("v")),
            F.struct(F.col("u").alias("u"), F.col("low").alias("v")),
        )).alias("e")).select("e.u", "e.v").where("u <> v").distinct()
        edges = checkpointed(stars)
        after = _edge_state(edges)
        if after == state:
            break
        state = after
    else:
        raise NotConverged(f"components did not settle in {max_rounds} rounds")
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label"))


def content_edges(df: DataFrame, key: str, cluster: str) -> DataFrame:
    """Edges between clusters that hold the same ``key``: one star per key.

    Keys are compared by SHA-256, so long texts are hashed once and never shuffled.
    """
    pairs = df.select(F.sha2(F.col(key).cast("string"), 256).alias("h"), F.col(cluster).alias("u")).distinct()
    return with_group_agg(pairs, ["h"], {"v": ("min", "u")}, ["u"]).where("u <> v").select("u", "v").distinct()


def cluster_labels(df: DataFrame, key: str, cluster: str, max_rounds: int = 50) -> DataFrame:
    """(cluster, canonical) for the clusters that a shared ``key`` merges into a lower one."""
    return connected_labels(content_edges(df, key, cluster), max_rounds).select(
        F.col("node").alias(cluster), F.col("label").alias("canonical"))


def apply_labels(df: DataFrame, labels: DataFrame, cluster: str) -> DataFrame:
    """Rows with ``canonical``; labels are unique per cluster, so the join adds no rows."""
    return df.join(labels, cluster, "left").withColumn("canonical", F.coalesce("canonical", F.col(cluster)))


def union_clusters(df: DataFrame, key: str, cluster: str, max_rounds: int = 50) -> DataFrame:
    """Adds ``canonical``: the least cluster id connected to the row's by equal ``key``."""
    return apply_labels(df, cluster_labels(df, key, cluster, max_rounds), cluster)


def union_stats(df: DataFrame, key: str, cluster: str, canonical: str = "canonical") -> DataFrame:
    """Keys found in several original clusters, and how many clusters the union removed."""
    conflicts = (
        df.groupBy(F.sha2(F.col(key).cast("string"), 256).alias("h"))
        .agg((F.min(cluster) < F.max(cluster)).alias("conflict"))
        .agg(F.count_if("conflict").alias("conflicting_keys"))
    )
    merged = df.select(cluster, canonical).distinct().agg(
        F.count_if(F.col(cluster) != F.col(canonical)).alias("clusters_merged"))
    return conflicts.crossJoin(merged)


def assign_splits(
    df: DataFrame, cluster: str, valid_frac: float, test_frac: float, seed: int, out: str = "split",
) -> DataFrame:
    """(cluster, split): clusters in seeded hash order fill valid, then test, then train.

    Sizes are ``max(1, floor(N * frac))`` each from three clusters up, else none.
    """
    clusters = checkpointed(df.select(cluster).distinct())
    total = clusters.count()
    n_valid, n_test = (max(1, int(total * frac)) if total >= 3 else 0 for frac in (valid_frac, test_frac))
    ranked = row_numbers(clusters, [rank_hash(seed, F.col(cluster)), F.col(cluster)], "__rank")
    return ranked.select(cluster, F.when(F.col("__rank") <= n_valid, "valid")
        .when(F.col("__rank") <= n_valid + n_test, "test").otherwise("train").alias(out))


def label_split(df: DataFrame, splits: DataFrame, cluster: str, split: str = "split", default: str = "train") -> DataFrame:
    """Row split by cluster membership; clusters in no list get the default."""
    return df.join(splits, cluster, "left").withColumn(split, F.coalesce(split, F.lit(default)))


def leak_report(df: DataFrame, split: str, keys: dict[str, Column]) -> DataFrame:
    """One row per key name: distinct values, and values seen in more than one split."""
    reports = []
    for name, column in keys.items():
        per_key = df.groupBy(column.alias("__k")).agg(
            (F.min(split) < F.max(split)).alias("leak"))
        reports.append(per_key.agg(
            F.lit(name).alias("key"), F.count("*").alias("values"), F.count_if("leak").alias("leaks")))
    out = reports[0]
    for r in reports[1:]:
        out = out.unionByName(r)
    return out


def duplicate_targets(df: DataFrame, entry: Column) -> DataFrame:
    """Entries with more than one target."""
    return df.groupBy(entry.alias("entry")).agg(F.count("*").alias("n")).where("n > 1")


def rewrite_index(
    chain_index: DataFrame, record_index: DataFrame, rows: DataFrame,
    chain: str = "chain_id", entry: str = "entry_id", cluster: str = "cluster",
) -> tuple[DataFrame, DataFrame]:
    """Carry reconciled clusters into the chain and record indexes.

    Chains absent from ``rows`` are dropped, and so is every record with a dropped chain.
    """
    kept = rows.select(chain, F.col(cluster).alias("__new"))
    chains = chain_index.join(kept, chain).withColumn(cluster, F.col("__new")).drop("__new")
    exploded = record_index.select(entry, F.explode("chains").alias(chain)).join(kept, chain, "left")
    whole = exploded.groupBy(entry).agg(
        F.every(F.col("__new").isNotNull()).alias("__ok"),
        F.array_sort(F.collect_set("__new")).alias("clusters"),
    ).where("__ok").drop("__ok")
    records = record_index.drop("clusters").join(whole, entry)
    return chains, records


def inherit_splits(
    stage: DataFrame, reference: DataFrame, id: str, key: str, cluster: str, split: str = "split",
    max_rounds: int = 20,
) -> dict[str, DataFrame]:
    """Carry reference splits over to stage rows that share clusters or exact content.

    Clusters of both are united over equal ``key``. A component that reaches reference rows of
    several splits quarantines all its stage rows, and the rest starts again from its original
    clusters, until no component is in conflict. Returns ``kept`` (id, cluster, split),
    ``quarantined`` (id, original and reconciled cluster, splits) and one-row ``stats``.
    """
    h = F.sha2(F.col(key).cast("string"), 256)
    ref = checkpointed(reference.select(h.alias("h"), F.col(cluster).alias("c"), F.col(split).alias("s")))
    remaining = checkpointed(stage.select(F.col(id), h.alias("h"), F.col(cluster).alias("c")))
    quarantined: DataFrame | None = None
    components = 0
    for _ in range(max_rounds):
        both = ref.select("h", "c").unionByName(remaining.select("h", "c"))
        labels = connected_labels(content_edges(both, "h", "c")).select(
            F.col("node").alias("c"), F.col("label").alias("canonical"))
        ref_splits = checkpointed(
            apply_labels(ref, labels, "c").groupBy("canonical")
            .agg(F.array_sort(F.collect_set("s")).alias("splits")))
        conflicts = ref_splits.where(F.size("splits") > 1)
        n_conflicts = conflicts.count()
        placed = checkpointed(apply_labels(remaining, labels, "c"))
        if n_conflicts == 0:
            break
        hit = checkpointed(placed.join(conflicts, "canonical").select(
            id, F.col("c").alias("original_cluster"), F.col("canonical").alias("reconciled_cluster"),
            F.col("splits").alias("reference_splits")))
        if hit.isEmpty():
            raise ValueError("the reference release itself has a split conflict")
        components += n_conflicts
        quarantined = hit if quarantined is None else quarantined.unionByName(hit)
        remaining = checkpointed(
            placed.join(conflicts.select("canonical"), "canonical", "left_anti").select(id, "h", "c"))
    else:
        raise NotConverged(f"quarantine did not settle in {max_rounds} rounds")
    if quarantined is None:
        quarantined = placed.where(F.lit(False)).select(
            id, F.col("c").alias("original_cluster"), F.col("canonical").alias("reconciled_cluster"),
            F.array().cast("array<string>").alias("reference_splits"))
    inherited = ref_splits.select("canonical", F.element_at("splits", 1).alias("inherited"))
    kept = placed.join(inherited, "canonical", "left").select(
        id, F.col("canonical").alias(cluster), F.coalesce("inherited", F.lit("train")).alias(split),
        F.col("h").alias("content_sha256"))
    reference_out = apply_labels(ref, labels, "c")
    leaks = (
        reference_out.select("h", F.col("s").alias("split"))
        .unionByName(kept.select(F.col("content_sha256").alias("h"), F.col(split).alias("split")))
        .groupBy("h").agg((F.min("split") < F.max("split")).alias("leak"))
        .agg(F.count_if("leak").alias("content_leaks")))
    counts = kept.agg(
        *[F.count_if(F.col(split) == s).alias(f"stage_{s}_rows") for s in ("train", "valid", "test")],
        *[F.count_distinct(F.when(F.col(split) == s, F.col(cluster))).alias(f"stage_{s}_clusters")
          for s in ("valid", "test")])
    stats = counts.crossJoin(leaks).withColumn("conflict_components", F.lit(components)).crossJoin(
        quarantined.agg(F.count("*").alias("rows_quarantined")))
    return {"kept": kept.drop("content_sha256"), "quarantined": quarantined, "stats": stats}
