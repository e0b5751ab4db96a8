"""Curation dataflow: raw structure files to residues, chains, targets, clusters and splits."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession, functions as F

from ..functions import text as X
from ..operators import audit, clusters as C, crop as K, filters as L, pairs as P, residues as R, select as S
from ..session import checkpointed
from ..sources import sinks, structure as T


@dataclass(frozen=True)
class CurateConfig:
    methods: tuple[str, ...] = ()
    first_date: str | None = None
    last_date: str | None = None
    max_resolution: float = 3.5
    assembly_id: str = "all"
    assembly_policy: str = "first"
    limit: int = 0
    max_raw_bytes: int = 0
    min_length: int = 30
    max_length: int = 10_000
    min_resolved: int = 0
    min_coverage: float = 0.0
    max_chains: int = 62
    max_context: int = 0
    crop: bool = False
    require_oversized: bool = False
    min_crop_length: int = 30
    valid_frac: float = 0.01
    test_frac: float = 0.01
    seed: int = 0


@dataclass
class Release:
    """The tables of a build. ``outcomes`` has one row per input file."""

    outcomes: DataFrame
    targets: DataFrame
    chains: DataFrame
    residues: DataFrame
    edges: DataFrame
    splits: DataFrame
    crops: DataFrame | None = None
    extra: dict[str, DataFrame] = field(default_factory=dict)


def select_inputs(spark: SparkSession, root: str, metadata: DataFrame, cfg: CurateConfig) -> tuple[DataFrame, DataFrame]:
    """(files to read with their metadata, outcomes of the rest); no file is opened."""
    return choose_inputs(T.list_files(spark, root), metadata, cfg)


def choose_inputs(listing: DataFrame, metadata: DataFrame, cfg: CurateConfig) -> tuple[DataFrame, DataFrame]:
    """``select_inputs`` over a listing (path, length)."""
    files = T.discover_assemblies(listing, cfg.assembly_id, cfg.assembly_policy, cfg.limit)
    fitting, too_big = T.size_bounded(files, cfg.max_raw_bytes)
    joined = fitting.withColumn("__id", F.upper("pdb_id")).join(
        metadata.select(F.col("pdb_id").alias("__id"), "date", "resolution", "method"), "__id", "left").drop("__id")
    rules = [("bad_file_name", F.col("pdb_id").isNull()),
             *L.metadata_rules(cfg.methods, cfg.first_date, cfg.last_date, cfg.max_resolution)]
    judged = L.reason_cascade(joined, rules)
    skipped = judged.where("reason is not null").select("path", "status", "reason").unionByName(too_big)
    return judged.where("reason is null").drop("status", "reason"), skipped


def judge_contents(inputs: DataFrame, parsed: DataFrame, cfg: CurateConfig) -> tuple[DataFrame, DataFrame]:
    """(files that parsed, with their header fields, status and reason; outcomes of those that did not)."""
    failed = T.parse_failures(parsed).drop("error")
    head = T.header_fields(parsed).select(
        "path", F.col("method").alias("header_method"), F.col("date").alias("header_date"),
        F.col("resolution").alias("header_resolution"), "atom_rows")
    rules = L.content_rules(cfg.methods, cfg.first_date, cfg.last_date, cfg.max_resolution)
    return L.reason_cascade(inputs.join(failed.select("path"), "path", "left_anti").join(head, "path", "left"), rules), failed


def curate(spark: SparkSession, root: str, metadata: DataFrame, cluster_map: DataFrame, cfg: CurateConfig) -> Release:
    """Run the whole build. ``metadata``: pdb_id, date, resolution, method; ``cluster_map``: pdb_id,
    entity_id, cluster."""
    inputs, skipped = select_inputs(spark, root, metadata, cfg)
    inputs = checkpointed(inputs)
    parsed = checkpointed(T.read_mmcif(spark, inputs))
    judged, failed = judge_contents(inputs, parsed, cfg)
    skipped = skipped.unionByName(judged.where("reason is not null").select("path", "status", "reason"))
    entries = judged.where("reason is null").select(
        "path", F.col("entry_id").alias("entry"), "pdb_id",
        F.coalesce("date", F.col("header_date").try_cast("date")).alias("deposition"),
        L.usable_resolution(F.col("resolution"), F.col("header_resolution")).alias("resolution"))
    entries = checkpointed(entries)
    table = lambda c: T.category_table(parsed, c).join(entries.select("path", "entry"), "path").drop("path")
    entity_poly_seq, scheme = table("entity_poly_seq"), table("pdbx_poly_seq_scheme")
    entities = checkpointed(R.protein_entities(table("entity_poly"), entity_poly_seq))
    atoms = checkpointed(R.best_atoms(R.filter_atoms(table("atom_site"), entities), ["entry", "chain", "seq_id", "atom"]))
    votes = scheme.select("entry", X.clean_token(F.col("asym_id")).alias("chain"), X.clean_token(F.col("entity_id")).alias("entity_id"),
                          F.lit(0).alias("source"), "row").join(entities, ["entry", "entity_id"], "left_semi").unionByName(
        atoms.select("entry", "chain", "entity_id", F.lit(1).alias("source"), "row"))
    with_atoms = R.majority_entity(votes.join(atoms.select("entry", "chain").distinct(), ["entry", "chain"], "left_semi"))
    positions = R.chain_positions(scheme, entity_poly_seq, with_atoms, entities)
    residues = checkpointed(R.residue_table(positions, atoms, cfg.min_length, cfg.max_length))
    chains = checkpointed(R.quality_gate(
        R.chain_table(residues, with_mask=cfg.crop), cfg.min_length, cfg.max_length, cfg.min_resolved, cfg.min_coverage))

    size = entries.join(R.context_size(chains), "entry", "left")
    oversize = L.oversize_rules(cfg.max_chains, cfg.max_context)
    empty = [("no_valid_chains", F.col("context_chains").isNull())]
    if not cfg.crop:
        rules = empty + oversize
    elif cfg.require_oversized:
        big = F.coalesce(oversize[0][1], F.lit(False)) | F.coalesce(oversize[1][1], F.lit(False))
        rules = empty + [("not_oversized", ~big)]
    else:
        rules = empty
    sized = checkpointed(L.reason_cascade(size, rules))
    deferred = F.col("reason").isin(*[name for name, _ in oversize])
    skipped = skipped.unionByName(sized.where("reason is not null").select(
        "path", F.when(deferred, "deferred").otherwise("skipped").alias("status"), "reason"))
    good = sized.where("reason is null").select("entry")
    chains = chains.join(good, "entry", "left_semi")
    target = checkpointed(S.target_member(chains.select("entry", "chain", "resolved", "coverage"), ["entry"], ["resolved", "coverage"], "chain").select("entry", "chain"))

    crops = None
    if cfg.crop:
        points = residues.select("entry", "chain", "pos", F.when(F.col("ca").isNotNull(), F.array("ca.x", "ca.y", "ca.z")).alias("xyz")).join(
            chains.select("entry", "chain"), ["entry", "chain"], "left_semi")
        near = P.nearest_pairs(points, ["entry"], "chain", "pos", "xyz", target)
        marked = chains.join(target.withColumnRenamed("chain", "__t"), "entry").withColumn("is_target", F.col("chain") == F.col("__t")).join(
            near, ["entry", "chain"], "left").withColumn("center", F.col("context_index"))
        ranked = S.spatial_rank(marked.where("not is_target"), ["entry"], "distance", "chain").unionByName(
            marked.where("is_target"), allowMissingColumns=True)
        crops, too_long = K.budget_crop(ranked, cfg.max_context, cfg.max_chains, cfg.min_crop_length, cfg.min_resolved, cfg.min_coverage)
        crops = checkpointed(crops)
        skipped = skipped.unionByName(too_long.join(entries, "entry").select("path", F.lit("skipped").alias("status"), "reason"))
        residues = checkpointed(K.crop_residues(residues, crops))
        chains = checkpointed(R.chain_table(residues))
        target = target.join(crops.select("entry").distinct(), "entry", "left_semi")
    else:
        residues = residues.join(chains.select("entry", "chain"), ["entry", "chain"], "left_semi")

    named = R.remap_chains(chains).join(entries.select("entry", "pdb_id"), "entry")
    clustered = checkpointed(R.with_cluster(
        named.withColumn("__p", F.upper("pdb_id")), cluster_map.select(F.col("pdb_id").alias("__p"), "entity_id", "cluster"), ["__p", "entity_id"], "seq"
    ).drop("__p").join(target.withColumn("is_target", F.lit(True)), ["entry", "chain"], "left").withColumn("is_target", F.coalesce("is_target", F.lit(False))))
    edges = R.target_identity(clustered, "entry", "chain_id", "is_target", "entity_id", "cluster", "seq")
    rows = clustered.where("is_target").join(entries.select("entry", "deposition", "resolution"), "entry").select(
        F.concat_ws("_", "entry", "chain_id").alias("chain_id"), F.col("entry").alias("entry_id"), "pdb_id", "deposition",
        F.round("resolution", 2).alias("resolution"), X.padded_hash(F.col("seq")).alias("hash"), "cluster", F.col("seq").alias("sequence"))
    united = checkpointed(C.union_clusters(rows, "sequence", "cluster").withColumn("cluster", F.col("canonical")).drop("canonical"))
    splits = C.assign_splits(united, "cluster", cfg.valid_frac, cfg.test_frac, cfg.seed)
    kept = united.join(entries.select(F.col("entry").alias("entry_id"), "path"), "entry_id").select(
        "path", F.lit("ok").alias("status"), F.lit(None).cast("string").alias("reason"))
    outcomes = skipped.unionByName(failed).unionByName(kept)
    return Release(outcomes, united, clustered.drop("is_target", "pdb_id"), residues, edges, splits, crops)


def publish(release: Release, folder: str) -> None:
    """Write the tables; residues, chains and targets are sorted by entry for look-ups."""
    sinks.write_index(release.residues, f"{folder}/residues", ["entry", "chain", "pos"])
    sinks.write_index(release.chains, f"{folder}/chains", ["entry", "chain"])
    sinks.write_index(release.targets, f"{folder}/targets", ["chain_id"])
    release.edges.write.mode("overwrite").parquet(f"{folder}/edges")
    sinks.write_split_files(release.splits, folder)
    sinks.write_outcomes(release.outcomes, f"{folder}/outcomes")
    sinks.write_json_rows(sinks.build_manifest(release.outcomes, {}), f"{folder}/manifest")
    export = release.targets.select(
        F.col("chain_id").alias("CHAINID"), F.date_format("deposition", "yyyy-MM-dd").alias("DEPOSITION"),
        F.format_string("%.2f", F.col("resolution")).alias("RESOLUTION"), F.col("hash").alias("HASH"),
        F.col("cluster").cast("string").alias("CLUSTER"), F.col("sequence").alias("SEQUENCE"))
    sinks.write_targets(export, f"{folder}/list")


def validate(spark: SparkSession, folder: str, cfg: CurateConfig) -> DataFrame:
    """Release audit of a published folder, as a report."""
    targets = spark.read.parquet(f"{folder}/targets")
    lists = {s: spark.read.text(f"{folder}/{s}_clusters").select(F.col("value").cast("bigint").alias("cluster")) for s in ("valid", "test")}
    splits = lists["valid"].withColumn("split", F.lit("valid")).unionByName(lists["test"].withColumn("split", F.lit("test")))
    chains, residues = spark.read.parquet(f"{folder}/chains"), spark.read.parquet(f"{folder}/residues")
    chosen = targets.join(chains.select(F.concat_ws("_", "entry", "chain_id").alias("chain_id"), "entry", "chain"), "chain_id").select("entry", "chain")
    return (audit.release_audit(targets, splits, None)
            .unionByName(audit.split_files_audit(targets, lists["valid"], lists["test"]))
            .unionByName(audit.payload_audit(
                chains, residues, chosen, spark.read.parquet(f"{folder}/edges"), min_length=1 if cfg.crop else cfg.min_length, max_length=cfg.max_length,
                min_resolved=cfg.min_resolved, min_coverage=cfg.min_coverage, max_chains=cfg.max_chains, max_context=cfg.max_context)))
