"""Release audits: indexes, shards, payloads, crops, splits, suites and results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions import text as X
from ..functions.vector import distance
from .clusters import leak_report
from .expect import close, duplicates, expect, expect_empty, set_difference
from .pairs import nearest_pairs


def reference_audit(left: DataFrame, right: DataFrame, key: str, equal: Sequence[str] = (), near: Sequence[str] = ()) -> DataFrame:
    """Two tables that must describe the same keys: missing on a side, and fields that differ.

    (check, failed). ``equal`` fields compare NULL-safe, ``near`` fields within 1e-6.
    """
    a = left.select(key, F.lit(True).alias("__l"), *[F.col(c).alias(f"__l_{c}") for c in (*equal, *near)])
    b = right.select(key, F.lit(True).alias("__r"), *[F.col(c).alias(f"__r_{c}") for c in (*equal, *near)])
    both = F.col("__l").isNotNull() & F.col("__r").isNotNull()
    checks = {"left_only": F.col("__r").isNull(), "right_only": F.col("__l").isNull()}
    for c in equal:
        checks[f"{c}_differs"] = both & ~F.col(f"__l_{c}").eqNullSafe(F.col(f"__r_{c}"))
    for c in near:
        checks[f"{c}_differs"] = both & ~F.coalesce(close(F.col(f"__l_{c}"), F.col(f"__r_{c}"), 1e-6, 1e-6), F.lit(False))
    wide = a.join(b, key, "full_outer").agg(*[F.count_if(v).alias(n) for n, v in checks.items()])
    return wide.unpivot([], list(checks), "check", "failed")


def index_bounds(index: DataFrame, shards: DataFrame, header: int = 512) -> DataFrame:
    """Index rows with ``problem``: unknown shard, bad offset or size, or past the shard's end."""
    joined = index.join(shards.select("shard", F.col("bytes").alias("__bytes"), F.col("disk_bytes").alias("__disk")), "shard", "left")
    return joined.withColumn("problem", F.coalesce(
        F.when(F.col("__bytes").isNull(), "unknown_shard"), F.when(F.col("offset") < header, "offset"),
        F.when(F.col("size") <= 0, "size"), F.when(F.col("offset") + F.col("size") > F.col("__bytes"), "past_end"),
        F.when(F.col("__disk") != F.col("__bytes"), "shard_size"))).drop("__bytes", "__disk")


def shard_audit(manifest: DataFrame, files: DataFrame, records: DataFrame) -> DataFrame:
    """Manifest shards against files (name, bytes, sha256) and index record counts (name rows)."""
    counted = records.groupBy("name").agg(F.count("*").alias("found_records"))
    joined = manifest.join(files.select("name", F.col("bytes").alias("disk_bytes"), F.col("sha256").alias("disk_sha256")), "name", "full_outer").join(
        counted, "name", "left")
    return joined.withColumn("problem", F.coalesce(
        F.when(F.col("bytes").isNull(), "not_in_manifest"), F.when(F.col("disk_bytes").isNull(), "missing_file"),
        F.when(F.col("disk_bytes") != F.col("bytes"), "bytes"), F.when(F.col("disk_sha256") != F.col("sha256"), "sha256"),
        F.when(F.coalesce("found_records", F.lit(0)) != F.col("records"), "records")))


def payload_rules(min_length: int, max_length: int, min_resolved: int, min_coverage: float) -> dict[str, Column]:
    """Row rules of chain payloads joined with values recomputed from their residues.

    Columns: seq, length, resolved, coverage, and found_length, found_resolved, found_atoms_ok,
    found_values_ok.
    """
    c = F.col
    return {
        "alphabet": c("seq").rlike(f"^[{X.ALPHABET}]+$"),
        "length": c("length").between(min_length, max_length) & (F.length("seq") == c("length")),
        "residue_rows": c("found_length") == c("length"),
        "resolved_count": c("found_resolved") == c("resolved"),
        "coverage": close(c("coverage"), c("found_resolved") / c("length")),
        "min_resolved": c("resolved") >= min_resolved,
        "min_coverage": c("coverage") >= min_coverage,
        "coordinates_match_mask": c("found_atoms_ok"),
        "finite_occupancy_and_b": c("found_values_ok"),
    }


def payload_audit(chains: DataFrame, residues: DataFrame, targets: DataFrame, edges: DataFrame, *, min_length: int, max_length: int,
                  min_resolved: int = 0, min_coverage: float = 0.0, max_chains: int = 62, max_context: int = 0) -> DataFrame:
    """Payload invariants of a release: residues, gates, context bounds, target choice, similarity.

    ``targets``: entry, chain. ``edges``: entry, chain_a, chain_b, identity.
    """
    from .residues import resolved
    from .select import target_member
    from ..functions.vector import finite

    atoms_ok = F.lit(True)
    for a in ("n", "ca", "c", "o"):
        atoms_ok = atoms_ok & (F.col(a).isNull() | finite(F.col(a)))
    number_ok = lambda arr: F.forall(arr, lambda x: ~F.isnan(x) & (F.abs(x) != F.lit(float("inf"))))
    found = residues.groupBy("entry", "chain").agg(
        F.count("*").alias("found_length"), F.count_if(resolved()).alias("found_resolved"),
        F.every(atoms_ok).alias("found_atoms_ok"), F.every(number_ok("occ") & number_ok("bfac")).alias("found_values_ok"))
    joined = chains.join(found, ["entry", "chain"], "left")
    report = expect(joined, payload_rules(min_length, max_length, min_resolved, min_coverage), "entry")
    size = chains.groupBy("entry").agg(F.count("*").alias("n"), F.sum("length").alias("total"))
    context = expect(size, {
        "max_chains": F.col("n") <= max_chains,
        "max_context": F.lit(max_context <= 0) | (F.col("total") <= max_context)}, "entry")
    chosen = target_member(chains.select("entry", "chain", "resolved", "coverage"), ["entry"], ["resolved", "coverage"], "chain").select("entry", "chain")
    pairs = expect(edges, {
        "identity_range": F.col("identity").between(0.0, 1.0),
        "identity_of_itself": (F.col("chain_a") != F.col("chain_b")) | (F.col("identity") == 1.0)}, "entry")
    tables = expect_empty({"target_choice": set_difference(targets.select("entry", "chain"), chosen)})
    return report.unionByName(context).unionByName(pairs).unionByName(tables)


def crop_rules() -> dict[str, Column]:
    """Row rules of cropped chains: interval arithmetic, kinds, ranks and nearest residues.

    Columns: kind, spatial_rank, distance, source_length, source_resolved, source_coverage,
    start, end, length, resolved, coverage, target_index, source_index, target_length.
    """
    c = F.col
    target, whole, window = c("kind") == "full_target", c("kind") == "full_context", c("kind") == "context_window"
    complete = (c("start") == 0) & (c("end") == c("source_length")) & (c("source_resolved") == c("resolved")) & close(c("source_coverage"), c("coverage"))
    return {
        "kind": target | whole | window,
        "source_resolved": c("source_resolved").between(0, c("source_length")),
        "source_coverage": close(c("source_coverage"), c("source_resolved") / c("source_length")),
        "interval": (c("start") >= 0) & (c("start") < c("end")) & (c("end") <= c("source_length")),
        "interval_length": c("end") - c("start") == c("length"),
        "resolved_not_gained": c("source_resolved") >= c("resolved"),
        "target_complete": ~target | (complete & (c("spatial_rank") == 0) & (c("distance") == 0.0)
                                      & c("target_index").isNull() & c("source_index").isNull()),
        "context_complete": ~whole | complete,
        "window_shorter": ~window | (c("length") < c("source_length")),
        "context_rank": target | (c("spatial_rank") > 0),
        "context_distance": target | ((c("distance") >= 0) & (c("distance") < F.lit(float("inf")))),
        "target_index": target | ((c("target_index") >= 0) & (c("target_index") < c("target_length"))),
        "nearest_inside": target | ((c("source_index") >= c("start")) & (c("source_index") < c("end"))),
    }


def crop_totals_rules(max_context: int, max_chains: int) -> dict[str, Column]:
    c = F.col
    return {
        "source_oversized": (c("original_context_length") > max_context) | (c("original_context_chains") > max_chains),
        "within_budget": c("retained_context_length") <= max_context,
        "length_not_grown": c("original_context_length") >= c("retained_context_length"),
        "chains_not_grown": c("original_context_chains") >= c("retained_context_chains"),
        "dropped_adds_up": c("original_context_chains") - c("retained_context_chains") == c("dropped_context_chains"),
    }


def crop_order_violations(crops: DataFrame) -> DataFrame:
    """Neighbouring ranks of an entry whose (distance, chain) order goes down."""
    w = W.partitionBy("entry").orderBy("spatial_rank")  # kept chains only: bounded by the chain cap
    here = F.struct("distance", "chain")
    return crops.where("kind <> 'full_target'").withColumn("__p", F.lag(here).over(w)).where(F.col("__p") > here).drop("__p")


def crop_distance_violations(crops: DataFrame, residues: DataFrame, targets: DataFrame, tolerance: float = 1e-5) -> DataFrame:
    """Context chains whose recorded distance is not that of their recorded residue pair.

    ``residues``: entry, chain, pos (source position), ca.
    """
    points = residues.select("entry", "chain", "pos", "ca")
    a = targets.select("entry", F.col("chain").alias("__t"))
    joined = crops.where("kind <> 'full_target'").join(a, "entry").join(
        points.select("entry", F.col("chain").alias("__t"), F.col("pos").alias("target_index"), F.col("ca").alias("__a")), ["entry", "__t", "target_index"], "left").join(
        points.select("entry", "chain", F.col("pos").alias("source_index"), F.col("ca").alias("__b")), ["entry", "chain", "source_index"], "left")
    return joined.where(~F.coalesce(close(distance(F.col("__a"), F.col("__b")), F.col("distance"), tolerance, tolerance), F.lit(False))).select(*crops.columns)


def crop_audit(crops: DataFrame, totals: DataFrame, residues: DataFrame, targets: DataFrame, max_context: int, max_chains: int) -> DataFrame:
    tables = expect_empty({
        "rank_unique": duplicates(crops, ["entry", "spatial_rank"]),
        "rank_order": crop_order_violations(crops),
        "distance_recomputed": crop_distance_violations(crops, residues, targets),
    })
    return expect(crops, crop_rules(), "entry").unionByName(
        expect(totals, crop_totals_rules(max_context, max_chains), "entry")).unionByName(tables)


def split_files_audit(rows: DataFrame, valid: DataFrame, test: DataFrame, cluster: str = "cluster") -> DataFrame:
    """Split lists that overlap, name unknown clusters or list one twice."""
    v, t = valid.select(cluster), test.select(cluster)
    known = rows.select(cluster)
    return expect_empty({
        "valid_test_overlap": v.intersect(t),
        "unknown_valid_cluster": v.join(known, cluster, "left_anti"), "unknown_test_cluster": t.join(known, cluster, "left_anti"),
        "duplicate_valid_cluster": duplicates(v, [cluster]), "duplicate_test_cluster": duplicates(t, [cluster])})


def release_audit(
    rows: DataFrame, splits: DataFrame, quarantined: DataFrame | None, expected: dict[str, int] | None = None,
    id: str = "chain_id", entry: str = "entry_id", cluster: str = "cluster", sequence: str = "sequence",
) -> DataFrame:
    """Release-level rules: ids, split subsets, leaks by content and entry, quarantine, counts."""
    from .clusters import duplicate_targets, label_split

    placed = label_split(rows, splits, cluster)
    h = F.sha2(sequence, 256)
    leaks = leak_report(placed, "split", {"content": h, "entry": F.col(entry), "cluster": F.col(cluster)})
    leak_rows = leaks.select(F.concat(F.lit("leak_"), "key").alias("rule"), F.col("values").alias("checked"), F.col("leaks").alias("failed"), F.lit(None).cast("string").alias("example"))
    tables = {
        "duplicate_id": duplicates(rows, [id]),
        "entry_with_two_targets": duplicate_targets(rows, F.col(entry)),
        "unknown_split_cluster": splits.select(cluster).join(rows.select(cluster), cluster, "left_anti"),
        "cluster_in_two_splits": duplicates(splits.select(cluster, "split").distinct(), [cluster]),
    }
    if quarantined is not None:
        tables["quarantined_row_published"] = rows.join(quarantined.select(id), id, "left_semi")
        tables["duplicate_quarantine"] = duplicates(quarantined, [id])
        tables["quarantine_without_conflict"] = quarantined.where(F.size("reference_splits") < 2)
    report = expect_empty(tables).unionByName(leak_rows)
    if expected:
        counts = placed.agg(F.count("*").alias("rows"), *[F.count_if(F.col("split") == s).alias(s) for s in ("train", "valid", "test")])
        report = report.unionByName(expect(counts, {f"count_{k}": F.col(k) == v for k, v in expected.items()}))
    return report


def inheritance_audit(stage: DataFrame, reference: DataFrame, cluster: str = "cluster", sequence: str = "sequence", split: str = "split", entry: str = "entry_id") -> DataFrame:
    """Stage rows against the reference release: anchors by cluster and by content, entry overlap."""
    h = F.sha2(sequence, 256)
    s = stage.select(entry, F.col(cluster).alias("c"), h.alias("h"), F.col(split).alias("stage_split"))
    r = reference.select(F.col(cluster).alias("c"), h.alias("h"), F.col(split).alias("ref_split"))
    by_cluster = s.join(r.select("c", "ref_split").distinct(), "c").select(entry, "stage_split", "ref_split")
    by_content = s.join(r.select("h", "ref_split").distinct(), "h").select(entry, "stage_split", "ref_split")
    anchors = by_cluster.unionByName(by_content)
    return expect_empty({
        "split_differs_from_anchor": anchors.where("stage_split <> ref_split").select(entry).distinct(),
        "anchors_in_two_splits": anchors.groupBy(entry).agg((F.min("ref_split") < F.max("ref_split")).alias("x")).where("x"),
        "entry_in_both_releases": stage.join(reference.select(entry), entry, "left_semi"),
    })


def split_anchors(stage: DataFrame, reference: DataFrame, id: str, cluster: str, content: str, split: str) -> DataFrame:
    """(id, splits): reference splits a stage row is tied to by cluster or by exact content."""
    a = stage.join(reference.select(cluster, split).distinct(), cluster).select(id, split)
    b = stage.join(reference.select(content, split).distinct(), content).select(id, split)
    return a.unionByName(b).groupBy(id).agg(F.array_sort(F.collect_set(split)).alias("splits"))


def suite_audit(records: DataFrame, bins: DataFrame, expected_count: int, minimum: int, maximum: int) -> DataFrame:
    """Benchmark suite rules: ids, chains, clusters and sequences unique; bins contiguous, covering
    and counted right; lengths and hashes of the records true.

    ``records``: record_id, chain_id, cluster, sequence, sequence_sha256, length, length_bin.
    ``bins``: label, min_length, max_length, eligible, selected (a handful of rows).
    """
    placed = records.join(bins.select(F.col("label").alias("length_bin"), "min_length", "max_length"), "length_bin", "left")
    rows = expect(placed, {
        "length": F.length("sequence") == F.col("length"), "sequence_sha256": F.sha2("sequence", 256) == F.col("sequence_sha256"),
        "known_bin": F.col("min_length").isNotNull(), "inside_bin": F.length("sequence").between(F.col("min_length"), F.col("max_length"))}, "record_id")
    order = W.orderBy("min_length")
    chained = bins.withColumn("__next", F.lead("min_length").over(order)).withColumn("__first", F.row_number().over(order) == 1)
    counted = records.groupBy(F.col("length_bin").alias("label")).agg(F.count("*").alias("__n"))
    shape = expect(chained.join(counted, "label", "left"), {
        "bins_contiguous": F.coalesce(F.col("__next") == F.col("max_length") + 1, F.col("max_length") == maximum),
        "bins_start": ~F.col("__first") | (F.col("min_length") == minimum), "bins_ordered": F.col("max_length") >= F.col("min_length"),
        "bin_count": F.coalesce("__n", F.lit(0)) == F.col("selected"), "bin_eligible": F.col("eligible") >= F.col("selected")}, "label")
    tables = expect_empty({f"unique_{c}": duplicates(records, [c]) for c in ("record_id", "chain_id", "cluster", "sequence_sha256")})
    total = expect(records.agg(F.count("*").alias("n")), {"record_count": F.col("n") == expected_count})
    return rows.unionByName(shape).unionByName(tables).unionByName(total)


def generated_rules() -> dict[str, Column]:
    """Consistency of a generated sequence: designable, fixed, mutations, recovery, score."""
    c = F.col
    return {
        "positions_add_up": c("designable") + c("fixed") == c("length"),
        "mutations_range": (c("mutations") >= 0) & (c("mutations") <= c("designable")),
        "sequence_length": F.length("sequence") == c("length"),
        "recovery": close(c("recovery"), 1 - c("mutations") / F.greatest(c("designable"), F.lit(1)), 1e-12, 1e-12),
        "finite_score": ~F.isnan("score") & (F.abs("score") != F.lit(float("inf"))),
        "alphabet": c("sequence").rlike(f"^[{X.CANONICAL}]+$"),
    }


def result_valid(identity: str, metrics: Sequence[str] = ()) -> Column:
    """A stored result counts: its run identity, its own hash, its sequence and a final status.

    Columns: evaluation_identity, result_identity, derived_identity, sequence_sha256,
    expected_sequence_sha256, status and the metric columns, finite when it succeeded.
    """
    ok = (
        (F.col("evaluation_identity") == identity) & (F.col("result_identity") == F.col("derived_identity"))
        & (F.col("sequence_sha256") == F.col("expected_sequence_sha256")) & F.col("status").isin("succeeded", "failed"))
    for m in metrics:
        ok = ok & ((F.col("status") == "failed") | (F.col(m).isNotNull() & ~F.isnan(m) & (F.abs(F.col(m)) != F.lit(float("inf")))))
    return F.coalesce(ok, F.lit(False))


def pending(work: DataFrame, results: DataFrame, keys: Sequence[str], retry_failed: bool = False, valid: Column | None = None) -> DataFrame:
    """Work rows without a valid result; failed ones count as done unless retry is asked for."""
    done = results if valid is None else results.where(valid)
    if retry_failed:
        done = done.where("status = 'succeeded'")
    return work.join(done.select(*keys), list(keys), "left_anti")


def completeness(expected: DataFrame, results: DataFrame, key: str, summary: DataFrame | None = None) -> DataFrame:
    """Every expected record has a succeeded result and, if given, the summary agrees."""
    good = results.where("status = 'succeeded'").select(key)
    report = expect_empty({
        "missing_result": expected.select(key).join(good, key, "left_anti"),
        "unexpected_result": results.select(key).join(expected.select(key), key, "left_anti"),
        "duplicate_result": duplicates(results, [key])})
    if summary is not None:
        counts = expected.agg(F.count("*").alias("n")).crossJoin(good.agg(F.count("*").alias("g"))).crossJoin(summary)
        report = report.unionByName(expect(counts, {
            "summary_selected": F.col("selected") == F.col("n"), "summary_succeeded": F.col("succeeded") == F.col("g"),
            "summary_status": F.col("status") == "passed"}))
    return report


def matrix_gaps(dimensions: Sequence[DataFrame], observed: DataFrame) -> DataFrame:
    """Cells of a design matrix that are missing, extra or repeated.

    The expected matrix is the product of small dimension tables, which is its definition.
    """
    grid = dimensions[0].distinct()
    for d in dimensions[1:]:
        grid = grid.crossJoin(d.distinct())
    return set_difference(grid, observed.select(*grid.columns)).withColumn(
        "state", F.when(F.col("side") == "left_only", "missing").otherwise("unexpected")).drop("side")


def source_gate(manifest: DataFrame, files: DataFrame, pinned: DataFrame, expected_format: str) -> DataFrame:
    """Rules a source dataset must pass: format, status, no leaks, full coverage, pinned file hashes.

    ``manifest``: format, validation_status, content_leaks, entry_leaks, records, validated.
    ``files``: name, sha256; ``pinned``: name, sha256.
    """
    c = F.col
    head = expect(manifest, {
        "format": c("format") == expected_format, "validated": c("validation_status") == "ok",
        "no_leaks": (c("content_leaks") == 0) & (c("entry_leaks") == 0), "full_coverage": c("records") == c("validated")})
    return head.unionByName(expect_empty({"file_hash": set_difference(pinned.select("name", "sha256"), files.select("name", "sha256").join(pinned.select("name"), "name", "left_semi"))}))


def fasta_matches(records: DataFrame, content: DataFrame, order: str, line: str = "value") -> DataFrame:
    """Companion FASTA file against the rendering of its records.

    ``records``: order (record id) and value (rendered record); ``content``: line, value of the
    file. Compares line by line, so neither side is held as one text.
    """
    from .scale import row_numbers

    rendered = row_numbers(records.select(F.col(order), F.posexplode(F.split(line, "\n")).alias("__p", "value")), [order, "__p"], "line").select("line", "value")
    joined = rendered.withColumnRenamed("value", "a").join(content.select("line", F.col("value").alias("b")), "line", "full_outer")
    return joined.where(~F.col("a").eqNullSafe(F.col("b")))
