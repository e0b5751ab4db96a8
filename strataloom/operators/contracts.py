"""Rules on contract documents: regions, orders, linkers, candidates, results."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as X
from ..functions.canonical import WORK_DROPPED, document_identity, work_id
from .expect import duplicates, expect, expect_empty
from .scale import ordered_scan
from .schemas import schema_report, schema_rules  # noqa: F401  document rules belong to the contracts


def overlapping_regions(regions: DataFrame, domain: Sequence[str], start: str, end: str, protected: str, id: str) -> DataFrame:
    """Mutable regions (``protected`` FALSE) with ``overlaps``: whether any protected region of the
    domain shares a position with them; both ends belong to a region.

    A region overlaps an earlier one exactly if the greatest protected end among the regions that
    start no later reaches it, and a later one if the least protected start after it is inside.
    Both are running values of one ordered scan, so no pair of regions is ever formed.
    """
    rows = regions.select(
        *domain, id, F.col(start).alias("s"), F.col(end).alias("e"), F.col(protected).alias("p"))
    marked = rows.withColumn("pe", F.when(F.col("p"), F.col("e")))
    # protected regions first among equal starts
    forward = ordered_scan(marked.withColumn("o", F.struct("s", F.when(F.col("p"), 0).otherwise(1).alias("k"), id)),
                           ["o"], {"reach": ("max", "pe")}, domain)
    backward = ordered_scan(
        marked.withColumn("ps", F.when(F.col("p"), F.col("s"))).withColumn(
            "o", F.struct((-F.col("s")).alias("s"), F.when(F.col("p"), 0).otherwise(1).alias("k"), id)),
        ["o"], {"ahead": ("min", "ps")}, domain)
    early = forward.where("not p").select(*domain, id, F.coalesce(F.col("reach") >= F.col("s"), F.lit(False)).alias("early"))
    late = backward.where("not p").select(*domain, id, F.coalesce(F.col("ahead") <= F.col("e"), F.lit(False)).alias("late"))
    return early.join(late, [*domain, id]).select(*domain, id, (F.col("early") | F.col("late")).alias("overlaps"))


def region_bounds(regions: DataFrame, domains: DataFrame) -> DataFrame:
    """Regions with ``problem``: unknown domain, start after end, past the end, wrong owner."""
    joined = regions.join(domains.select("doc_id", "domain_id", F.length("sequence").alias("__n")), ["doc_id", "domain_id"], "left")
    owner = F.col("owner_id") if "owner_id" in regions.columns else F.lit(None).cast("string")
    return joined.withColumn("problem", F.coalesce(
        F.when(F.col("__n").isNull(), "unknown_domain"), F.when(F.col("start") > F.col("end"), "start_after_end"),
        F.when(F.col("end") > F.col("__n"), "past_end"), F.when(owner.isNotNull() & (owner != F.col("domain_id")), "wrong_owner"))).drop("__n")


def order_problems(orders: DataFrame, domains: DataFrame) -> DataFrame:
    """Domain orders that repeat a domain or are no permutation of the document's domains."""
    known = domains.groupBy("doc_id").agg(F.array_sort(F.collect_set("domain_id")).alias("__all"))
    return orders.join(known, "doc_id", "left").withColumn("problem", F.coalesce(
        F.when(F.size(F.array_distinct("domain_order")) != F.size("domain_order"), "repeated_domain"),
        F.when(~F.array_sort("domain_order").eqNullSafe(F.col("__all")), "not_a_permutation"))).drop("__all")


def adjacent_pairs(orders: DataFrame) -> DataFrame:
    """(doc_id, order_id, at, left, right) of neighbouring domains."""
    n = F.size("domain_order")
    pairs = F.when(n > 1, F.arrays_zip(
        F.slice("domain_order", F.lit(1), n - 1).alias("l"), F.slice("domain_order", F.lit(2), n - 1).alias("r")))
    return orders.select("doc_id", "order_id", F.posexplode(pairs).alias("at", "p")).select(
        "doc_id", "order_id", "at", F.col("p.l").alias("left"), F.col("p.r").alias("right"))


def linker_problems(linkers: DataFrame, orders: DataFrame, domains: DataFrame, direct: DataFrame) -> DataFrame:
    """(doc_id, subject, problem) of linker options and uncovered pairs.

    ``linkers``: doc_id, linker_id, left, right, min_length, max_length, allowed_sequences.
    ``direct``: doc_id, allow_direct, maximum_total_length.
    """
    ids = domains.select("doc_id", F.col("domain_id"))
    pairs = adjacent_pairs(orders)
    seen = pairs.select("doc_id", "left", "right").distinct()
    bad = lambda df, subject, problem: df.select("doc_id", F.col(subject).cast("string").alias("subject"), F.lit(problem).alias("problem"))
    ends = linkers.select("doc_id", "linker_id", F.explode(F.array("left", "right")).alias("domain_id"))
    unknown = ends.join(ids, ["doc_id", "domain_id"], "left_anti")
    never = linkers.join(seen, ["doc_id", "left", "right"], "left_anti")
    reversed_ = linkers.where("min_length > max_length")
    outside = linkers.where(F.exists(F.coalesce("allowed_sequences", F.array().cast("array<string>")),
                                     lambda s: ~F.length(s).between(F.col("min_length"), F.col("max_length"))))
    options = linkers.groupBy("doc_id", "left", "right").agg(F.min("min_length").alias("shortest"))
    covered = pairs.join(options, ["doc_id", "left", "right"], "left").join(direct, "doc_id")
    open_ = covered.where(F.col("shortest").isNull() & ~F.col("allow_direct")).withColumn("pair", F.concat_ws("-", "left", "right"))
    lengths = orders.select("doc_id", "order_id", F.explode("domain_order").alias("domain_id")).join(
        domains.select("doc_id", "domain_id", F.length("sequence").alias("n")), ["doc_id", "domain_id"]).groupBy("doc_id", "order_id").agg(F.sum("n").alias("n"))
    links = covered.groupBy("doc_id", "order_id").agg(
        F.sum(F.when(F.col("allow_direct"), F.lit(0)).otherwise(F.coalesce("shortest", F.lit(0)))).alias("l"))
    long_ = lengths.join(links, ["doc_id", "order_id"], "left").join(direct, "doc_id").where(
        F.col("n") + F.coalesce("l", F.lit(0)) > F.col("maximum_total_length"))
    return (bad(unknown, "linker_id", "unknown_domain").unionByName(bad(never, "linker_id", "never_adjacent"))
            .unionByName(bad(reversed_, "linker_id", "min_above_max")).unionByName(bad(outside, "linker_id", "sequence_length"))
            .unionByName(bad(duplicates(linkers, ["doc_id", "linker_id"]), "linker_id", "duplicate_linker"))
            .unionByName(bad(open_, "pair", "uncovered_pair").distinct()).unionByName(bad(long_, "order_id", "minimum_above_maximum")))


def target_problems(domains: DataFrame, regions: DataFrame, orders: DataFrame, linkers: DataFrame, direct: DataFrame) -> DataFrame:
    """(doc_id, subject, problem) over all target rules.

    ``regions``: doc_id, region_id, domain_id, owner_id, start, end, kind (immutable, fixed, mutable).
    """
    bad = lambda df, subject: df.where("problem is not null").select("doc_id", F.col(subject).cast("string").alias("subject"), "problem")
    kinds = regions.withColumn("protected", F.col("kind") != "mutable")
    over = overlapping_regions(kinds, ["doc_id", "domain_id"], "start", "end", "protected", "region_id").where("overlaps").select(
        "doc_id", F.col("region_id").cast("string").alias("subject"), F.lit("mutable_overlaps_protected").alias("problem"))
    twice = duplicates(domains, ["doc_id", "domain_id"]).select("doc_id", F.col("domain_id").alias("subject"), F.lit("duplicate_domain").alias("problem"))
    return (bad(region_bounds(regions, domains), "region_id").unionByName(bad(order_problems(orders, domains), "order_id"))
            .unionByName(linker_problems(linkers, orders, domains, direct)).unionByName(over).unionByName(twice))


def candidate_rules() -> dict[str, Column]:
    """Rules of candidate rows: translation, hashes, required checks, conditional transcript.

    Columns: protein_sequence, cds_sequence (NULL without transcript), translation_check,
    translated_protein_sha256, check_translation, check_immutable, check_length, check_safety,
    decision, scores (map).
    """
    c = F.col
    has = c("cds_sequence").isNotNull()
    passed = has & (c("translation_check") == "passed")
    retained = c("decision") == "retained"
    return {
        "translates": ~has | X.translate(c("cds_sequence")).isNotNull(),
        "checks_agree": ~has | (c("translation_check") == c("check_translation")),
        "translation_equal": ~passed | (X.translate(c("cds_sequence")) == c("protein_sequence")),
        "protein_hash": ~passed | (c("translated_protein_sha256") == F.sha2("protein_sequence", 256)),
        "not_run_without_transcript": has | (c("check_translation") == "not_run"),
        "retained_checks": ~retained | ((c("check_immutable") == "passed") & (c("check_length") == "passed") & (c("check_safety") == "passed")
                                        & (~has | (c("check_translation") == "passed"))),
        "finite_scores": F.coalesce(F.forall(F.map_values("scores"), lambda s: s.isNull() | (~F.isnan(s) & (F.abs(s) != F.lit(float("inf"))))), F.lit(True)),
    }


def work_item_rules(doc: str = "document", stage: str = "stage") -> dict[str, Column]:
    """Work item rules: the id derives from the document, and only smoke work passes an unreviewed target."""
    return {
        "derived_id": F.col("work_id") == work_id(F.col(doc), F.col(stage)),
        "safety_class": ~F.coalesce("override_used", F.lit(False)) | (F.col("execution_class") == "smoke"),
        "identifier": X.is_identifier(F.col("work_id")),
    }


def enqueue(existing: DataFrame, incoming: DataFrame, doc: str = "document") -> tuple[DataFrame, DataFrame]:
    """(new items, collisions): a known id with the same identity is ignored, another identity is an error."""
    tag = lambda df: df.withColumn("__identity", document_identity(F.col(doc), WORK_DROPPED))
    first = tag(incoming).groupBy("work_id").agg(
        F.min_by(F.struct(*[c for c in incoming.columns if c != "work_id"]), F.struct("__identity", doc)).alias("__r"),
        F.min("__identity").alias("__low"), F.max("__identity").alias("__high"))
    old = tag(existing).select("work_id", F.col("__identity").alias("__old"))
    joined = first.join(old, "work_id", "left")
    clash = (F.col("__low") != F.col("__high")) | (F.col("__old").isNotNull() & (F.col("__old") != F.col("__low")))
    rest = [c for c in incoming.columns if c != "work_id"]
    new = joined.where(~clash & F.col("__old").isNull()).select("work_id", *[F.col(f"__r.{c}").alias(c) for c in rest])
    return new, joined.where(clash).select("work_id")


def tool_result_rules() -> dict[str, Column]:
    """Result rules: ids, status, attempt, time order, an error with every failure."""
    c = F.col
    start, end = X.utc_timestamp(c("started_at_utc")), X.utc_timestamp(c("finished_at_utc"))
    return {
        "work_id": X.is_identifier(c("work_id")), "worker_id": X.is_identifier(c("worker_id")),
        "status": c("status").isin("succeeded", "failed", "retryable"), "attempt": c("attempt") >= 1,
        "times_parse": start.isNotNull() & end.isNotNull(), "time_order": end >= start,
        "runtime": c("runtime_seconds") >= 0, "error_on_failure": (c("status") == "succeeded") | c("error_type").isNotNull(),
    }


def artifact_problems(artifacts: DataFrame, files: DataFrame) -> DataFrame:
    """Artifacts with ``problem``: path not inside the run, wrong attempt folder, missing, size or hash.

    ``artifacts``: work_id, attempt, path, bytes, sha256. ``files``: path (relative), bytes, sha256.
    """
    parts = F.split("path", "/")
    own = F.concat(F.lit("work/"), "work_id", F.lit("/attempt-"), F.col("attempt").cast("string"), F.lit("/"))
    joined = artifacts.join(files.select("path", F.col("bytes").alias("__b"), F.col("sha256").alias("__h")), "path", "left")
    return joined.withColumn("problem", F.coalesce(
        F.when(F.startswith("path", F.lit("/")) | F.array_contains(parts, ".."), "not_relative"),
        F.when(~F.get(parts, F.lit(0)).isin("work", "artifacts"), "outside_run"),
        F.when((F.get(parts, F.lit(0)) == "work") & ~F.startswith("path", own), "other_attempt"),
        F.when(F.col("__b").isNull(), "missing"), F.when(F.col("__b") != F.col("bytes"), "bytes"),
        F.when(F.col("__h") != F.col("sha256"), "sha256"))).drop("__b", "__h")


def job_rules(model_id: str, revision: str) -> dict[str, Column]:
    """Record rules of a prediction job: pinned model, lineage, canonical sequences, lengths, hashes."""
    c = F.col
    return {
        "model": (c("model_id") == model_id) & (c("model_revision") == revision), "lineage": c("lineage").isNotNull(),
        "identifier": X.is_identifier(c("record_id")), "alphabet": c("sequence").rlike(f"^[{X.CANONICAL}]+$"),
        "length": F.length("sequence") == c("length"), "sequence_sha256": F.sha2("sequence", 256) == c("sequence_sha256"),
    }


def job_audit(records: DataFrame, selection: DataFrame, model_id: str, revision: str) -> DataFrame:
    """Job document rules plus the positional match of records and selection snapshot.

    Both tables carry ``position``; records also record_id, record_key, sequence_sha256.
    """
    rows = expect(records, job_rules(model_id, revision), "record_id")
    a = records.select("position", F.col("record_key").alias("a"), F.col("sequence_sha256").alias("ah"))
    b = selection.select("position", F.col("record_key").alias("b"), F.col("sequence_sha256").alias("bh"))
    off = a.join(b, "position", "full_outer").where(~(F.col("a").eqNullSafe(F.col("b")) & F.col("ah").eqNullSafe(F.col("bh"))))
    return rows.unionByName(expect_empty({
        "unique_record_id": duplicates(records, ["record_id"]), "unique_record_key": duplicates(records, ["record_key"]),
        "selection_position": off}))


# ---------------------------------------------------------------- open documents

def unknown_fields(docs: DataFrame, doc: str, known: Sequence[str], out: str = "extra") -> DataFrame:
    """Open documents: keys outside the known ones as a map of text, kept instead of dropped."""
    everything = F.from_json(doc, "map<string,string>")
    return docs.withColumn(out, F.map_filter(everything, lambda k, v: ~k.isin(list(known))))
