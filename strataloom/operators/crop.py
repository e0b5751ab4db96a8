"""Budgeted cropping: a full target, then the nearest chains, whole or as one window."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import window_start
from ..session import checkpointed
from .scale import GROUP_ROWS, join_groups, row_numbers
from .select import spatial_rank, target_member

BLOCK = 2048


def _walk(rows: Column, remaining: Column, kept: Column, min_length: int, max_chains: int,
          min_resolved: int, min_coverage: float, pick_type: str) -> Column:
    """Fold over an entry's ranked chains: what is left, how many are kept, and the picks."""
    start_state = F.struct(
        remaining.alias("remaining"), kept.alias("kept"), F.array().cast(f"array<{pick_type}>").alias("picks"))

    def step(state: Column, chain: Column) -> Column:
        size = F.least(chain["length"], state["remaining"])
        start = F.when(size == chain["length"], F.lit(0).cast("bigint")).otherwise(
            window_start(chain["length"], size, chain["center"]))
        resolved = F.char_length(F.replace(F.substring(chain["marks"], (start + 1).cast("int"), size.cast("int")), F.lit("0"), F.lit("")))
        good = chain["marks"].isNull() | (
            (resolved >= min_resolved) & (resolved / F.greatest(size, F.lit(1)) >= F.lit(float(min_coverage))))
        take = ((state["remaining"] >= min_length) & (state["kept"] < max_chains)
                & (size >= min_length) & chain["center"].isNotNull() & good)
        pick = F.struct(
            chain["chain"].alias("chain"), chain["spatial_rank"].alias("spatial_rank"), start.alias("start"),
            (start + size).alias("end"),
            F.when(size == chain["length"], "full_context").otherwise("context_window").alias("kind"))
        return F.when(take, F.struct(
            (state["remaining"] - size).alias("remaining"), (state["kept"] + 1).alias("kept"),
            F.concat(state["picks"], F.array(pick).cast(f"array<{pick_type}>")).alias("picks"))).otherwise(state)

    return F.aggregate(rows, start_state, step)


def budget_crop(
    chains: DataFrame, budget: int, max_chains: int, min_length: int,
    min_resolved: int = 0, min_coverage: float = 0.0, block: int = BLOCK,
) -> tuple[DataFrame, DataFrame]:
    """Crop every entry to ``budget`` residues; returns (crops, skipped entries).

    ``chains`` columns: entry, chain, length, is_target, spatial_rank (from 1, NULL for the
    target), center (nearest residue, NULL when there is none) and optionally ``resolved_mask``
    (one boolean per residue), which the quality gate needs. In rank order a chain is kept
    whole if it fits, else as one centred window of what is left; a chain that fails the gate
    costs nothing; the walk stops when less than ``min_length`` is left or ``max_chains`` are
    kept. Chains are walked in blocks of ``block`` ranks, and only entries that are not finished
    go on to their next block, so an entry of any size never sits in one task.
    """
    gated = "resolved_mask" in chains.columns and (min_resolved > 0 or min_coverage > 0)
    # everything below starts from these columns: write them once
    chains = checkpointed(chains.select(
        "entry", "chain", "length", "is_target", "spatial_rank", "center", *(["resolved_mask"] if gated else [])))
    target = chains.where("is_target").select("entry", F.col("chain").alias("target"), F.col("length").alias("target_length"))
    skipped = target.where(F.col("target_length") > budget).withColumn("reason", F.lit("target_too_long_for_complete_crop"))
    # one mark per residue: a window counts its marks, and only windows that are tried are counted
    marks = F.array_join(F.transform("resolved_mask", lambda x: F.when(x, "1").otherwise("0")), "") if gated else F.lit(None).cast("string")
    # the target goes with the first block
    context = chains.withColumn("__block", F.when(F.col("is_target"), 0).otherwise(F.floor((F.col("spatial_rank") - 1) / block)).cast("int"))
    context = context.select(
        "entry", "chain", "is_target", F.col("length").cast("bigint").alias("length"), F.col("center").cast("bigint").alias("center"),
        F.col("spatial_rank").cast("bigint").alias("spatial_rank"), marks.alias("marks"), "__block")
    blocks = context.agg(F.max("__block")).first()[0] or 0
    chain_type = chains.schema["chain"].dataType.simpleString()
    pick_type = f"struct<chain:{chain_type},spatial_rank:bigint,start:bigint,end:bigint,kind:string>"
    # at most ``block`` rows each
    rows = F.array_sort(F.collect_list(F.when(~F.col("is_target"), F.struct("spatial_rank", "chain", "length", "center", "marks")))).alias("rows")
    walk = lambda remaining, kept: _walk(
        F.col("rows"), remaining, kept, min_length, max_chains, min_resolved, min_coverage, pick_type).alias("end")
    # one grouping by entry brings the target and its nearest chains together
    begun = context.where(F.col("__block") == 0).groupBy("entry").agg(
        rows, F.min(F.when(F.col("is_target"), F.struct("length", "chain"))).alias("target")).where(F.col("target.length") <= budget)
    full = F.struct(F.col("target.chain").alias("chain"), F.lit(0).cast("bigint").alias("spatial_rank"), F.lit(0).cast("bigint").alias("start"),
                    F.col("target.length").alias("end"), F.lit("full_target").alias("kind"))
    walked = begun.select("entry", F.array(full).cast(f"array<{pick_type}>").alias("full"), walk(
        F.lit(budget).cast("bigint") - F.col("target.length"), F.lit(1).cast("bigint")))
    if blocks:
        walked = checkpointed(walked)
    crops = walked.select("entry", F.explode(F.concat("full", "end.picks")).alias("p")).select("entry", "p.*")
    for at in range(1, blocks + 1):
        state = checkpointed(walked.select("entry", "end.remaining", "end.kept").where(
            (F.col("remaining") >= min_length) & (F.col("kept") < max_chains)))
        if state.isEmpty():
            break
        part = context.where(F.col("__block") == at).join(state, "entry").groupBy("entry").agg(
            rows, F.first("remaining").alias("remaining"), F.first("kept").alias("kept"))
        walked = checkpointed(part.select("entry", walk(F.col("remaining"), F.col("kept"))))
        crops = crops.unionByName(walked.select("entry", F.explode("end.picks").alias("p")).select("entry", "p.*"))
    return crops, skipped


def rank_chains(
    chains: DataFrame, order: Sequence[str], score: str, distance: str, group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """``chains`` of entries with ``chain``, their number in ``order``, ``is_target``, the highest ``score`` and then the lowest
    number, and ``spatial_rank``, by distance, NULL for the target.

    Entries of at most ``group_rows`` rows, which are counted, are numbered and ranked behind one shuffle; larger ones
    by distributed scans.
    """
    def plain(part: DataFrame) -> DataFrame:
        entry = W.partitionBy("entry")
        part = part.withColumn("chain", F.row_number().over(entry.orderBy(*order)).cast("bigint"))
        part = part.withColumn("is_target", F.col("chain") == F.first("chain").over(entry.orderBy(-F.col(score), "chain")))
        rank = F.row_number().over(W.partitionBy("entry", "is_target").orderBy(F.coalesce(F.col(distance), F.lit(float("inf"))), "chain"))
        return part.withColumn("spatial_rank", F.when(~F.col("is_target"), rank.cast("bigint")))

    large = chains.groupBy("entry").agg(F.count("*").alias("__n")).where(F.col("__n") > group_rows).select("entry")
    large = checkpointed(large)
    if large.isEmpty():
        return plain(chains)
    numbered = checkpointed(row_numbers(join_groups(chains, large, ["entry"], "left_semi"), order, "chain", ["entry"], group_rows))
    target = target_member(numbered.select("entry", "chain", score), ["entry"], [score], "chain").select("entry", F.col("chain").alias("__target"))
    marked = numbered.join(target, "entry").withColumn("is_target", F.col("chain") == F.col("__target")).drop("__target")
    ranked = spatial_rank(marked.where("not is_target"), ["entry"], distance, "chain")
    return plain(join_groups(chains, large, ["entry"], "left_anti")).unionByName(ranked).unionByName(
        marked.where("is_target"), allowMissingColumns=True)


def crop_residues(residues: DataFrame, crops: DataFrame, entry: str = "entry", chain: str = "chain", pos: str = "pos") -> DataFrame:
    """Residues inside the kept intervals, renumbered from 0, with their source position."""
    kept = crops.select(F.col("entry").alias(entry), F.col("chain").alias(chain), "start", "end")
    return residues.join(kept, [entry, chain]).where(
        (F.col(pos) >= F.col("start")) & (F.col(pos) < F.col("end"))
    ).withColumn("source_pos", F.col(pos)).withColumn(pos, F.col(pos) - F.col("start")).drop("start", "end")


def crop_totals(chains: DataFrame, crops: DataFrame) -> DataFrame:
    """Original and retained chains and residues per entry."""
    before = chains.groupBy("entry").agg(
        F.count("*").alias("original_context_chains"), F.sum("length").alias("original_context_length"))
    after = crops.groupBy("entry").agg(
        F.count("*").alias("retained_context_chains"), F.sum(F.col("end") - F.col("start")).alias("retained_context_length"))
    return before.join(after, "entry").withColumn(
        "dropped_context_chains", F.col("original_context_chains") - F.col("retained_context_chains"))
