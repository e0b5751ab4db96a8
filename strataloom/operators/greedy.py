"""Order-dependent selections and packings, computed exactly without one big fold.

Greedy unique keeps rows that beat all rivals on both keys, round by round. Token batches fold
over the distinct sizes instead of the rows. Shard plans summarise every range of the order as
a small transfer table, chain the tables, and then place rows range by range.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..functions.text import rank_hash
from ..session import checkpointed
from .clusters import NotConverged
from .scale import join_groups, row_numbers


def greedy_unique(
    df: DataFrame, rank: Sequence[Column], keys: tuple[str, str], within: Sequence[str] = (), max_rounds: int = 200,
) -> DataFrame:
    """Rows a walk in ``rank`` order would keep when it skips rows with a used value of either key.

    Each round keeps the rows that come first for both their keys and drops the rows that share
    a key with them; the result equals the sequential walk. Copies of one key pair shrink to
    their first row before the rounds. ``rank`` must be total. ``within`` runs one walk per group.

    The first row of a key is a minimum, reduced map-side, and rounds meet by semi and anti joins
    only: the size that Spark expects of an inner join is the product of both sides and outlives a
    checkpoint, so over a few rounds of such joins it grows to a number too long to compute.
    """
    a, b = keys
    pair = [*within, a, b]
    rest = [c for c in df.columns if c not in pair]
    first = checkpointed(
        df.groupBy(*pair)
        .agg(F.min_by(F.struct(*rest), F.struct(*rank)).alias("__row"), F.min(F.struct(*rank)).alias("__rank"))
    )

    def leaders(key: str, other: str) -> DataFrame:
        least = pool.groupBy(*within, key).agg(F.min(F.struct("__rank", other)).alias("__least"))
        return least.select(*within, key, F.col(f"__least.{other}").alias(other))

    pool = first.select(*pair, "__rank")
    kept: DataFrame | None = None
    for _ in range(max_rounds):
        winners = checkpointed(join_groups(leaders(a, b), leaders(b, a), pair, "left_semi"))
        kept = winners if kept is None else kept.unionByName(winners)
        for key in keys:
            pool = join_groups(pool, winners.select(*within, key), [*within, key], "left_anti")
        pool = checkpointed(pool)
        if pool.isEmpty():
            break
    else:
        raise NotConverged(f"greedy selection did not settle in {max_rounds} rounds")
    return join_groups(first, kept, pair, "left_semi").select(*pair, *[F.col(f"__row.{c}").alias(c) for c in rest]).select(*df.columns)


def length_bins(low: int, high: int, count: int) -> list[tuple[str, int, int]]:
    """Contiguous integer bins (label, first, last) that cover low..high as evenly as integers allow."""
    width = high - low + 1
    if low < 1 or high < low or not 1 <= count <= width:
        raise ValueError("length bins do not fit the range")
    edges = [low + i * width // count for i in range(count + 1)]
    return [(f"length-{a:04d}-{b - 1:04d}", a, b - 1) for a, b in zip(edges, edges[1:])]


def bin_label(length: Column, bins: Sequence[tuple[str, int, int]]) -> Column:
    """Label of the bin that holds ``length``; NULL outside all bins."""
    out = F.lit(None).cast("string")
    for label, first, last in reversed(bins):
        out = F.when(length.between(first, last), label).otherwise(out)
    return out


def eligibility_funnel(df: DataFrame, steps: Sequence[tuple[str, Column]], unique: tuple[str, str] | None = None,
                       rank: Sequence[Column] = ()) -> DataFrame:
    """Rows left after each cumulative condition, counted in one pass (step, rows)."""
    passed, counters = F.lit(True), [("rows", F.count("*"))]
    for name, condition in steps:
        passed = passed & F.coalesce(condition, F.lit(False))
        counters.append((name, F.count_if(passed)))
    wide = df.agg(*[c.alias(n) for n, c in counters])
    if unique:
        left = greedy_unique(df.where(passed), rank, unique)
        wide = wide.crossJoin(left.agg(F.count("*").alias("unique_rows")))
    return wide


MAX_PICKS = 1000


def stratified_pick(
    df: DataFrame, id: str, length: str, cluster: str, content: str,
    bins: Sequence[tuple[str, int, int]], count: int, seed: int, strict: bool = True,
) -> DataFrame:
    """``count`` records spread over length bins, no cluster or content twice.

    Bins get equal quotas (the remainder goes to the first bins) and are served from the one
    with the fewest candidates up; open places are filled in hash order from all bins. At most
    ``MAX_PICKS`` records may be asked for. Each bin is one step that takes the first candidates,
    by a limited sort, whose cluster and content no earlier step used; only counts per bin reach
    the driver. A record outside all bins, or too few records, is an error; where not ``strict``,
    records outside the bins fill open places too, without a label and numbered last, and what
    can be picked is returned.
    """
    if not 1 <= count <= MAX_PICKS:
        raise ValueError(f"count must be between 1 and {MAX_PICKS}")
    rank = [F.col("__hash"), F.col(id)]
    rows = checkpointed(
        df.select(id, length, cluster, content, rank_hash(seed, F.col(id), F.col(content)).alias("__hash"),
                  bin_label(F.col(length), bins).alias("length_bin")))
    if strict and not rows.where(F.col("length_bin").isNull()).isEmpty():
        raise ValueError("a record lies outside all length bins")
    firsts = checkpointed(greedy_unique(rows.where(F.col("length_bin").isNotNull()), rank, (cluster, content), within=["length_bin"]))
    sizes = {r["length_bin"]: r["n"] for r in firsts.groupBy("length_bin").agg(F.count("*").alias("n")).collect()}
    base, extra = divmod(count, len(bins))
    quota = {label: base + (i < extra) for i, (label, _, _) in enumerate(bins)}

    def unused(candidates: DataFrame) -> DataFrame:
        # picks are at most MAX_PICKS rows
        for key in (cluster, content):
            candidates = candidates.join(F.broadcast(picks.select(key)), key, "left_anti")
        return candidates

    picks = rows.where(F.lit(False))
    for label, _, _ in sorted(bins, key=lambda b: (sizes.get(b[0], 0), b[1])):
        if quota[label] and sizes.get(label):
            served = unused(firsts.where(F.col("length_bin") == label)).orderBy(*rank).limit(quota[label])
            picks = checkpointed(picks.unionByName(served.select(picks.columns)))
    taken = picks.count()
    if taken < count:
        left = unused(rows)
        # the walk over all rows begins with the picks of the walk over the first of them, which mostly are enough
        for part in (left.orderBy(*rank).limit(16 * count), left):
            more = checkpointed(greedy_unique(part, rank, (cluster, content)).orderBy(*rank).limit(count - taken))
            if more.count() == count - taken:
                break
        picks = checkpointed(picks.unionByName(more.select(picks.columns)))
        taken = picks.count()
    if strict and taken < count:
        raise ValueError(f"only {taken} of {count} records can be picked")
    order = F.array_position(F.array(*[F.lit(label) for label, _, _ in bins]), F.col("length_bin"))
    place = W.orderBy(*[c.asc_nulls_last() for c in (order, F.col(length), F.col(id))])
    numbered = picks.select(F.format_string("record-%04d", F.row_number().over(place)).alias("record_id"), id, "length_bin")
    return df.join(F.broadcast(numbered), id)  # at most MAX_PICKS rows


# ---------------------------------------------------------------- token batches

def _fold_sizes(budget: int):
    def fold(batches):
        open_batch, filled, seen = 0, 0, 0
        for pdf in batches:
            out = []
            for size, n in zip(pdf["size"], pdf["n"]):
                cap = budget // size if size > 0 else filled + n
                first = min(n, max(0, cap - filled))
                rest = n - first
                fresh = open_batch + 1 if filled + first > 0 else open_batch
                out.append((size, seen, first, open_batch, fresh, max(cap, 1)))
                if rest:
                    more = -(-rest // cap)
                    open_batch, filled = fresh + more - 1, rest - (more - 1) * cap
                else:
                    filled += first
                seen += n
                out[-1] += (open_batch, n)
            yield pd.DataFrame(out, columns=["size", "seen", "first", "open_batch", "fresh", "cap", "last", "n"])
    return fold


def token_batches(df: DataFrame, id: str, size: str, budget: int, seed: int | None = None) -> DataFrame:
    """(id, size, batch): similar sizes together, largest size times rows within ``budget``.

    Rows are taken by (size, id); a row that would overflow the budget opens the next batch and
    a row above the budget is a batch of its own. Equal sizes are one step of the fold, so the
    fold sees at most ``budget`` distinct sizes however many rows there are. With ``seed`` a
    ``batch_order`` key to shuffle batches by is added.
    """
    rows = df.select(F.col(id).alias("id"), F.col(size).cast("bigint").alias("size"))
    fits = F.col("size") <= budget
    counts = rows.where(fits).groupBy("size").agg(F.count("*").alias("n"))
    plan = counts.repartitionByRange(1, "size").sortWithinPartitions("size").mapInPandas(
        _fold_sizes(int(budget)),
        "size bigint, seen bigint, first bigint, open_batch bigint, fresh bigint, cap bigint, last bigint, n bigint")
    plan = checkpointed(plan)
    placed = row_numbers(rows, ["size", "id"], "__at")
    inside = F.col("__at") - 1 - F.col("seen")
    batch = F.when(inside < F.col("first"), F.col("open_batch")).otherwise(
        F.col("fresh") + F.floor((inside - F.col("first")) / F.col("cap")))
    packed = placed.join(plan, "size", "left").withColumn("batch", batch)
    end = plan.agg(F.max("last").alias("last"), F.max(F.col("seen") + F.col("n")).alias("rows")).first()
    start, before = (end["last"] + 1, end["rows"]) if end["rows"] else (0, 0)
    out = packed.select(
        F.col("id").alias(id), F.col("size").alias(size),
        F.coalesce("batch", F.lit(start - before - 1) + F.col("__at")).cast("bigint").alias("batch"))
    if seed is not None:
        out = out.withColumn("batch_order", rank_hash(seed, F.col("batch")))
    return out


# ---------------------------------------------------------------- shard plan

def padded_record(size: Column, block: int = 512) -> Column:
    """Stored size of a record: one header block plus its blocks."""
    return F.lit(block) + F.ceil(size / F.lit(block)) * F.lit(block)


def _next_starts(prefix: np.ndarray, budget: int) -> np.ndarray:
    """Index of the record that opens the shard after the one opened by record i."""
    n = len(prefix) - 1
    after = np.searchsorted(prefix, prefix[:n] + budget, side="right") - 1
    return np.maximum(after, np.arange(n) + 1)


def _summarise_ranges(budget: int):
    def summarise(batches):
        parts = [p for p in batches if len(p)]
        if not parts:
            return
        pdf = pd.concat(parts)
        prefix = np.concatenate([[0], np.cumsum(pdf["padded"].to_numpy(np.int64))])
        n = len(prefix) - 1
        follow = np.append(_next_starts(prefix, budget), n)
        # last start of the walk from i, and how many shards that walk opens, by doubling
        jump, opened, last = follow.copy(), np.append(np.ones(n, np.int64), 0), np.arange(n + 1)
        inside = jump < n
        while inside.any():
            last = np.where(inside, last[jump], last)
            opened = opened + np.where(inside, opened[jump], 0)
            jump = np.where(inside, jump[jump], jump)
            inside = jump < n
        reach = int(np.searchsorted(prefix, budget, side="right"))
        starts = np.arange(min(reach, n))
        left = prefix[n] - prefix[last[starts]]
        count = opened[starts]
        change = np.flatnonzero(np.append(True, (left[1:] != left[:-1]) | (count[1:] != count[:-1])))
        yield pd.DataFrame({
            "range": [int(pdf["range"].iloc[0])], "total": [int(prefix[n])],
            "upto": [prefix[1:][np.append(change[1:] - 1, starts[-1])].tolist()],
            "left": [left[change].tolist()], "opened": [count[change].tolist()],
        })
    return summarise


def _chain_ranges(budget: int):
    def chain(batches):
        carry, opened = 0, 0
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                out.append((row[0], carry, opened))
                rng, total, upto, left, count = row
                if carry and carry + total <= budget:
                    carry += total
                    continue
                # the first start is the first record whose running size passes the free space
                at = 0 if carry == 0 else int(np.searchsorted(np.asarray(upto), budget - carry, side="right"))
                carry, opened = int(left[at]), opened + int(count[at])
            yield pd.DataFrame(out, columns=["range", "carry", "opened"])
    return chain


def _place_ranges(budget: int):
    def place(key, pdf):
        pdf = pdf.sort_values(["__pos"], kind="stable")
        prefix = np.concatenate([[0], np.cumsum(pdf["padded"].to_numpy(np.int64))])
        n = len(prefix) - 1
        carry, opened = int(pdf["carry"].iloc[0]), int(pdf["opened"].iloc[0])
        follow = _next_starts(prefix, budget)
        starts = np.zeros(n + 1, np.int64)
        at = 0 if carry == 0 else int(np.searchsorted(prefix[1:], budget - carry, side="right"))
        while at < n:
            starts[at] = 1
            at = follow[at]
        return pd.DataFrame({"id": pdf["id"], "padded": pdf["padded"],
                             "shard": opened - 1 + np.cumsum(starts[:n])})
    return place


def shard_plan(df: DataFrame, id: str, size: str, budget: int, order: Sequence[str]) -> DataFrame:
    """(id, padded_bytes, shard): records in order, a new shard when the next would pass ``budget``.

    A record above the budget gets a shard of its own. ``order`` must be total. Every range of
    the order is reduced to the outcome of each possible first start, run-length encoded; the
    tables are chained in one small task, and rows are then placed range by range.
    """
    id_type = df.schema[id].dataType.simpleString()
    keyed = df.select(
        F.col(id).alias("id"), F.struct(*order).alias("__pos"),
        padded_record(F.col(size)).cast("bigint").alias("padded"))
    ranged = checkpointed(
        keyed.repartitionByRange("__pos").sortWithinPartitions("__pos").withColumn("range", F.spark_partition_id()))
    tables = ranged.select("range", "padded").mapInPandas(
        _summarise_ranges(int(budget)),
        "range int, total bigint, upto array<bigint>, left array<bigint>, opened array<bigint>")
    chained = tables.repartitionByRange(1, "range").sortWithinPartitions("range").mapInPandas(
        _chain_ranges(int(budget)), "range int, carry bigint, opened bigint")
    located = row_in_range(ranged).join(chained, "range")
    placed = located.groupBy("range").applyInPandas(
        _place_ranges(int(budget)), f"id {id_type}, padded bigint, shard bigint")
    return placed.select(F.col("id").alias(id), F.col("padded").alias("padded_bytes"), "shard")


def row_in_range(ranged: DataFrame) -> DataFrame:
    """Replace the order struct by a running row number inside the written range."""
    return ranged.select("id", "padded", "range", F.monotonically_increasing_id().alias("__pos"))


def shard_summary(plan: DataFrame, prefix: str = "shard") -> DataFrame:
    """Shard name, record count and byte total."""
    return plan.groupBy("shard").agg(
        F.count("*").alias("records"), F.sum("padded_bytes").alias("bytes"),
    ).withColumn("name", F.format_string(f"{prefix}-%05d", F.col("shard")))
