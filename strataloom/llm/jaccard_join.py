"""N-gram Jaccard join: MinHash LSH forest for candidates, exact verification on whole shingle sets."""

from __future__ import annotations

import hashlib
from functools import reduce

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window as W, functions as F

from ..operators.clusters import connected_labels
from .common import ROW_KEY, TEXT_BATCH_ROWS, keyed, maybe_broadcast, prepare, stored
from .wordhash import mix64, shingle_sets, text_slices, word_hashes

THRESHOLD, SHINGLE, TREES, LONGEST, RECALL = 0.8, 5, 24, 8, 0.99999
#: Members and shingles of a verification block; a task holds at most two blocks.
BLOCK_NODES, BLOCK_SHINGLES = 512, 1 << 19
#: Row keys (24 bytes each) up to which the candidates are broadcast to the documents.
BROADCAST_ROWS = 1_000_000
#: Similarities of found links are counted in this many steps.
STEPS = 1000
LINKS = "node binary, root binary, links bigint, step bigint"


def forest_recall(similarity: float, depth: int, trees: int) -> float:
    """Chance that two sets of this similarity share a prefix of ``depth`` in one of the tries."""
    return 1.0 - (1.0 - similarity ** depth) ** trees


def reached_recall(found: dict[float, int], depth: int, threshold: float = THRESHOLD, trees: int = TREES) -> float:
    """Estimated share of the links that prefixes of ``depth`` bring together.

    ``found`` counts the links found so far by similarity. Each stands for the links as similar that
    stayed apart, by its chance to be found; one more link at the threshold stands for those of
    which no example was found.
    """
    missed = sum(n * (1 / forest_recall(s, depth, trees) - 1) for s, n in [*found.items(), (threshold, 1)])
    total = sum(found.values()) + 1
    return total / (total + missed)


def _signer(size: int, trees: int):
    """Arrow batches of (row key, none, text) to (row key, none, node, n, tries): node names the shingle set,
    tries holds its signature in each trie, LONGEST values of two bytes, so that a prefix of the bytes is one of values."""
    def sign(batches):
        odd = mix64(np.arange(1, trees * LONGEST + 1, dtype=np.uint64)) | np.uint64(1)
        flip = mix64(np.arange(10_001, trees * LONGEST + 10_001, dtype=np.uint64))
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(3)):
                n = len(offsets) - 1
                hashes, doc, _, _ = word_hashes(data, offsets)
                values, starts = shingle_sets(hashes, doc, n, size)
                full = np.flatnonzero(starts[1:] > starts[:-1])
                least = np.zeros((len(full), trees * LONGEST), dtype=np.uint16)
                for k in range(trees * LONGEST if len(full) else 0):
                    least[:, k] = mix64(np.minimum.reduceat((values ^ flip[k]) * odd[k], starts[full])) >> np.uint64(48)
                nodes, lists = [None] * n, [None] * n
                for i, d in enumerate(full):
                    nodes[d] = hashlib.md5(values[starts[d]:starts[d + 1]].tobytes()).digest()
                    lists[d] = [row.tobytes() for row in least[i].reshape(trees, LONGEST)]
                yield pa.RecordBatch.from_arrays([
                    *[batch.column(i).slice(first, n) for i in range(3)], pa.array(nodes, pa.binary()),
                    pa.array(np.diff(starts), pa.int64()), pa.array(lists, pa.list_(pa.binary()))],
                    names=[*ROW_KEY, "none", "node", "n", "tries"])
    return sign


def _set_reader(size: int):
    """Arrow batches of (node, n_docs, tries, block columns..., text) with the text replaced by its shingles."""
    def read(batches):
        for batch in batches:
            last = batch.num_columns - 1
            for first, data, offsets in text_slices(batch.column(last)):
                n = len(offsets) - 1
                hashes, doc, _, _ = word_hashes(data, offsets)
                values, starts = shingle_sets(hashes, doc, n, size)
                sets = [values[a:b].tobytes() for a, b in zip(starts[:-1], starts[1:])]
                columns = [batch.column(i).slice(first, n) for i in range(last)] + [pa.array(sets, pa.binary())]
                yield pa.RecordBatch.from_arrays(columns, names=[*batch.schema.names[:last], "shingles"])
    return read


def _intersections(sets: list[np.ndarray], left: np.ndarray, right: np.ndarray) -> np.ndarray:
    """Common values of the set pairs (left[i], right[i]): few pairs by merging, many by a product of incidence matrices."""
    if len(left) <= 16 * len(sets):
        return np.array([len(np.intersect1d(sets[a], sets[b], assume_unique=True)) for a, b in zip(left, right)], dtype=np.int64)
    owner = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    _, code, times = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    shared = times[code] > 1
    owner, code = owner[shared], code[shared]
    order = np.argsort(code, kind="stable")
    owner, code = owner[order], code[order]
    total = np.zeros((len(sets), len(sets)), dtype=np.float32)
    width = 8192
    for low in range(0, int(code[-1]) + 1 if len(code) else 0, width):
        a, b = np.searchsorted(code, (low, low + width))
        if a < b:
            part, column = np.unique(code[a:b], return_inverse=True)
            grid = np.zeros((len(sets), len(part)), dtype=np.float32)
            grid[owner[a:b], column] = 1
            total += grid @ grid.T
    return total[left, right].astype(np.int64)


def _verifier(threshold: float, depth: int, before: int | None):
    def verify(members: pd.DataFrame) -> pd.DataFrame:
        """Links that are new at this depth, between the members of one block or across the two blocks of a cell:
        rows of linked nodes, and rows without a node that count the links by similarity."""
        members = members.drop_duplicates("node").reset_index(drop=True)
        sets = [np.frombuffer(s, dtype=np.uint64) for s in members["shingles"]]
        tries = np.frombuffer(b"".join(b"".join(t) for t in members["tries"]), dtype=np.uint16).reshape(len(sets), -1, LONGEST)
        side, paired = members["side"].to_numpy(), bool(members["paired"].iloc[0])
        near = np.zeros((len(sets), len(sets)), dtype=bool)
        known = np.zeros_like(near)
        for t in range(tries.shape[1]):
            same = np.ones_like(near)
            for k in range(before or depth):
                if k == depth:
                    near |= same
                same &= tries[:, t, k][:, None] == tries[:, t, k][None, :]
            if before:
                known |= same
            else:
                near |= same
        # pairs that share a prefix of the depth before were compared then
        near &= ~known
        if paired:
            near &= side[:, None] < side[None, :]
        left, right = np.nonzero(near if paired else np.triu(near, 1))
        size = np.array([len(s) for s in sets], dtype=np.int64)
        # sets whose sizes differ too much cannot reach the threshold
        able = np.minimum(size[left], size[right]) >= threshold * np.maximum(size[left], size[right]) - 1e-9
        left, right = left[able], right[able]
        common = _intersections(sets, left, right)
        alike = common / np.maximum(size[left] + size[right] - common, 1)
        linked = alike >= threshold
        left, right, alike = left[linked], right[linked], alike[linked]
        weight = members["n_docs"].to_numpy().astype(np.float64)
        links = np.bincount(left, weight[right], len(sets)) + np.bincount(right, weight[left], len(sets))
        root = np.arange(len(sets))
        while True:
            low = root.copy()
            np.minimum.at(low, left, root[right])
            np.minimum.at(low, right, root[left])
            low = low[low]
            if (low == root).all():
                break
            root = low
        hit = np.flatnonzero(links > 0)
        step, times = np.unique((alike * STEPS).astype(np.int64), return_counts=True)
        node = members["node"].to_numpy()
        return pd.DataFrame({"node": [*node[hit], *[None] * len(step)], "root": [*node[root[hit]], *[None] * len(step)],
                             "links": [*links[hit].astype(np.int64), *times], "step": [*[-1] * len(hit), *step]})
    return verify


def _meetings(tries: DataFrame, depth: int, before: int | None) -> DataFrame:
    """(node, key): the nodes of each trie node of this depth that joins several of the depth before."""
    key = F.concat(F.col("tree"), F.substring("path", 1, 2 * depth)).alias("key")
    longer = F.substring("path", 1, 2 * before) if before else F.col("node")
    joins = tries.groupBy(key).agg(F.min(longer).alias("low"), F.max(longer).alias("high")).where("low < high").select("key")
    return tries.select("node", key).join(joins, "key")


def _cells(nodes: DataFrame, meetings: DataFrame, labels: DataFrame) -> DataFrame:
    """(node, n_docs, tries, row key, cell, side, paired): where each candidate is compared.

    ``labels`` gives the component of the nodes that meet. Small components share cells, about a
    block each. A component above a block is dealt over blocks by a hash; two blocks have a cell
    with those of their members that meet one of the other block in a trie node, so the cells
    follow what meets and no task holds more than two blocks. ``paired`` tells them from the cells of one block.
    """
    members = nodes.join(labels, "node")
    sizes = stored(members.groupBy("comp").agg(F.count("*").alias("size"), F.sum("n").alias("weight")).select("comp", F.greatest(
        F.ceil(F.col("size") / BLOCK_NODES), F.ceil(F.col("weight") / BLOCK_SHINGLES)).cast("int").alias("blocks"), "size", "weight"))
    alone = sizes.where("blocks = 1").agg(F.sum("size"), F.sum("weight")).first()
    shared = 1 + max((alone[0] or 0) // BLOCK_NODES, (alone[1] or 0) // BLOCK_SHINGLES)
    placed = members.join(sizes.select("comp", "blocks"), "comp").withColumn("block", F.pmod(F.xxhash64("node"), F.col("blocks")).cast("int"))
    single = placed.where("blocks = 1").withColumns({
        "cell": F.concat(F.lit("s"), F.pmod(F.xxhash64("comp"), F.lit(shared)).cast("string")), "side": F.lit(0), "paired": F.lit(False)})
    large = placed.where("blocks > 1")
    at = meetings.join(large.select("node", "block"), "node")
    # a trie node's blocks are few numbers, whatever the number of its members
    met = at.join(at.groupBy("key").agg(F.collect_set("block").alias("others")), "key").select(
        "node", F.explode("others").alias("other")).distinct()
    dealt = large.join(met, "node").withColumns({
        "cell": F.concat_ws("-", F.hex("comp"), F.least("block", "other").cast("string"), F.greatest("block", "other").cast("string")),
        "side": F.when(F.col("block") > F.col("other"), 1).otherwise(0),
        "paired": F.col("block") != F.col("other")})
    keep = ["node", "n_docs", "tries", *[F.col(f"first.{k}").alias(k) for k in ROW_KEY], "cell", "side", "paired"]
    return single.select(keep).unionByName(dealt.select(keep))


def _level(rows: DataFrame, text: str, nodes: DataFrame, tries: DataFrame, depth: int, before: int | None,
           threshold: float, shingle: int) -> DataFrame | None:
    """(node, root, links, step): what is found at one depth of the tries, see ``_verifier``; None where nothing meets anew."""
    meetings = stored(_meetings(tries, depth, before))
    if meetings.isEmpty():
        return None
    low = meetings.groupBy("key").agg(F.min("node").alias("low"))
    stars = meetings.join(low, "key").where("node <> low").select(F.col("node").alias("u"), F.col("low").alias("v"))
    labels = connected_labels(stars).select("node", F.col("label").alias("comp"))
    labels = stored(labels.unionByName(labels.select(F.col("comp").alias("node"), "comp").distinct()))
    cells = stored(_cells(nodes, meetings, labels))
    # one row of each key: its text goes to a cell once, however often the row is repeated
    texts = rows.select(*ROW_KEY, text).join(maybe_broadcast(
        cells.select(*ROW_KEY).distinct(), labels.count(), BROADCAST_ROWS), ROW_KEY, "left_semi").dropDuplicates(ROW_KEY)
    read = cells.join(texts, ROW_KEY).select("node", "n_docs", "tries", "cell", "side", "paired", text)
    sets = read.mapInArrow(_set_reader(shingle), "node binary, n_docs bigint, tries array<binary>, cell string, side int, paired boolean, shingles binary")
    return stored(sets.groupBy("cell").applyInPandas(_verifier(threshold, depth, before), LINKS))


def similar_classes(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                    shingle: int = SHINGLE, trees: int = TREES, recall: float = RECALL) -> DataFrame:
    """One row per row of ``docs``: row key, ``id``, ``class_id``, ``n_links``, ``keeper``.

    Two rows are linked when the Jaccard similarity of their sets of ``shingle``-word runs is at
    least ``threshold``; ``n_links`` counts the other rows linked to one, copies included.
    Candidates share a signature prefix in one of the tries. Prefixes begin at their whole length and
    are shortened until the links found let ``recall`` be expected (``reached_recall``), each time
    to the longest ones that would do for the links known by then.
    Classes are what links connect; ``class_id`` is the least id in one. ``keeper`` marks the row
    of the least id and, among equals, text hash (repeated rows are all marked).
    Texts of fewer words have one shingle of all of them. NULL and empty texts have no shingles:
    no links, a class of their own with their own id. NULL ids sort last.
    """
    prepare(docs.sparkSession, TEXT_BATCH_ROWS)
    rows = keyed(docs.select(id, text), id, text).select(*ROW_KEY, F.col(id).isNull().alias("none"), text)
    kind = rows.schema[ROW_KEY[0]].dataType.simpleString()
    signed = stored(rows.mapInArrow(_signer(shingle, trees), (
        f"{ROW_KEY[0]} {kind}, {ROW_KEY[1]} bigint, none boolean, node binary, n bigint, tries array<binary>")))
    # equal sets become one node; a group of copies costs one row per task from here on
    nodes = stored(signed.where("node IS NOT NULL").groupBy("node").agg(
        F.count("*").alias("n_docs"), F.min(F.struct("none", *ROW_KEY)).alias("first"), F.first("n").alias("n"), F.first("tries").alias("tries")))
    branch = F.posexplode("tries").alias("tree", "path")
    sorted_tries = stored(nodes.select("node", branch).select(F.char("tree").cast("binary").alias("tree"), "path", "node").repartitionByRange(
        "tree", "path", "node").sortWithinPartitions("tree", "path"))
    levels, found, before, depth = [], {}, None, LONGEST
    while True:
        level = _level(rows, text, nodes, sorted_tries, depth, before, threshold, shingle)
        if level:
            levels.append(level)
            # at most STEPS rows
            for step, n in level.where("node IS NULL").groupBy("step").agg(F.sum("links")).collect():
                found[step / STEPS] = found.get(step / STEPS, 0) + n
        enough = next((d for d in range(depth, 0, -1) if reached_recall(found, d, threshold, trees) >= recall), 1)
        if enough == depth:
            break
        before, depth = depth, enough
    none = docs.sparkSession.createDataFrame([], LINKS)
    links = reduce(DataFrame.unionByName, levels, none).where("node IS NOT NULL")
    joined = connected_labels(links.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v"))).select(
        "node", F.col("label").alias("class"))
    totals = links.groupBy("node").agg(F.sum("links").alias("links"))
    known = stored(nodes.select("node", "n_docs", "first").join(joined, "node", "left").join(totals, "node", "left").select(
        "node", "first", F.coalesce("class", "node").alias("class"), (F.col("n_docs") - 1 + F.coalesce("links", F.lit(0))).alias("n_links")))
    table = known.drop("first").join(known.groupBy("class").agg(F.min("first").alias("first")), "class").select("node", "n_links", "first")
    own = F.when(~F.col("none"), F.col(ROW_KEY[0]))
    return signed.drop("n", "tries").join(table, "node", "left").select(
        *ROW_KEY, own.alias(id),
        F.when(F.col("node").isNull(), own).when(~F.col("first.none"), F.col(f"first.{ROW_KEY[0]}")).alias("class_id"),
        F.coalesce("n_links", F.lit(0)).cast("bigint").alias("n_links"),
        (F.col("node").isNull() | (F.col("first") == F.struct("none", *ROW_KEY))).alias("keeper"))


def one_of_each(docs: DataFrame, id: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """``docs`` with one row of each class, columns as given; rows without words all stay."""
    judged = similar_classes(docs, id, text, **settings)
    drop = judged.where(~F.col("keeper")).select(*ROW_KEY).distinct()
    kept = keyed(docs, id, text).join(drop, ROW_KEY, "left_anti")
    # of rows repeated as a whole, one stays; a key without words keeps all its rows
    copy = F.row_number().over(W.partitionBy(*ROW_KEY).orderBy(*ROW_KEY))
    worded = F.coalesce(F.col(text), F.lit("")).rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]")
    return kept.withColumn("__copy", copy).where((F.col("__copy") == 1) | ~worded).select(*docs.columns)
