"""Distance work inside groups: nearest pairs, neighbour graphs and contact agreement.

Rows of a group are laid out in tiles of bounded size along a space-filling order. Tiles carry
bounding boxes; tiles whose boxes come within reach of each other are found by a join on grid
cells, and a meeting of two tiles returns its reduced answer (a minimum, k best, or sums), never
its pairs. Copies of one point are handled once, with what they add.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import checkpointed, setting, shuffle_width
from .scale import row_numbers

TILE_ROWS = 1024
#: Bytes of the rows of tiles that a task hands to Python at once.
BATCH_BYTES = "4m"
_TILE_SCHEMA = ("tile int, n int, ids array<bigint>, data binary, aux binary, low array<double>, high array<double>, "
                "bound double")


def _z_order(vec: Column, cell: float) -> Column:
    """Interleaved bits of the first three coordinates in units of ``cell``."""
    out = F.lit(0).cast("bigint")
    axes = [F.coalesce(F.get(vec, F.lit(a)), F.lit(0.0)) for a in range(3)]
    cells = [(F.floor(F.greatest(F.lit(-128.0), F.least(F.lit(127.0), a / F.lit(cell)))) + 128).cast("bigint")
             for a in axes]
    for bit in range(8):
        for a, c in enumerate(cells):
            out = out.bitwiseOR(F.shiftleft(F.shiftright(c, bit).bitwiseAND(F.lit(1)), 3 * bit + a))
    return out


def _pack(k: int, eps: float):
    """Tile rows to packed arrays, boxes and, for k > 0, the k-th distance every row reaches inside."""
    def pack(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                points = np.stack([np.asarray(r["vec"], dtype=np.float64) for r in row.rows])
                ids = np.array([r["id"] for r in row.rows], dtype=np.int64)
                aux = np.stack([np.asarray(r["aux"], dtype=np.float64) for r in row.rows])
                by_id = np.argsort(ids)
                points, ids, aux = points[by_id], ids[by_id], aux[by_id]
                bound = float("inf")
                if 0 < k <= len(ids):
                    asking = points[aux[:, 0] > 0]
                    bound = float(np.partition(_distances(asking, points, eps), k - 1, axis=1)[:, k - 1].max(initial=0.0))
                out.append((*row[:-1], len(ids), ids, points.tobytes(), aux.tobytes(),
                            points.min(axis=0), points.max(axis=0), bound))
            yield pd.DataFrame(out, columns=[*pdf.columns[:-1], "n", "ids", "data", "aux", "low", "high", "bound"])
    return pack


def make_tiles(
    df: DataFrame, group: Sequence[str], id: str, vec: str, aux: str | None = None,
    tile_rows: int = TILE_ROWS, cell: float = 8.0, k: int = 0, eps: float = 0.0,
) -> DataFrame:
    """One row per tile of at most ``tile_rows`` rows: ids, packed vectors, bounding box.

    Tiles follow a Z-order of the leading coordinates, numbered by a distributed scan, so a
    group of any size is cut evenly. The tiles are written once.
    """
    rows = df.select(
        *group, F.col(id).cast("bigint").alias("id"), F.col(vec).cast("array<double>").alias("vec"),
        (F.col(aux).cast("array<double>") if aux else F.array().cast("array<double>")).alias("aux"))
    rows = rows.withColumn("__z", _z_order(F.col("vec"), cell))
    numbered = row_numbers(rows, ["__z", "id"], "__at", group)
    # tiles of equal size, none above tile_rows
    size = numbered.groupBy(*group).agg(F.count("*").alias("__n"))
    tiles = F.ceil(F.col("__n") / tile_rows)
    packed = numbered.join(size, list(group)).groupBy(
        *group, F.floor((F.col("__at") - 1) * tiles / F.col("__n")).cast("int").alias("tile")).agg(
        F.collect_list(F.struct("id", "vec", "aux")).alias("rows"))  # at most tile_rows entries
    types = [f"{g} {df.schema[g].dataType.simpleString()}" for g in group]
    # a tile is one row: by rows alone, all tiles of a task would reach Python at once
    with setting(df.sparkSession, "spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES):
        return checkpointed(packed.mapInPandas(_pack(k, eps), ", ".join([*types, _TILE_SCHEMA])))


def box_distance(a_low: Column, a_high: Column, b_low: Column, b_high: Column) -> Column:
    """Least distance between two axis-aligned boxes."""
    gaps = F.zip_with(
        F.zip_with(a_low, b_high, lambda x, y: x - y), F.zip_with(b_low, a_high, lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.sqrt(F.aggregate(gaps, F.lit(0.0), lambda acc, g: acc + g * g))


def _cells(low: Column, high: Column, width: Column) -> Column:
    """Grid cells of the leading three axes that a box touches."""
    def axis(i: int) -> Column:
        at = lambda c: F.floor(F.coalesce(F.get(c, F.lit(i)), F.lit(0.0)) / width).cast("bigint")
        return F.sequence(at(low), at(high))
    return F.flatten(F.transform(axis(0), lambda x: F.flatten(F.transform(axis(1), lambda y: F.transform(
        axis(2), lambda z: F.struct(x.alias("x"), y.alias("y"), z.alias("z")))))))


MAX_LEVEL = 24


def close_tiles(a: DataFrame, b: DataFrame, group: Sequence[str]) -> DataFrame:
    """(a columns, b columns) of the tile pairs of a group whose boxes are within ``a_reach``.

    ``a``: group, ta, a_low, a_high, a_reach and more; ``b``: group, tb, b_low, b_high and more.
    Boxes are entered into grids whose cell width doubles from level to level, each box from the
    level on where it spans two cells per axis at most; a pair meets at the higher level of the
    two. So a group of any number of tiles is joined by place, and only boxes in reach of each
    other come together. Leading axes alone decide the cells, the full boxes the distance.
    """
    infinite = F.col("a_reach") == F.lit(float("inf"))  # a group that is one short tile
    reach = F.when(infinite, F.lit(0.0)).otherwise(F.col("a_reach"))
    grown = a.withColumn("__lo", F.transform("a_low", lambda x: x - reach)).withColumn("__hi", F.transform("a_high", lambda x: x + reach))
    plain = b.withColumn("__lo", F.col("b_low")).withColumn("__hi", F.col("b_high"))
    span = F.array_max(F.zip_with(F.slice("__hi", 1, 3), F.slice("__lo", 1, 3), lambda h, l: h - l))
    grown, plain = grown.withColumn("__span", span), plain.withColumn("__span", span)
    unit = grown.groupBy(*group).agg(F.greatest(F.avg("__span"), F.lit(1e-6)).alias("__unit"))

    def entered(df: DataFrame, top: DataFrame) -> DataFrame:
        wide = df.join(top, list(group)).withColumn("__level", level).withColumn(
            "__m", F.explode(F.sequence(F.col("__level"), F.greatest("__level", "__top"))))
        width = F.col("__unit") * F.pow(F.lit(2.0), F.col("__m"))
        return wide.withColumn("__cell", F.explode(_cells(F.col("__lo"), F.col("__hi"), width)))

    level = F.greatest(F.lit(0), F.least(F.lit(MAX_LEVEL), F.ceil(F.log2(F.greatest(F.col("__span"), F.lit(1e-9)) / F.col("__unit"))))).cast("int")
    spans = grown.select(*group, "__span").unionByName(plain.select(*group, "__span"))
    top = spans.join(unit, list(group)).groupBy(*group, "__unit").agg(F.max(level).alias("__top"))
    drop = ("__lo", "__hi", "__span", "__unit", "__top")
    left = entered(grown, top).drop(*drop).withColumnRenamed("__level", "__la")
    right = entered(plain, top).drop(*drop).withColumnRenamed("__level", "__lb")
    met = left.join(right, [*group, "__m", "__cell"]).where(F.col("__m") == F.greatest("__la", "__lb"))
    near = box_distance(F.col("a_low"), F.col("a_high"), F.col("b_low"), F.col("b_high"))
    return met.where(near <= F.col("a_reach")).drop("__m", "__cell", "__la", "__lb").dropDuplicates(
        [*group, *[c for c in a.columns if c not in (*group, "a_low", "a_high", "a_reach")],
         *[c for c in b.columns if c not in (*group, "b_low", "b_high")]])


def _points(row_bytes, n):
    return np.frombuffer(row_bytes, dtype=np.float64).reshape(n, -1)


def _distances(a: np.ndarray, b: np.ndarray, eps: float = 0.0) -> np.ndarray:
    """Euclidean distances from coordinate differences, without the cancelling dot-product form."""
    total = np.zeros((len(a), len(b)))
    for axis in range(a.shape[1]):
        total += np.subtract.outer(a[:, axis], b[:, axis]) ** 2
    return np.sqrt(total + eps)


def _screened(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, float]:
    """(squared distances by one matrix product, how far off any of them can be): they only tell what to compute exactly."""
    x, y = np.einsum("ij,ij->i", a, a), np.einsum("ij,ij->i", b, b)
    rough = a @ b.T
    rough *= -2.0
    rough += x[:, None]
    rough += y[None, :]
    return rough, 4.0 * (a.shape[1] + 4) * np.finfo(np.float64).eps * float(x.max(initial=0.0) + y.max(initial=0.0))


def _exact(a: np.ndarray, b: np.ndarray, eps: float = 0.0) -> np.ndarray:
    """Distances row by row, the same numbers as ``_distances`` has."""
    total = np.zeros(len(a))
    for axis in range(a.shape[1]):
        total += (a[:, axis] - b[:, axis]) ** 2
    return np.sqrt(total + eps)


def _best_k(a: np.ndarray, b: np.ndarray, ids: np.ndarray, k: int, eps: float):
    """Row number, distance and id of the k least (distance, id) per row of ``a``; ``ids`` ascend."""
    k = min(k, len(b))
    rough, off = _screened(a, b)
    limit = np.partition(rough, k - 1, axis=1)[:, k - 1]
    if np.isfinite(limit).all() and np.isfinite(off):
        r, c = np.nonzero(rough <= limit[:, None] + 2 * off)
        dist = _exact(a[r], b[c], eps)
    else:  # coordinates that are not finite or overflow when squared
        whole = _distances(a, b, eps)
        r, c = np.nonzero(whole <= np.partition(whole, k - 1, axis=1)[:, k - 1][:, None])
        dist = whole[r, c]
    order = np.lexsort((c, dist, r))
    r, c, dist = r[order], c[order], dist[order]
    place = np.arange(len(r)) - np.searchsorted(r, r)
    keep = place < k
    return r[keep], dist[keep], ids[c[keep]]


def _least(a: np.ndarray, b: np.ndarray) -> tuple[float, int, int]:
    """(distance, i, j) of the nearest pair, the least (i, j) of equal ones."""
    rough, off = _screened(a, b)
    low = rough.min()
    if not (np.isfinite(low) and np.isfinite(off)):
        whole = _distances(a, b)
        i, j = divmod(int(np.argmin(whole)), len(b))
        return float(whole[i, j]), i, j
    r, c = np.nonzero(rough <= low + 2 * off)  # row by row, so the first minimum has the least (i, j)
    dist = _exact(a[r], b[c])
    at = int(np.argmin(dist))
    return float(dist[at]), int(r[at]), int(c[at])


#: Tile pairs of one task.
TASK_PAIRS = 32


def _spread(close: DataFrame) -> tuple[DataFrame, int]:
    """(the tile pairs, written once, tasks to deal them over): a pair is small in bytes and long in work."""
    pairs = checkpointed(close)
    return pairs, max(shuffle_width(close.sparkSession), -(-pairs.count() // TASK_PAIRS))


def _tile_neighbours(group: Sequence[str], k: int, eps: float):
    width = len(group)

    def search(batches):
        for pdf in batches:
            parts = []
            for row in pdf.itertuples(index=False):
                asking = _points(row.a_aux, row.a_n)[:, 0] > 0
                a, b = _points(row.a_data, row.a_n)[asking], _points(row.b_data, row.b_n)
                r, d, j = _best_k(a, b, np.asarray(row.b_ids), k, eps)
                part = pd.DataFrame({"i": np.asarray(row.a_ids)[asking][r], "j": j, "dist": d})
                for g, value in zip(group, row[:width]):
                    part[g] = value
                parts.append(part)
            if parts:
                yield pd.concat(parts)[[*group, "i", "j", "dist"]]
    return search


def _side(tiles: DataFrame, keys: Sequence[str], s: str) -> DataFrame:
    return tiles.select(*keys, F.col("tile").alias(f"t{s}"), *[F.col(c).alias(f"{s}_{c}") for c in ("n", "ids", "data", "aux")])


def _boxes(tiles: DataFrame, keys: Sequence[str], s: str) -> DataFrame:
    return tiles.select(*keys, F.col("tile").alias(f"t{s}"), F.col("low").alias(f"{s}_low"), F.col("high").alias(f"{s}_high"))


def knn_edges(
    df: DataFrame, group: Sequence[str], id: str, vec: str, k: int, mask: str | None = None,
    eps: float = 1e-6, tile_rows: int = TILE_ROWS, cell: float = 8.0,
) -> DataFrame:
    """(group, i, j, rank, dist): the k nearest rows of each row inside its group, itself included.

    Distance is ``sqrt(sum d^2 + eps)``, ties go to the lower id. Masked rows have no neighbours
    of their own and serve only to fill up lists in groups with fewer than k valid rows, at the
    row's largest valid distance. Copies of a point have the same answer, which is searched once,
    and only the k lowest ids of them can be in any answer. Tiles look at the tiles within the
    k-th distance they already reach on their own, a few around each in space; the result is exact.
    """
    valid = df if mask is None else df.where(F.col(mask))
    points = valid.select(*group, F.col(id).cast("bigint").alias("__id"), F.col(vec).cast("array<double>").alias("__vec"))
    copies = W.partitionBy(*group, "__vec").orderBy("__id")
    chosen = points.withColumn("__copy", F.row_number().over(copies)).where(F.col("__copy") <= k)
    asked = chosen.withColumn("__ask", F.array((F.col("__copy") == 1).cast("double")))
    tiles = make_tiles(asked, group, "__id", "__vec", aux="__ask", tile_rows=tile_rows, cell=cell, k=k, eps=eps)
    close = close_tiles(_boxes(tiles, group, "a").join(
        tiles.select(*group, F.col("tile").alias("ta"), F.col("bound").alias("a_reach")), [*group, "ta"]),
        _boxes(tiles, group, "b"), group).select(*group, "ta", "tb")
    close, tasks = _spread(close)
    met = close.join(_side(tiles, group, "a"), [*group, "ta"]).join(_side(tiles, group, "b"), [*group, "tb"]).repartition(tasks, *group, "ta", "tb").select(
        *group, "a_n", "a_ids", "a_data", "a_aux", "b_n", "b_ids", "b_data")
    types = ", ".join(f"{g} {df.schema[g].dataType.simpleString()}" for g in group)
    found = met.mapInPandas(_tile_neighbours(group, k, eps), f"{types}, i bigint, j bigint, dist double")
    w = W.partitionBy(*group, "i").orderBy("dist", "j")
    first = found.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
    # hand the answer of the lowest copy to every copy
    lowest = points.groupBy(*group, "__vec").agg(F.min("__id").alias("__first"), F.count("*").alias("__n")).where("__n > 1").drop("__n")
    others = points.join(lowest, [*group, "__vec"]).where("__id <> __first").select(*group, F.col("__first").alias("i"), F.col("__id").alias("__copy"))
    edges = first.unionByName(first.join(others, [*group, "i"]).withColumn("i", F.col("__copy")).drop("__copy"))
    if mask is not None:
        size = valid.groupBy(*group).agg(F.count("*").alias("__n")).where(F.col("__n") < k)
        spare = df.where(~F.col(mask)).select(*group, F.col(id).cast("bigint").alias("j"))
        spare = spare.join(size, list(group)).withColumn(
            "__at", F.row_number().over(W.partitionBy(*group).orderBy("j"))).where(F.col("__at") <= k)
        last = edges.groupBy(*group, "i").agg(F.max("dist").alias("dist"))
        fill = last.join(spare, list(group)).where(F.col("__n") + F.col("__at") <= k).select(
            *group, "i", "j", "dist", (F.col("__n") + F.col("__at")).cast("int").alias("rank"))
        edges = edges.select(*group, "i", "j", "dist", "rank").unionByName(fill)
    return edges.select(*group, "i", "j", F.col("rank").cast("bigint").alias("rank"), "dist")


def _tile_minimum(group: Sequence[str]):
    width = len(group) + 1

    def search(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                d, i, j = _least(_points(row.a_data, row.a_n), _points(row.b_data, row.b_n))  # ids ascend
                out.append((*row[:width], d, int(row.a_ids[i]), int(row.b_ids[j])))
            yield pd.DataFrame(out, columns=[*pdf.columns[:width], "distance", "target_index", "context_index"])
    return search


def nearest_pairs(
    points: DataFrame, entry: Sequence[str], chain: str, idx: str, vec: str, targets: DataFrame,
    tile_rows: int = TILE_ROWS, cell: float = 8.0,
) -> DataFrame:
    """(entry, chain, distance, target_index, context_index) of the nearest pair between each
    context chain and its entry's target chain, ties by (target index, context index).

    ``targets`` holds (entry, chain). Chains or targets without points have no row, which the
    caller reads as infinite distance. Each tile pair gives one candidate; tile pairs that
    cannot beat the distance between two known points of the chains are skipped.
    """
    once = points.where(F.col(vec).isNotNull()).groupBy(*entry, chain, vec).agg(F.min(idx).alias(idx))
    tiles = make_tiles(once, [*entry, chain], idx, vec, tile_rows=tile_rows, cell=cell)
    mine = checkpointed(tiles.join(targets.select(*entry, F.col(chain).alias("__target")), list(entry)))
    target = mine.where(F.col(chain) == F.col("__target"))
    context = mine.where(F.col(chain) != F.col("__target"))
    # No context chain is farther than this: the far corners of its first tile and the target's first.
    firsts = context.where("tile = 0").select(*entry, chain, F.col("low").alias("bl"), F.col("high").alias("bh")).join(
        target.where("tile = 0").select(*entry, F.col("low").alias("al"), F.col("high").alias("ah")), list(entry))
    corner = F.zip_with(
        F.zip_with(F.col("ah"), F.col("bl"), lambda x, y: F.abs(x - y)),
        F.zip_with(F.col("bh"), F.col("al"), lambda x, y: F.abs(x - y)), lambda x, y: F.greatest(x, y))
    reach = firsts.select(*entry, chain, F.sqrt(F.aggregate(corner, F.lit(0.0), lambda acc, g: acc + g * g)).alias("a_reach"))
    asking = _boxes(context, [*entry, chain], "a").join(reach, [*entry, chain])
    close = close_tiles(asking, _boxes(target, entry, "b"), entry).select(*entry, chain, "ta", "tb")
    close, tasks = _spread(close)
    met = close.join(_side(context, [*entry, chain], "a").select(*entry, chain, "ta", F.col("a_n").alias("b_n"), F.col("a_ids").alias("b_ids"), F.col("a_data").alias("b_data")), [*entry, chain, "ta"]).join(
        _side(target, entry, "b").select(*entry, "tb", F.col("b_n").alias("a_n"), F.col("b_ids").alias("a_ids"), F.col("b_data").alias("a_data")), [*entry, "tb"]).repartition(tasks, *entry, chain, "ta", "tb").select(
        *entry, chain, "a_n", "a_ids", "a_data", "b_n", "b_ids", "b_data")
    types = ", ".join(f"{g} {points.schema[g].dataType.simpleString()}" for g in [*entry, chain])
    found = met.mapInPandas(
        _tile_minimum(entry), f"{types}, distance double, target_index bigint, context_index bigint")
    first = F.struct("distance", "target_index", "context_index")
    return found.groupBy(*entry, chain).agg(F.min(first).alias("m")).select(*entry, chain, "m.*")


def _tile_contacts(group: Sequence[str], radius: float, bins: Sequence[float]):
    width = len(group)

    def search(batches):
        for pdf in batches:
            out = []
            for row in pdf.itertuples(index=False):
                a, b = _points(row.a_aux, row.a_n), _points(row.b_aux, row.b_n)
                native = _distances(_points(row.a_data, row.a_n), _points(row.b_data, row.b_n))
                model = _distances(a[:, :-1], b[:, :-1])
                near = native <= radius
                off = np.abs(native - model)
                # sums of whole weights: a matrix of marks between two vectors, not a weighted matrix a bin
                total = lambda marks: float(a[:, -1] @ (marks.astype(np.float64) @ b[:, -1]))
                kept = sum(total(near & (off <= t)) for t in bins) / len(bins)
                out.append((*row[:width], row.times * total(near), row.times * kept))
            yield pd.DataFrame(out, columns=[*pdf.columns[:width], "contacts", "kept"])
    return search


def contact_agreement(
    df: DataFrame, record: Sequence[str], idx: str, native: str, model: str,
    radius: float = 15.0, bins: Sequence[float] = (0.5, 1.0, 2.0, 4.0), tile_rows: int = TILE_ROWS,
) -> DataFrame:
    """(record, contacts, lddt): share of native contacts within ``radius`` whose distance the
    model keeps, averaged over the tolerance ``bins``; no superposition involved.

    Positions with equal native and model points are one weighted point. Tile pairs farther apart
    than the radius never meet, the rest return two sums; a position's contact with itself, which
    is always kept, is taken off at the end.
    """
    weighted = df.groupBy(*record, native, model).agg(F.min(idx).alias(idx), F.count("*").alias("__w")).withColumn(
        "__aux", F.concat(F.col(model).cast("array<double>"), F.array(F.col("__w").cast("double"))))
    tiles = make_tiles(weighted, record, idx, native, aux="__aux", tile_rows=tile_rows)
    close = close_tiles(_boxes(tiles, record, "a").withColumn("a_reach", F.lit(float(radius))), _boxes(tiles, record, "b"), record).select(*record, "ta", "tb")
    # contacts are mutual: a pair of two tiles is looked at once and counts twice
    close, tasks = _spread(close.where("ta <= tb").withColumn("times", F.when(F.col("ta") < F.col("tb"), 2).otherwise(1)))
    met = close.join(_side(tiles, record, "a"), [*record, "ta"]).join(_side(tiles, record, "b"), [*record, "tb"]).repartition(
        tasks, *record, "ta", "tb").drop("ta", "tb")
    types = ", ".join(f"{g} {df.schema[g].dataType.simpleString()}" for g in record)
    sums = met.mapInPandas(_tile_contacts(record, radius, bins), f"{types}, contacts double, kept double")
    own = df.groupBy(*record).agg(F.count("*").alias("__own"))
    total = sums.groupBy(*record).agg(F.sum("contacts").alias("__c"), F.sum("kept").alias("__k")).join(own, list(record))
    contacts = (F.col("__c") - F.col("__own")).cast("bigint")
    return total.select(*record, contacts.alias("contacts"), F.when(contacts > 0, (F.col("__k") - F.col("__own")) / contacts).alias("lddt"))
