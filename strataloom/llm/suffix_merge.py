"""Exact repeated-substring removal: shard Burrows-Wheeler transforms, merged by interleave refinement."""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ROW_KEY, keyed, stored

LENGTH = 100
#: Bytes of the grams whose least hash names the group of a window.
GRAM = 32
#: Bytes of distinct segments one merge takes, and one shard of it.
MERGE_BYTES, SHARD_BYTES = 1 << 21, 1 << 19
#: Window starts looked at in one go.
SLAB = 1 << 20
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93], np.uint64)


def _text_bytes(column: pa.ChunkedArray | pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary array in a row, and the offsets of its values; NULL is empty."""
    array = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    array = array.cast(pa.large_binary())
    if not len(array):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    data = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] is not None else np.empty(0, np.uint8)
    return data[at[0]:at[-1]], at - at[0]


def _gram_hashes(data: np.ndarray, gram: int) -> np.ndarray:
    """A 64-bit hash of every ``gram`` bytes (a multiple of 8)."""
    n = len(data) - gram + 1
    words = np.ndarray((len(data),), "<u8", np.concatenate([data, np.zeros(8, np.uint8)]), strides=(1,)).copy()
    h = np.full(n, _ODD[3])
    for j in range(0, gram, 8):
        h ^= h >> np.uint64(29)
        h += words[j:j + n]
        h *= _ODD[j // 8 % 4]
    h ^= h >> np.uint64(32)
    return h


def _sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    step = 1
    while 2 * step <= width:
        h, step = np.minimum(h[:-step], h[step:]), 2 * step
    rest = width - step
    return np.minimum(h[:-rest], h[rest:]) if rest else h


def segments(data: np.ndarray, at: np.ndarray, length: int = LENGTH, gram: int = GRAM):
    """Runs of neighbouring windows of one least gram hash.

    Yields arrays (text number, first start, windows, hash, whether the gram occurs twice in the run).
    Equal windows have equal hashes, wherever they stand, so a window that occurs twice lies in two
    runs of one hash, or in one run that holds its gram twice.
    """
    width = length - gram + 1
    for a in range(0, len(data), SLAB):
        part = data[a:a + SLAB + length - 1]
        n = len(part) - length + 1
        if n <= 0:
            break
        h = _gram_hashes(part, gram)
        least = _sliding_min(h, width)
        inside = np.ones(n, bool)
        for end in at[np.searchsorted(at, a, "right"):np.searchsorted(at, a + n + length) + 1].tolist():
            inside[max(end - a - length + 1, 0):max(min(end - a, n), 0)] = False
        starts = np.flatnonzero(inside)
        if not len(starts):
            continue
        v = least[starts]
        first = np.flatnonzero(np.concatenate([[True], (v[1:] != v[:-1]) | (starts[1:] != starts[:-1] + 1)]))
        windows = np.diff(np.append(first, len(starts)))
        s, v = starts[first], v[first]
        twice = windows > width
        for k in range(0, len(s), 16384):
            some = slice(k, k + 16384)
            reach = s[some, None] + np.arange(2 * width - 1)[None, :]
            held = (h[np.minimum(reach, len(h) - 1)] == v[some, None]) & (reach < (s + windows + width - 1)[some, None])
            twice[some] |= held.sum(1) > 1
        doc = np.searchsorted(at, s + a, "right") - 1
        yield doc, s + a - at[doc], windows, v.view(np.int64), twice


class Shard:
    """The Burrows-Wheeler transform of some segments: for every suffix, in order, the two bytes before it."""

    def __init__(self, data: np.ndarray, at: np.ndarray):
        n, m = len(data), len(at) - 1
        seg = np.repeat(np.arange(m), np.diff(at) + 1)
        text = np.zeros(n + m + 8, np.int16)  # 0 ends a segment, bytes are 1 to 256
        ends = at[1:] + np.arange(m)
        inner = np.ones(n + m, bool)
        inner[ends] = False
        text[:n + m][inner] = data.astype(np.int16) + 1
        key = np.zeros(n + m, np.int64)
        alive = np.ones(n + m, bool)
        for j in range(7):
            key *= 257
            key += text[j:j + n + m] * alive
            alive &= text[j:j + n + m] > 0
        off = np.arange(n + m) - (at[:-1] + np.arange(m))[seg]
        size = np.diff(at)[seg] + 1
        # prefix doubling until every suffix has a place of its own; suffixes that are equal to their end go by segment
        order = np.argsort(key)
        rank, h = self._ranks(key[order], order), 7
        while True:
            tied = np.flatnonzero(np.bincount(rank, minlength=n + m)[rank] > 1)
            if not len(tied):
                break
            follows = np.where(off[tied] + h < size[tied], rank[np.minimum(tied + h, n + m - 1)] + m, seg[tied])
            both = rank[tied] << 32 | follows
            by = np.argsort(both)
            both = both[by]
            r = both >> 32
            group = np.flatnonzero(np.concatenate([[True], r[1:] != r[:-1]]))
            new = np.concatenate([[True], both[1:] != both[:-1]])
            base = np.repeat(group, np.diff(np.append(group, len(r))))
            rank[tied[by]] = r + np.maximum.accumulate(np.where(new, np.arange(len(r)), 0)) - base
            h *= 2
        order = np.empty(n + m, np.int64)
        order[rank] = np.arange(n + m)
        before = np.zeros(n + m, np.uint16)
        byte = np.maximum(text[:n + m] - 1, 0)
        before[2:] = byte[:-2].astype(np.uint16) << 8 | byte[1:-1]
        self.before, self.seg, self.off = before[order], seg[order].astype(np.int32), off[order].astype(np.int32)

    @staticmethod
    def _ranks(keys: np.ndarray, order: np.ndarray) -> np.ndarray:
        new = np.concatenate([[True], keys[1:] != keys[:-1]])
        rank = np.empty(len(keys), np.int64)
        rank[order] = np.maximum.accumulate(np.where(new, np.arange(len(keys)), 0))
        return rank

    def at_depth(self, windows: np.ndarray, left: int) -> np.ndarray:
        """Which suffixes, in order, start ``left`` bytes after the start of a window; ``windows`` by suffix."""
        return (self.off - left).view(np.uint32) < windows


def merge(shards: list[tuple[Shard, np.ndarray]], length: int = LENGTH) -> tuple[np.ndarray, np.ndarray]:
    """Merges the transforms of shards, each with the number of windows of its segments.

    The interleave says which shard each suffix of the merged order comes from. A round reads the
    shards' transforms through it and sorts it stably by the bytes read, which refines the order
    from suffixes of ``d`` bytes to those of ``d + 2``; no suffix is compared again. Only suffixes
    that end a window are followed. Returns the interleave of windows at the full length, and where
    the prefix that a window shares with the one before it is shorter than ``length``.
    """
    z = np.concatenate([np.full(int(w.sum()), k, np.uint8) for k, (_, w) in enumerate(shards)])
    shards = [(shard, w.astype(np.uint32)[shard.seg]) for shard, w in shards]
    new = np.zeros(len(z), bool)
    new[:1] = True
    for left in range(length, 0, -2):
        read = np.empty(len(z), np.uint16)
        for k, (shard, windows) in enumerate(shards):
            read[np.flatnonzero(z == k)] = shard.before[np.flatnonzero(shard.at_depth(windows, left))]
        order = np.argsort(read, kind="stable")
        block = np.cumsum(new, dtype=np.int32).take(order)
        read, z = read.take(order), z.take(order)
        np.not_equal(read[1:], read[:-1], out=new[1:])
        new[1:] |= block[1:] != block[:-1]
    return z, new


def later_windows(contents: np.ndarray, at: np.ndarray, place: np.ndarray, length: int = LENGTH, shard_bytes: int = SHARD_BYTES):
    """(segment, offset) of the windows that occur earlier too; ``place`` ranks the segments, all different."""
    windows = np.diff(at) - length + 1
    cuts = [0]
    shard_bytes = max(shard_bytes, -(-int(at[-1]) // 200))  # an interleave holds a byte a suffix
    while cuts[-1] < len(windows):
        cuts.append(max(int(np.searchsorted(at, at[cuts[-1]] + shard_bytes, "right")) - 1, cuts[-1] + 1))
    shards = [(Shard(contents[at[a]:at[b]], at[a:b + 1] - at[a]), windows[a:b]) for a, b in zip(cuts, cuts[1:])]
    z, new = merge(shards, length)
    seg, off = np.empty(len(z), np.int64), np.empty(len(z), np.int64)
    for k, (shard, w) in enumerate(shards):
        here, held = z == k, shard.at_depth(w.astype(np.uint32)[shard.seg], 0)
        seg[here], off[here] = shard.seg[held] + cuts[k], shard.off[held]
    where = place[seg] << 32 | off
    block = np.flatnonzero(new)
    first = np.repeat(np.minimum.reduceat(where, block), np.diff(np.append(block, len(z)))) if len(z) else where
    late = where > first
    return seg[late], off[late]


def _runs(key: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted (key, start, length) of neighbouring values of one key."""
    order = np.lexsort((at, key))
    key, at = key[order], at[order]
    first = np.flatnonzero(np.concatenate([[True], (key[1:] != key[:-1]) | (at[1:] != at[:-1] + 1)])) if len(key) else np.empty(0, np.int64)
    return key[first], at[first], np.diff(np.append(first, len(key)))


def repeated_spans(docs: DataFrame, text: str, length: int = LENGTH, merge_bytes: int = MERGE_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """(row key, spans): where the windows of keyed ``docs`` start that start earlier too, as (start, windows) in ``__runs``.

    1. Of equal texts the first stands for all; the others repeat it as a whole.
    2. Texts are dealt into runs of windows by their least gram hash (``segments``). Runs whose hash
       occurs once hold no repeat and go.
    3. Equal runs of one hash become one, at its first place. Hashes are dealt into merges of about
       ``merge_bytes``; each builds the transforms of its shards and merges them. A hash of more bytes
       than that is dealt by its windows instead, which are reduced to their first places by key.
    """
    kind = docs.schema[ROW_KEY[0]].dataType.simpleString()
    size = F.octet_length(F.coalesce(F.col(text), F.lit("")))
    ids = stored(docs.where(size >= length).select(*ROW_KEY, size.alias("n"), F.sha2(F.col(text), 256).alias("digest")).distinct())
    heads = ids.groupBy("digest").agg(F.min(F.struct(*ROW_KEY)).alias("head")).select("head.*")
    copies = ids.join(heads, ROW_KEY, "left_anti").select(*ROW_KEY, F.lit(0).cast("bigint").alias("start"), (F.col("n") - length + 1).cast("bigint").alias("windows"))

    def deal(batches):
        for batch in batches:
            data, at = _text_bytes(batch.column(2))
            for doc, s, w, v, twice in segments(data, at, length, GRAM):
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(doc)), batch.column(1).take(pa.array(doc)), pa.array(v), pa.array(s), pa.array(w), pa.array(twice)],
                                                 names=[*ROW_KEY, "v", "start", "windows", "twice"])

    key_schema = f"{ROW_KEY[0]} {kind}, {ROW_KEY[1]} bigint"
    runs = stored(docs.join(heads, ROW_KEY, "left_semi").select(*ROW_KEY, text).mapInArrow(deal, f"{key_schema}, v bigint, start bigint, windows bigint, twice boolean"))
    often = runs.groupBy("v").agg(F.sum(F.when(F.col("twice"), 2).otherwise(1)).alias("n")).where("n > 1").select("v")
    runs = stored(runs.join(often, "v", "left_semi").select(*ROW_KEY, "v", "start", "windows"))

    def cut(batches):
        for batch in batches:
            data, at = _text_bytes(batch.column(2))
            listed = batch.column(3)
            doc = np.repeat(np.arange(len(batch)), np.asarray(listed.value_lengths()))
            flat = listed.flatten()
            v, s, w = (np.asarray(flat.field(k)) for k in range(3))
            for k in range(0, len(doc), 8192):
                some = slice(k, k + 8192)
                begin = at[doc[some]] + s[some]
                ends = np.cumsum(np.append(0, w[some] + length - 1))
                held = np.arange(ends[-1]) + np.repeat(begin - ends[:-1], np.diff(ends))
                content = pa.Array.from_buffers(pa.large_binary(), len(begin), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(data[held])])
                rows = pa.array(doc[some])
                yield pa.RecordBatch.from_arrays([batch.column(0).take(rows), batch.column(1).take(rows), pa.array(v[some]), pa.array(s[some]), pa.array(w[some]), content.cast(pa.binary())],
                                                 names=[*ROW_KEY, "v", "start", "windows", "content"])

    by_doc = runs.groupBy(*ROW_KEY).agg(F.collect_list(F.struct("v", "start", "windows")).alias("runs"))
    contents = docs.select(*ROW_KEY, text).join(by_doc, ROW_KEY).mapInArrow(cut, f"{key_schema}, v bigint, start bigint, windows bigint, content binary")
    distinct = stored(contents.groupBy("v", "content").agg(F.min(F.struct(*ROW_KEY, "start")).alias("place"), F.first("windows").alias("windows")).select(
        "v", "content", "windows", "place.*"))
    later = runs.join(distinct.select(*ROW_KEY, "start"), [*ROW_KEY, "start"], "left_anti").select(*ROW_KEY, "start", "windows")

    sizes = stored(distinct.groupBy("v").agg(F.sum(F.length("content")).alias("bytes")))
    total = sizes.agg(F.sum("bytes")).first()[0] or 0
    large = sizes.where(F.col("bytes") > merge_bytes).select("v")
    merges = math.ceil(2 * total / merge_bytes) + 1

    def find(table: pa.Table) -> pa.Table:
        table = table.combine_chunks()
        data, at = _text_bytes(table.column("content"))
        names = table.select(ROW_KEY + ["start"]).to_pandas()
        place = names.sort_values(ROW_KEY + ["start"]).index.to_numpy().argsort()
        seg, off = later_windows(data, at, place, length, shard_bytes)
        seg, off, windows = _runs(seg, off)
        rows = pa.array(seg)
        start = names["start"].to_numpy()[seg] + off
        keys = [table.column(c).take(rows) for c in ROW_KEY]
        return pa.table([*keys, pa.array(start, pa.int64()), pa.array(windows, pa.int64())], names=[*ROW_KEY, "start", "windows"])

    found = distinct.join(large, "v", "left_anti").select(
        *ROW_KEY, "start", "content", F.pmod(F.xxhash64("v"), F.lit(merges)).alias("part")).groupBy("part").applyInArrow(find, f"{key_schema}, start bigint, windows bigint")
    alone = distinct.join(large, "v", "left_semi").select(*ROW_KEY, "start", "content", F.explode(F.sequence(F.lit(0), (F.col("windows") - 1).cast("int"))).alias("k")).select(
        *ROW_KEY, (F.col("start") + F.col("k")).alias("start"), F.substring(F.col("content"), F.col("k") + 1, F.lit(length)).alias("window"))
    firsts = alone.groupBy("window").agg(F.min(F.struct(*ROW_KEY, "start")).alias("first"))
    singly = alone.join(firsts, "window").where(F.struct(*ROW_KEY, "start") > F.col("first")).select(*ROW_KEY, "start", F.lit(1).cast("bigint").alias("windows"))
    every = copies.unionByName(later).unionByName(stored(found)).unionByName(singly)
    return every.groupBy(*ROW_KEY).agg(F.array_sort(F.collect_set(F.struct("start", "windows"))).alias("__runs"))


def remove_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", length: int = LENGTH,
                   merge_bytes: int = MERGE_BYTES, shard_bytes: int = SHARD_BYTES) -> DataFrame:
    """``docs`` with ``kept`` (binary, what is left of the UTF-8 text) and ``spans`` (removed byte ranges, end exclusive).

    A byte goes if a string of ``length`` (even, above 32) bytes that covers it also starts earlier: in a
    row that sorts before (by id, NULL ids as 0, then text hash) or further on the left in the same
    row. Strings are judged on the input. NULL texts are empty; rows repeated as a whole count once
    and are cut alike. Columns named ``kept`` and ``spans`` are replaced.
    """
    rows = keyed(docs.drop("kept", "spans"), id, text)
    runs = stored(repeated_spans(rows.select(*ROW_KEY, text), text, length, merge_bytes, shard_bytes))
    own = [c for c in rows.columns if c not in ROW_KEY]

    def cut(batches):
        for batch in batches:
            kept, spans = [], []
            for value, some in zip(batch.column(own.index(text)).cast(pa.binary()), batch.column(len(own))):
                value, gone = value.as_py() or b"", []
                for r in some.as_py() or []:
                    end = r["start"] + r["windows"] + length - 1
                    if gone and r["start"] <= gone[-1]["end"]:
                        gone[-1]["end"] = max(gone[-1]["end"], end)
                    else:
                        gone.append({"start": r["start"], "end": end})
                ends = [0, *[g["end"] for g in gone]]
                kept.append(b"".join(value[a:b] for a, b in zip(ends, [*[g["start"] for g in gone], len(value)])))
                spans.append(gone)
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(kept, pa.binary()), pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                                             names=[*own, "kept", "spans"])

    schema = rows.select(*own, F.lit(b"").alias("kept"), F.lit(None).cast("array<struct<start:bigint,end:bigint>>").alias("spans")).schema
    return rows.join(runs, ROW_KEY, "left").select(*own, "__runs").mapInArrow(cut, schema)
