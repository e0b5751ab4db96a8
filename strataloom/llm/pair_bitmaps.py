"""Alignment of two tokenizers: inverted bitmaps of the documents that hold each linked pair of tokens."""

from __future__ import annotations

import hashlib
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F, types as T

from .common import stored

#: Text one chunk of documents holds before its bitmaps are written, and text tokenised in one go.
CHUNK_BYTES, SLAB_BYTES = 16 << 20, 1 << 20
#: Documents of a chunk; a document's number in it takes two bytes.
CHUNK_DOCS = 1 << 16
OWN = "__own"
RESULTS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups", "groups_sha256"]


class _Side:
    """What the ids of one tokenizer stand for: their bytes, and their decimal texts with a separator."""

    def __init__(self, pieces: list[bytes], inner: str, last: str):
        self.pieces = pieces
        self.lengths = np.array([len(p) for p in pieces], np.int64)
        width = len(str(len(pieces))) + 1
        text = lambda end: np.array([f"{i}{end}".encode() for i in range(len(pieces))], f"S{width}")
        self.inner, self.last = text(inner), text(last)
        self.digits = np.array([len(str(i)) + 1 for i in range(len(pieces))], np.int64)


class Tokenizers:
    """A byte-level tokenizer file (A) and a sentence-piece model (B)."""

    def __init__(self, a_path: str, b_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        import sentencepiece
        import tokenizers

        self.a = tokenizers.Tokenizer.from_file(a_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        self.b = sentencepiece.SentencePieceProcessor(model_file=b_path)
        # fixed values of the byte-level alphabet: printable bytes stand for themselves, the others follow from U+0100
        plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
        byte_of = {chr(b): b for b in plain}
        byte_of |= {chr(0x100 + k): b for k, b in enumerate(b for b in range(256) if b not in plain)}
        names = [self.a.id_to_token(i) or "" for i in range(self.a.get_vocab_size(with_added_tokens=True))]
        a = [bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode() for name in names]
        b = [bytes([int(self.b.id_to_piece(i)[3:5], 16)]) if self.b.is_byte(i) else self.b.id_to_piece(i).replace("▁", " ").encode()
             for i in range(self.b.get_piece_size())]
        self.side_a, self.side_b = _Side(a, ",", "|"), _Side(b, ",", ";")

    def encode(self, texts: list[str | None]) -> list[tuple[list[int], list[int]]]:
        """Ids of every text on both sides; none where a text is empty or a side does not give its bytes back."""
        some = [k for k, t in enumerate(texts) if t]
        a = self.a.encode_batch_fast([" " + texts[k] for k in some], add_special_tokens=False)
        b = self.b.encode([texts[k] for k in some], num_threads=1)
        out: list[tuple[list[int], list[int]]] = [([], [])] * len(texts)
        for k, x, y in zip(some, a, b, strict=True):
            raw, x = (" " + texts[k]).encode(), x.ids
            if (b"".join(map(self.side_a.pieces.__getitem__, x)) == raw
                    and b"".join(map(self.side_b.pieces.__getitem__, y)) == raw):
                out[k] = (x, y)
        return out


def _align(tok: Tokenizers, texts: list[str | None], with_groups: bool):
    """Per text (n_a, n_b, n_groups, n_links, groups, digest), and all links as (text number, A id, B id)."""
    ids = tok.encode(texts)
    n_a, n_b = (np.array([len(p[side]) for p in ids], np.int64) for side in (0, 1))
    a, b = (np.fromiter((i for p in ids for i in p[side]), np.int64, int(n.sum())) for side, n in ((0, n_a), (1, n_b)))
    end_a, end_b = np.cumsum(tok.side_a.lengths[a]), np.cumsum(tok.side_b.lengths[b])
    begin_a, begin_b = np.append(0, end_a[:-1])[:len(a)], np.append(0, end_b[:-1])[:len(b)]
    # both sides cover the same bytes, so a group ends where an end of one is an end of the other
    last_a = end_b[np.minimum(np.searchsorted(end_b, end_a), max(len(b) - 1, 0))] == end_a if len(a) else np.empty(0, bool)
    last_b = end_a[np.minimum(np.searchsorted(end_a, end_b), max(len(a) - 1, 0))] == end_b if len(b) else np.empty(0, bool)
    doc_a = np.repeat(np.arange(len(texts)), n_a)
    n_groups = np.bincount(doc_a[last_a], minlength=len(texts))
    low = np.searchsorted(end_b, begin_a, "right")
    met = np.searchsorted(begin_b, end_a, "left") - low
    left = np.repeat(np.arange(len(a)), met)
    right = np.arange(met.sum()) - np.repeat(np.cumsum(met) - met, met) + np.repeat(low, met)
    n_links = np.bincount(doc_a[left], minlength=len(texts))
    # where each token is written: A tokens of its group and all before, B tokens of the groups before, or the like
    group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
    through_a, through_b = np.append(0, np.flatnonzero(last_a) + 1), np.append(0, np.flatnonzero(last_b) + 1)
    written = np.zeros(len(a) + len(b), tok.side_a.inner.dtype if tok.side_a.inner.dtype.itemsize >= tok.side_b.inner.dtype.itemsize else tok.side_b.inner.dtype)
    written[np.arange(len(a)) + through_b[group_a]] = np.where(last_a, tok.side_a.last[a], tok.side_a.inner[a])
    written[np.arange(len(b)) + through_a[group_b + 1]] = np.where(last_b, tok.side_b.last[b], tok.side_b.inner[b])
    line = written.tobytes().translate(None, b"\0")
    ends = np.cumsum([*np.bincount(doc_a, tok.side_a.digits[a], len(texts)) + np.bincount(np.repeat(np.arange(len(texts)), n_b), tok.side_b.digits[b], len(texts))]).astype(np.int64)
    listed = [line[x:max(y - 1, x)] for x, y in zip([0, *ends[:-1].tolist()], ends.tolist())]
    digests = [hashlib.sha256(x).hexdigest() if x else "" for x in listed]
    groups = [x.decode() for x in listed] if with_groups else [None] * len(texts)
    return (n_a, n_b, n_groups, n_links, groups, digests), (doc_a[left], a[left], b[right])


def pack(links: np.ndarray, docs: int):
    """Sorted (pair, document, document ...) links of a chunk as one bitmap a pair.

    ``links`` are pair * 65536 + document number. Returns pairs, bitmaps (a sorted list of two-byte
    numbers, or ``docs`` bits where that is shorter), whether it is bits, and planes: the binary digits
    of each member's links less one, one plane a digit, a bit for each member in order.
    """
    at = np.flatnonzero(np.append(True, links[1:] != links[:-1])) if len(links) else np.empty(0, np.int64)
    times = np.diff(np.append(at, len(links))) - 1
    member = links[at]
    pair, number = member >> 16, (member & 0xFFFF).astype("<u2")
    first = np.flatnonzero(np.append(True, pair[1:] != pair[:-1])) if len(pair) else np.empty(0, np.int64)
    n = np.diff(np.append(first, len(pair)))
    dense = n * 16 > docs
    bits = -(-docs // 8)
    sizes = np.where(dense, bits, 2 * n)
    offsets = np.append(0, np.cumsum(sizes))
    data = np.zeros(int(offsets[-1]), np.uint8)
    of = np.repeat(np.arange(len(first)), n)
    inside = np.arange(len(pair)) - np.repeat(first, n)
    thin = ~dense[of]
    to = offsets[of[thin]] + 2 * inside[thin]
    data[to], data[to + 1] = number[thin] & 255, number[thin] >> 8
    full, where = number[~thin].astype(np.int64), offsets[of[~thin]]
    np.bitwise_or.at(data, where + (full >> 3), (1 << (full & 7)).astype(np.uint8))
    # planes
    most = np.maximum.reduceat(times, first) if len(first) else times
    planes = np.ceil(np.log2(most + 1)).astype(np.int64)
    row = -(-n // 8)
    starts = np.append(0, np.cumsum(planes * row))
    held = np.zeros(int(starts[-1]) * 8, bool)
    for p in range(int(planes.max(initial=0))):
        on = ((times >> p) & 1).astype(bool)
        held[8 * (starts[of[on]] + p * row[of[on]]) + inside[on]] = True
    as_binary = lambda ends, body: pa.Array.from_buffers(pa.large_binary(), len(first), [None, pa.py_buffer(ends.astype(np.int64)), pa.py_buffer(body)]).cast(pa.binary())
    return pair[first], n, as_binary(offsets, data), dense, as_binary(starts, np.packbits(held, bitorder="little"))


def unpack(n: np.ndarray, dense: np.ndarray, bitmaps: list[np.ndarray], planes: list[np.ndarray]):
    """(row, document number, links) of every member of the bitmaps; the reverse of ``pack``."""
    (data, offsets), (body, starts) = bitmaps, planes
    of = np.repeat(np.arange(len(n)), n)
    inside = np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    number = np.empty(len(of), np.int64)
    thin = ~dense[of]
    at = offsets[of[thin]] + 2 * inside[thin]
    number[thin] = data[at].astype(np.int64) | data[at + 1].astype(np.int64) << 8
    rows = np.flatnonzero(dense)
    number[~thin] = np.concatenate([np.empty(0, np.int64), *[np.flatnonzero(np.unpackbits(data[offsets[k]:offsets[k + 1]], bitorder="little")) for k in rows.tolist()]])
    row = -(-n // 8)
    count = np.where(row > 0, np.diff(starts) // np.maximum(row, 1), 0)
    held = np.unpackbits(body, bitorder="little")
    times = np.ones(len(of), np.int64)
    for p in range(int(count.max(initial=0))):
        deep = count[of] > p
        times[deep] += held[8 * (starts[of[deep]] + p * row[of[deep]]) + inside[deep]].astype(np.int64) << p
    return of, number, times


def _binary(array: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    array = array.combine_chunks().cast(pa.large_binary())
    if not len(array):
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    at = np.frombuffer(array.buffers()[1], np.int64)[array.offset:array.offset + len(array) + 1]
    body = np.frombuffer(array.buffers()[2], np.uint8) if array.buffers()[2] is not None and array.buffers()[2].size else np.empty(0, np.uint8)
    return body[at[0]:at[-1]], at - at[0]


POSTING = "a int, b int, n int, bitmap binary, dense boolean, planes binary"
DOCUMENT = "number int, n_a bigint, n_b bigint, n_groups bigint, n_links bigint, groups string, groups_sha256 string"


def postings(docs: DataFrame, text: str, a_path: str, b_path: str, groups: bool = False,
             chunk_bytes: int = CHUNK_BYTES, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """One pass over the texts: a row for each document, and one for each pair of a chunk of documents.

    A chunk is some neighbouring documents of one task. The bitmaps of its slabs are OR-ed into one
    a pair before it is written, so no two rows hold the same pair and document.
    """
    schema = T.StructType().add("chunk", "long").add(OWN, docs.schema[OWN].dataType)
    for part in (DOCUMENT, POSTING):
        for field in docs.sparkSession.createDataFrame([], part).schema:
            schema = schema.add(field)

    def write(chunk, owns, per_doc, links):
        n = len(owns)
        values = {"chunk": pa.array([chunk] * n, pa.int64()), OWN: pa.concat_arrays(owns), "number": pa.array(range(n), pa.int32())}
        per = [sum((list(x[k]) for x in per_doc), []) for k in range(6)]
        for name, column in zip(("n_a", "n_b", "n_groups", "n_links"), per):
            values[name] = pa.array(column, pa.int64())
        values["groups"], values["groups_sha256"] = pa.array(per[4], pa.string()), pa.array(per[5], pa.string())
        yield values, n
        # the OR of the slabs' bitmaps: their sorted members, put together
        key, size, bitmap, dense, planes = pack(np.sort(np.concatenate([np.empty(0, np.int64), *links])), n)
        for k in range(0, len(key), 65536):
            some = slice(k, k + 65536)
            m = len(key[some])
            yield {"chunk": pa.array(np.full(m, chunk), pa.int64()), "a": pa.array((key[some] >> 24).astype(np.int32)), "b": pa.array((key[some] & 0xFFFFFF).astype(np.int32)),
                   "n": pa.array(size[some].astype(np.int32)), "bitmap": bitmap[k:k + m], "dense": pa.array(dense[some]), "planes": planes[k:k + m]}, m

    def run(batches):
        tok, part, k = Tokenizers(a_path, b_path), TaskContext.get().partitionId(), 0
        owns, per_doc, links, held = [], [], [], 0
        types = None

        def full(values, n):
            return pa.RecordBatch.from_arrays([values.get(f.name, pa.nulls(n, f.type)) for f in types], schema=types)

        for batch in batches:
            if types is None:
                from pyspark.sql.pandas.types import to_arrow_schema
                types = to_arrow_schema(schema)
                types = types.set(types.get_field_index(OWN), pa.field(OWN, batch.schema.field(1).type))
            values, mine, row = batch.column(0).to_pylist(), batch.column(1), 0
            while row < len(values):
                slab, size = row, 0
                while row < len(values) and (row == slab or size < slab_bytes) and len(owns) + row - slab < CHUNK_DOCS:
                    size += len(values[row] or "")
                    row += 1
                found, (doc, a, b) = _align(tok, values[slab:row], groups)
                links.append((a << 24 | b) << 16 | doc + len(owns))
                owns += [mine[i:i + 1] for i in range(slab, row)]
                per_doc.append(found)
                held += size
                if held >= chunk_bytes or len(owns) >= CHUNK_DOCS:
                    for x in write(part << 32 | k, owns, per_doc, links):
                        yield full(*x)
                    owns, per_doc, links, held, k = [], [], [], 0, k + 1
        if owns:
            for x in write(part << 32 | k, owns, per_doc, links):
                yield full(*x)

    return docs.select(text, OWN).mapInArrow(run, schema)


def align(docs: DataFrame, a_path: str, b_path: str, text: str = "text", groups: bool = False,
          chunk_bytes: int = CHUNK_BYTES, slab_bytes: int = SLAB_BYTES) -> DataFrame:
    """``docs`` without ``text``, with the alignment of its tokens by two tokenizers.

    ``n_a`` and ``n_b`` are tokens, ``n_groups`` the groups cut where both tokens end, ``n_links`` the
    pairs of overlapping tokens, ``groups_sha256`` the digest of the groups (``groups`` adds their
    text, which is several times as long as the document). A pair's count is the number of rows that
    hold it linked; ``count_sum`` sums it over the links of a row, ``n_best`` counts the links whose
    count no other pair of the same A id exceeds.

    NULL and empty texts, and those that a tokenizer does not give back byte by byte, have no tokens:
    zeros and an empty digest. Every row is a document of its own, repeated ones too. Columns of these
    names are replaced. A task holds one chunk of documents and their links, at least a whole text.
    """
    keep = [c for c in docs.columns if c != text and c not in RESULTS]
    rows = docs.select(text, F.struct(F.lit(True).alias("there"), *keep).alias(OWN))
    table = stored(postings(rows, text, a_path, b_path, groups, chunk_bytes, slab_bytes))
    documents, pairs = table.where(F.col("number").isNotNull()), table.where(F.col("a").isNotNull()).select("chunk", "a", "b", "n", "bitmap", "dense", "planes")
    # chunks share no document, so the population of a pair's bitmap is the sum over its chunks
    counts = pairs.groupBy("a", "b").agg(F.sum("n").alias("count"))
    tops = counts.groupBy("a").agg(F.max("count").alias("top"))
    counts = stored(counts.join(tops, "a").select("a", "b", "count", (F.col("count") == F.col("top")).alias("best")))

    def score(t: pa.Table) -> pa.Table:
        t = t.combine_chunks()
        n, dense, count, best = (np.asarray(t.column(c)) for c in ("n", "dense", "count", "best"))
        of, number, times = unpack(n.astype(np.int64), dense, _binary(t.column("bitmap")), _binary(t.column("planes")))
        size = int(number.max(initial=-1)) + 1
        sums, bests = np.zeros(size, np.int64), np.zeros(size, np.int64)
        np.add.at(sums, number, times * count[of])
        np.add.at(bests, number, times * best[of])
        return pa.table({"chunk": pa.array(np.full(size, t.column("chunk")[0].as_py()), pa.int64()), "number": pa.array(np.arange(size), pa.int32()),
                         "n_best": pa.array(bests), "count_sum": pa.array(sums)})

    scores = pairs.join(counts, ["a", "b"]).groupBy("chunk").applyInArrow(score, "chunk bigint, number int, n_best bigint, count_sum bigint")
    whole = documents.join(scores, ["chunk", "number"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0).cast("bigint")).alias(c)
    return whole.select(*[F.col(OWN)[c].alias(c) for c in keep], "n_a", "n_b", "n_groups", "n_links", zero("n_best"), zero("count_sum"),
                        *(["groups"] if groups else []), "groups_sha256")
