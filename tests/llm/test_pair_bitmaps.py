"""Tokenizer alignment against a plain loop over tokens and links."""

import hashlib
import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pytest

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import AWKWARD, documents, prose

from strataloom.llm import pair_bitmaps
from strataloom.llm.queries_models import op12_token_alignment

FOLDER = "/root/testdata/sf0.001"
A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
FIELDS = ["n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def brute_force(texts):
    import sentencepiece
    import tokenizers
    from tokenizers import pre_tokenizers

    a = tokenizers.Tokenizer.from_file(A)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=B)
    # the byte-level alphabet, read off the library's own pre-tokenizer
    alphabet = {}
    for c in map(chr, range(256)):
        out = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False).pre_tokenize_str(c)[0][0]
        alphabet.update(zip(out, c.encode()))
    # the bytes that no such character has stand for themselves
    rest = [b for b in range(256) if b not in alphabet.values()]
    spare = [c for c in pre_tokenizers.ByteLevel.alphabet() if c not in alphabet]
    alphabet.update(zip(sorted(spare), rest))
    links, rows = [], []
    for text in texts:
        raw = (" " + (text or "")).encode()
        x, y = (a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)) if text else ([], [])
        xb = [bytes(alphabet[c] for c in a.id_to_token(i)) for i in x]
        yb = [bytes([int(b.id_to_piece(i)[3:5], 16)]) if b.is_byte(i) else b.id_to_piece(i).replace("▁", " ").encode() for i in y]
        if b"".join(xb) != raw or b"".join(yb) != raw:
            rows.append((0, 0, 0, ""))
            links.append(Counter())
            continue
        spans = []
        for pieces in (xb, yb):
            ends = [sum(map(len, pieces[:k + 1])) for k in range(len(pieces))] if len(pieces) < 3000 else np.cumsum([len(p) for p in pieces]).tolist()
            spans.append([(e - len(p), e) for p, e in zip(pieces, ends)])
        both = sorted({e for _, e in spans[0]} & {e for _, e in spans[1]})
        found, groups, i, j = Counter(), [], 0, 0
        for end in both:
            i0, j0 = i, j
            while i < len(x) and spans[0][i][1] <= end:
                i += 1
            while j < len(y) and spans[1][j][1] <= end:
                j += 1
            groups.append(",".join(map(str, x[i0:i])) + "|" + ",".join(map(str, y[j0:j])))
            for p in range(i0, i):
                for q in range(j0, j):
                    if max(spans[0][p][0], spans[1][q][0]) < min(spans[0][p][1], spans[1][q][1]):
                        found[x[p], y[q]] += 1
        links.append(found)
        rows.append((len(x), len(y), len(groups), hashlib.sha256(";".join(groups).encode()).hexdigest()))
    count = Counter(pair for found in links for pair in found)
    top = {}
    for (p, _), c in count.items():
        top[p] = max(top.get(p, 0), c)
    return [(n_a, n_b, n_groups, sum(found.values()), sum(n for pair, n in found.items() if count[pair] == top[pair[0]]),
             sum(n * count[pair] for pair, n in found.items()), sha) for (n_a, n_b, n_groups, sha), found in zip(rows, links, strict=True)]


def test_query_equals_brute_force(spark):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    rows = sorted(tuple(r) for r in read("documents").select("doc_id", "text").collect())
    got = op12_token_alignment(read)
    assert got.columns == ["doc_id", *FIELDS]
    assert {r["doc_id"]: tuple(r[f] for f in FIELDS) for r in got.collect()} == dict(zip([i for i, _ in rows], brute_force([t for _, t in rows]), strict=True))


@pytest.mark.parametrize("chunk_bytes, slab_bytes", [(16 << 20, 1 << 20), (900, 200)])
def test_awkward_rows_in_any_chunks(spark, chunk_bytes, slab_bytes):
    rng = random.Random(2)
    texts = AWKWARD + [(k, prose(rng, rng.randrange(1, 60), 40)) for k in range(40)]
    texts += [(50, "<|endoftext|> <s></s> <unk> <0x41>"), (51, "a▁b"), (52, " lead"), (53, "tab\tand\r\n"), (54, "é   ﻿ ﬁ"), (55, "\0\x01"), (56, "👩‍👩‍👧 ไทย"), (57, "  ")]
    df = documents(spark, texts).withColumn("row", spark_row(len(texts)))
    out = pair_bitmaps.align(df, A, B, groups=True, chunk_bytes=chunk_bytes, slab_bytes=slab_bytes)
    assert out.count() == len(texts)
    got = sorted((str(r["doc_id"]), *[r[f] for f in FIELDS]) for r in out.collect())
    assert got == sorted((str(i), *x) for (i, _), x in zip(texts, brute_force([t for _, t in texts]), strict=True))
    assert all(hashlib.sha256(r["groups"].encode()).hexdigest() == r["groups_sha256"] for r in out.where("n_a > 0").collect())
    assert pair_bitmaps.align(df.limit(0), A, B).count() == 0


def spark_row(n):
    from pyspark.sql import functions as F

    return F.monotonically_increasing_id() % n


def test_bitmaps_give_back_every_link():
    rng = np.random.default_rng(1)
    docs = 3000
    pairs = np.concatenate([np.full(9000, 7), np.full(40, 9), rng.integers(10, 500, 4000)])
    links = np.sort(pairs << 16 | rng.integers(0, docs, len(pairs)))
    pair, n, bitmap, dense, planes = pair_bitmaps.pack(links, docs)
    import pyarrow as pa

    assert dense[0] and not dense[1]
    of, number, times = pair_bitmaps.unpack(n, dense, pair_bitmaps._binary(pa.chunked_array([bitmap])), pair_bitmaps._binary(pa.chunked_array([planes])))
    assert np.array_equal(np.repeat(pair[of] << 16 | number, times), links)
