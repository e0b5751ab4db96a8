"""Repeated substrings against a dictionary of all windows."""

import hashlib
import random
import sys
from pathlib import Path

import numpy as np

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import AWKWARD, documents

from strataloom.llm import suffix_merge
from strataloom.llm.queries_models import op11_suffix_dedup

FOLDER = "/root/testdata/sf0.001"


def brute_force(texts, length=100):
    """Texts in order -> per text (kept bytes, spans)."""
    seen, out = set(), []
    for text in texts:
        raw = (text or "").encode()
        gone = np.zeros(len(raw) + 1, bool)
        for k in range(len(raw) - length + 1):
            window = raw[k:k + length]
            if window in seen:
                gone[k:k + length] = True
            seen.add(window)
        edges = np.flatnonzero(np.diff(np.concatenate([[0], gone.astype(int)])))
        out.append((bytes(np.frombuffer(raw, np.uint8)[~gone[:-1]]), list(zip(edges[::2].tolist(), edges[1::2].tolist()))))
    return out


def cut(df, **more):
    return {(r["doc_id"], r["text"]): (bytes(r["kept"]), [(s["start"], s["end"]) for s in r["spans"]]) for r in suffix_merge.remove_repeats(df, **more).collect()}


def test_query_equals_brute_force(spark):
    read = lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet")
    rows = sorted(tuple(r) for r in read("documents").select("doc_id", "text").collect())
    expected = {i: (len(t.encode()), len(t.encode()) - len(kept), len(spans), hashlib.sha256(kept).hexdigest())
                for (i, t), (kept, spans) in zip(rows, brute_force([t for _, t in rows]), strict=True)}
    got = op11_suffix_dedup(read)
    assert got.columns == ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
    assert {r[0]: tuple(r)[1:] for r in got.collect()} == expected
    assert sum(x[1] for x in expected.values()) > 0


def test_awkward_rows_and_periods(spark):
    rng = random.Random(3)
    passage = "".join(rng.choice("abcdefgh ÄÖ中") for _ in range(160))
    texts = [(i, f"{rng.random()} {passage} {rng.random()}") for i in range(30)]
    texts += [(50, "x" * 100), (51, "x" * 99), (52, "x" * 101), (53, "y" * 100), (54, "ab" * 400), (55, "\0" * 150), (56, passage + passage), (57, passage)]
    rows = AWKWARD + texts
    once = sorted(set(rows), key=lambda r: (r[0] or 0))
    expected = {r: x for r, x in zip(once, brute_force([t for _, t in once]), strict=True)}
    out = suffix_merge.remove_repeats(documents(spark, rows))
    assert out.count() == len(rows) and set(documents(spark, rows).columns) - {"spans"} <= set(out.columns)
    assert cut(documents(spark, rows)) == expected
    assert cut(documents(spark, rows).limit(0)) == {}
    nulls = suffix_merge.remove_repeats(documents(spark, rows)).where("text is null").collect()
    assert len(nulls) == 2 and all(bytes(r["kept"]) == b"" and r["spans"] == [] for r in nulls)


def test_small_shards_and_hashes_beyond_a_merge(spark):
    """A passage in many contexts is more than one merge takes: its windows are dealt one by one."""
    rng = random.Random(4)
    passage = "".join(rng.choice("abcdefgh ") for _ in range(90))
    texts = [(i, "".join(rng.choice("pqrs") for _ in range(60)) + passage + "".join(rng.choice("pqrs") for _ in range(60))) for i in range(200)]
    texts += [(300 + i, texts[i][1][30:170]) for i in range(40)] + [(400 + i, texts[7][1]) for i in range(50)]
    expected = dict(zip(texts, brute_force([t for _, t in texts]), strict=True))
    for merge_bytes in (1 << 21, 4000):
        assert cut(documents(spark, texts), merge_bytes=merge_bytes, shard_bytes=700) == expected
    short = dict(zip(texts, brute_force([t for _, t in texts], 40), strict=True))
    assert cut(documents(spark, texts), length=40, shard_bytes=900) == short


def test_merge_follows_the_prefixes():
    rng = np.random.default_rng(0)
    parts = [rng.integers(97, 99, n).astype(np.uint8) for n in (130, 101, 100, 400, 120, 222)]
    parts.append(np.concatenate([parts[3][50:250], parts[0]]))
    at = np.cumsum([0, *[len(p) for p in parts]])
    data, place = np.concatenate(parts), np.array([3, 0, 5, 1, 6, 2, 4])
    seen, expected = {}, set()
    for k in np.argsort(place):
        for o in range(len(parts[k]) - 99):
            w = parts[k][o:o + 100].tobytes()
            if w in seen:
                expected.add((k, o))
            seen[w] = 1
    for shard_bytes in (1, 150, 10_000):
        assert set(zip(*[x.tolist() for x in suffix_merge.later_windows(data, at, place, 100, shard_bytes)])) == expected
