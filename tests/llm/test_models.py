"""Operators in Python tasks: against brute force, the tokenizer's own library, or held-out labels."""

import random
import sys
from collections import Counter
from pathlib import Path

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

sys.path.insert(0, str(Path(__file__).parent))
from fixtures import AWKWARD, documents, prose, shingles

from strataloom.llm import jaccard_join, quality, token_counts, topk, toxicity


def classes_brute_force(texts, threshold=0.8):
    sets = [shingles(t) for _, t in texts]
    root, links = list(range(len(texts))), [0] * len(texts)

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(texts)):
        for b in range(a):
            if sets[a] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= threshold:
                links[a] += 1
                links[b] += 1
                root[max(find(a), find(b))] = min(find(a), find(b))
    least = {}
    for a, (i, _) in enumerate(texts):
        if i is not None:
            least[find(a)] = min(i, least.get(find(a), i))
    return Counter((texts[a][0], least.get(find(a)), links[a]) for a in range(len(texts)))


def near_copies(rng, n_sources, copies):
    texts = []
    for s in range(n_sources):
        base = prose(rng, rng.randrange(30, 200), 5000).split()
        for _ in range(copies):
            w = list(base)
            for _ in range(rng.randrange(0, 5)):
                w[rng.randrange(len(w))] = f"z{rng.randrange(9999)}"
            texts.append((len(texts), " ".join(w)))
    rng.shuffle(texts)
    return texts


def test_jaccard_join_hands_few_texts_to_python_at_once(spark):
    jaccard_join.similar_classes(documents(spark, [(1, "a b c")]))
    rows = spark.range(5000, numPartitions=1).mapInArrow(
        lambda batches: (pa.RecordBatch.from_pydict({"n": [b.num_rows]}) for b in batches), "n bigint")
    assert max(r["n"] for r in rows.collect()) <= 1000


def test_jaccard_join_equals_brute_force(spark):
    texts = near_copies(random.Random(4), 12, 12) + AWKWARD + [(950, "ONE"), (951, "one!"), (952, "a b c d e"), (953, "A b c d e")]
    docs = documents(spark, texts)
    out = jaccard_join.similar_classes(docs).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in out) == classes_brute_force(texts)
    kept = jaccard_join.one_of_each(docs)
    assert kept.columns == docs.columns
    left = Counter(r["doc_id"] for r in kept.collect())
    classes = {r["class_id"] for r in out if r["n_links"] or r["class_id"] is not None}
    assert left[906] == 1 and left[901] == left[902] == left[903] == 1 and left[951] == 0 and {c for c in classes} <= set(left)
    assert sum(left.values()) == len({c for c in classes}) + 2  # and the two rows without an id
    assert jaccard_join.similar_classes(docs.limit(0)).count() == 0


def test_components_above_a_block_are_dealt_over_cells(spark, monkeypatch):
    monkeypatch.setattr(jaccard_join, "BLOCK_NODES", 16)
    monkeypatch.setattr(jaccard_join, "BROADCAST_ROWS", 0)
    texts = near_copies(random.Random(5), 2, 70)
    out = jaccard_join.similar_classes(documents(spark, texts)).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in out) == classes_brute_force(texts)


def test_links_of_long_texts_are_counted_once(spark, monkeypatch):
    # pairs of two to seven blocks: some blocks are empty
    monkeypatch.setattr(jaccard_join, "BLOCK_SHINGLES", 64)
    texts = near_copies(random.Random(6), 20, 2)
    out = jaccard_join.similar_classes(documents(spark, texts)).collect()
    assert Counter((r["doc_id"], r["class_id"], r["n_links"]) for r in out) == classes_brute_force(texts)


def test_prefixes_shorten_until_the_target_recall():
    # links far above the threshold need no short prefixes, links at it do
    depths = [next(d for d in range(jaccard_join.LONGEST, 0, -1) if jaccard_join.reached_recall(found, d) >= jaccard_join.RECALL)
              for found in ({0.95: 10 ** 6}, {0.9: 1000}, {0.8: 1000})]
    assert depths == sorted(depths, reverse=True) and depths[0] == jaccard_join.LONGEST and depths[-1] == 4
    assert jaccard_join.reached_recall({}, 4) >= jaccard_join.RECALL > jaccard_join.reached_recall({}, 5)


def test_rows_repeated_often_reach_a_cell_once(spark):
    texts = near_copies(random.Random(9), 2, 4)
    docs = documents(spark, texts)
    many = docs.unionByName(docs.where(F.col("doc_id") == texts[0][0]).select(F.explode(F.array_repeat(F.struct("*"), 2000)).alias("r")).select("r.*"))
    out = jaccard_join.similar_classes(many).collect()
    expected = {i: (c, n) for i, c, n in classes_brute_force(texts)}
    assert len(out) == len(texts) + 2000 and {(r["doc_id"], r["class_id"]) for r in out} == {(i, c) for i, (c, _) in expected.items()}
    links = {r["doc_id"]: r["n_links"] for r in out}
    hot = shingles(texts[0][1])
    for i, t in texts:
        near = len(hot & shingles(t)) / len(hot | shingles(t)) >= 0.8
        assert links[i] == expected[i][1] + 2000 * near


TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def test_token_counts_equal_the_library(spark):
    rng = random.Random(6)
    parts = ["a", "b", "'", "s", "t", "re", "ve", "'s", "'ll", " ", "  ", "\n", "\t", "1", "23", "!", "?", "é", "ß", "中", "　", "\x1c", "̀", "😀",
             "<|endoftext|>", "the", "Hello", "don't", "\xa0", "\r", "²", "ʼ", "thshthble", " "]
    texts = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(60)))) for i in range(600)] + AWKWARD
    texts += [(2000 + k, "".join(map(chr, range(k, min(k + 500, 0xD800))))) for k in range(0, 0xD800, 500)] + [(3000, "x" * 5000), (3001, " " * 3000 + "a")]
    library = Tokenizer.from_file(TOKENIZER)
    expected = Counter((i, len((t or "").encode()), n := len(library.encode(t or "", add_special_tokens=False).ids), n > 1024) for i, t in texts)
    got = token_counts.token_counts(documents(spark, texts), TOKENIZER)
    assert Counter(tuple(r) for r in got.collect()) == expected
    assert token_counts.token_counts(documents(spark, texts).limit(0), TOKENIZER).count() == 0


def test_state_maps_compose_to_the_sequential_reading():
    rng = np.random.default_rng(7)
    symbol = rng.integers(0, 8, 1500).astype(np.uint8)
    symbol[[0, 300, 301]] += 8
    state, marks = 0, []
    for at, s in enumerate(symbol):
        if token_counts.MARKS[state * 16 + s]:
            marks.append(at)
        state = token_counts.GOES[state * 16 + s]
    assert token_counts.word_starts(symbol).tolist() == marks


def test_other_tokenizers_are_refused(tmp_path):
    with pytest.raises(ValueError):
        token_counts.load_tokenizer(public_tokenizers.path("word_bpe_49k.json"))


def toxic_corpus(rng, n):
    rows = []
    for i in range(n):
        bad = rng.random() < 0.3
        body = [prose(rng, rng.randrange(4, 15)) + "." for _ in range(rng.randrange(2, 8))]
        if bad:
            at = rng.randrange(len(body))
            body[at] = f"you {rng.choice(['vile', 'nasty', 'rotten'])} {body[at]}"
        rows.append((i, " ".join(body), int(bad)))
    return rows


def test_toxicity_learns_from_documents_and_finds_sentences(spark):
    rows = toxic_corpus(random.Random(8), 600)
    docs = documents(spark, [(i, t) for i, t, _ in rows])
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (5, None), (rows[0][0], rows[0][2])], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    out = {r["doc_id"]: r for r in toxicity.score(docs, model).collect()}
    import zlib
    held = [(i, t, y) for i, t, y in rows if zlib.crc32(str(i).encode()) % 3 == 1]
    right = np.mean([(out[i]["score"] >= 0.7) == bool(y) for i, _, y in held])
    assert right > 0.95
    for i, text, y in held:
        if y and out[i]["score"] >= 0.7:
            assert any(w in text[s["start"]:s["end"]] for s in out[i]["offending"] for w in ("vile", "nasty", "rotten"))
    kept = toxicity.without_toxic(docs, model)
    assert kept.columns == docs.columns and {r["doc_id"] for r in kept.collect()} == {i for i, r in out.items() if r["score"] < 0.7}


def test_toxicity_of_awkward_rows(spark):
    rows = toxic_corpus(random.Random(9), 200)
    docs = documents(spark, [(i, t) for i, t, _ in rows] + AWKWARD)
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id bigint, toxic int")
    model = toxicity.train(docs, labels)
    out = toxicity.score(documents(spark, AWKWARD), model).collect()
    assert len(out) == len(AWKWARD) and all(0 <= r["score"] <= 1 and r["score"] < 0.7 for r in out)
    assert {r["score"] for r in out if r["doc_id"] in (901, 902, 903)} == {out[0]["score"]}
    assert toxicity.without_toxic(documents(spark, AWKWARD), model).count() == len(AWKWARD)
    assert toxicity.score(docs.limit(0), model).count() == 0
    for some in (labels.limit(0), labels.where("toxic = 0")):
        assert all(r["score"] < 0.1 for r in toxicity.score(docs, toxicity.train(docs, some)).collect())


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(10)
    truth = rng.random(20000) < 0.85
    hit, false = np.array([0.95, 0.97, 0.9, 0.99]), np.array([0.4, 0.3, 0.6, 0.5])
    cast = np.where(rng.random((20000, 4)) < np.where(truth[:, None], hit, false), 1, 0)
    cast[rng.random(cast.shape) < 0.1] = -1
    patterns, counts = np.unique(cast, axis=0, return_counts=True)
    model = quality.fit_votes(patterns, counts.astype(float))
    assert abs(model.prior - 0.85) < 0.08 and np.abs(model.hit - hit).max() < 0.05
    assert np.mean((model.posterior(cast) >= 0.5) == truth) > 0.9


def test_quality_tells_prose_from_junk(spark):
    rng = random.Random(11)
    good = [(i, " ".join(rng.choice(["the", "of", "and", f"word{chr(97 + rng.randrange(26))}{chr(97 + rng.randrange(26))}"]) for _ in range(80)) + ".") for i in range(300)]
    bad = [(1000 + i, " ".join(f"{chr(97 + rng.randrange(26))}### %%% $$$ 12345" for _ in range(40))) for i in range(40)]
    out = {r["doc_id"]: r for r in quality.quality(documents(spark, good + bad)).collect()}
    assert np.mean([out[i]["good"] for i, _ in good]) > 0.97 and np.mean([out[i]["good"] for i, _ in bad]) < 0.1
    odd = quality.quality(documents(spark, good[:50] + AWKWARD))
    assert odd.count() == 50 + len(AWKWARD) and odd.where("posterior < 0 or posterior > 1 or score < 0 or score > 1").count() == 0
    assert quality.quality(documents(spark, AWKWARD).limit(0)).count() == 0


def test_repeated_words_are_judged_at_every_length():
    rng = random.Random(14)
    passage = " ".join(f"p{k}" for k in range(700))
    texts = ["long " * 30000, (passage + " ") * 100, "few words again " * 700, "few words again " * 600, prose(rng, 20000, 9000), prose(rng, 2100, 1500), prose(rng, 1900, 1500)]
    data = "".join(texts).encode()
    cast = quality.votes(np.frombuffer(data, dtype=np.uint8), np.cumsum([0] + [len(t) for t in texts]), quality._stop_hashes())
    assert cast[:, 5].tolist() == [0, 0, 0, 0, 1, 1, 1]


def top_k_brute_force(vectors, queries, k):
    out = []
    for q, x in queries:
        others = list(vectors)
        others.remove((q, x))  # its own row, once
        most = 2 ** 63 - 1
        scored = sorted(((-max(-most - 1, min(most, sum(a * b for a, b in zip(x, y)))), i) for i, y in others if len(x) == len(y)))[:k]
        out += [(q, rank, i, -s) for rank, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def test_top_k_equals_brute_force(spark, monkeypatch):
    rng = random.Random(12)
    vectors = [(i * 3, [rng.randrange(-3, 4) for _ in range(6)]) for i in range(400)]
    monkeypatch.setattr(topk, "PACK", 150), monkeypatch.setattr(topk, "QUERIES", 20)
    df = spark.createDataFrame([(*v, "x") for v in vectors + [vectors[7], (None, [1] * 6), (5000, None)]], "vec_id bigint, vector array<bigint>, rank string")
    got = topk.top_k(df, df.where("vec_id % 30 = 0"), k=5)
    assert got.columns == ["query_id", "rank", "vec_id", "score"]
    assert sorted(tuple(r) for r in got.collect()) == top_k_brute_force(vectors + [vectors[7]], [v for v in vectors if v[0] % 30 == 0], 5)
    few = df.where("vec_id < 9")
    assert topk.top_k(few, few, k=5).count() == 6
    assert topk.top_k(df.limit(0), df.limit(0)).count() == 0


def test_top_k_of_repeated_ids_lengths_and_large_numbers(spark):
    rows = [(0, [1, 1]), (1, [1, 1]), (1, [3, 3]), (1, [3, 3]), (2, [2]), (2, [5]), (3, [5]), (50, [2, -1]), (50, [2, -1])]
    rows += [(60, [2 ** 40, 1]), (61, [2 ** 40, -3]), (62, [2 ** 61, 2 ** 61]), (70, [])] + [(71, [])] * 9
    df = spark.createDataFrame(rows, "vec_id bigint, vector array<bigint>")
    expected = top_k_brute_force(rows, rows, 3)
    assert sorted(tuple(r) for r in topk.top_k(df, df, k=3).collect()) == expected
    asked = spark.createDataFrame([(1, [9, 9])], df.schema)  # a query that is no row leaves none out
    assert [tuple(r) for r in topk.top_k(df.where("vec_id < 2"), asked, k=2).orderBy("rank").collect()] == [(1, 1, 1, 54), (1, 2, 1, 54)]


def test_fit_bounds_hold_for_repeated_rows(spark, monkeypatch):
    """A row that is there 5000 times is one row of the fit."""
    rng = random.Random(14)
    texts = [(k, prose(rng, 30) + (" vile filth" if k % 2 else "")) for k in range(60)] + [(3, prose(rng, 30) + " vile filth")] * 5000
    docs = documents(spark, texts)
    labels = spark.createDataFrame([(k, k % 2) for k in range(60)], "doc_id bigint, toxic int")
    sizes = []
    fit, scorer = toxicity.fit, quality.fit_scorer
    monkeypatch.setattr(toxicity, "fit", lambda feature, sentence, owner, y, weight: sizes.append(len(y)) or fit(feature, sentence, owner, y, weight))
    toxicity.train(docs, labels, per_class=10)
    monkeypatch.setattr(quality, "fit_scorer", lambda owner, bucket, value, target, *more: sizes.append(len(target)) or scorer(owner, bucket, value, target, *more))
    quality.quality(docs, fit_rows=40)
    assert sizes[0] <= 20 and sizes[1] <= 40


def test_pruning_skips_blocks_and_bounds_hold():
    rng = np.random.default_rng(13)
    # sparse, clustered vectors: most blocks cannot matter
    vectors = np.zeros((2048, 16))
    vectors[np.arange(2048), np.arange(2048) // 128] = rng.integers(50, 100, 2048)
    index = topk._Blocks(np.arange(2048), np.arange(2048), vectors)
    assert (index.bounds(vectors[:50])[:, :, None] >= np.stack([vectors[:50] @ index.vectors[a:e].T for a, e in zip(index.edges, index.edges[1:])], axis=1) - 1e-9).all()


def test_quantised_vectors(spark):
    df = spark.createDataFrame([(1, [0.5, -0.001]), (2, None), (3, [float("nan"), 1.0]), (4, [None, 1.0]), (5, [float("inf"), 0.0]), (6, []), (7, [1e17, 1e30])], "vec_id bigint, embedding array<float>")
    assert {r[0]: r[1] for r in df.select("vec_id", topk.quantised(F.col("embedding"))).collect()} == {1: [128, -1], 2: None, 3: None, 4: None, 5: None, 6: [], 7: None}
