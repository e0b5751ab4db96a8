"""The pipeline: whole-table queries against brute force, each stage against its operator's reading in plain Python."""

import sys
from pathlib import Path

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))
from fixtures import AWKWARD, documents, shingles, words
from test_native import line_brute_force

import corpus_pipeline
from strataloom.llm import mixing, toxicity

FOLDER = "/root/testdata/sf0.001"


def test_stages_equal_brute_force(spark, tmp_path):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    bench = spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()
    model = toxicity.train(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    kept = sorted((r["doc_id"], r["text"]) for r in docs.join(toxicity.score(docs, model), "doc_id").where("score < 0.7").collect())
    gone = line_brute_force(kept, least=1)
    cut = []
    for i, text in kept:
        left = "\n".join(line for k, line in enumerate(text.split("\n")) if (i, k) not in gone)
        if left == text or words(left):
            cut.append((i, left))
    sets = {i: shingles(t) for i, t in cut}
    root = {i: i for i in sets}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            if sets[a] and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.8:
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    alone = [(i, t) for i, t in cut if find(i) == i]
    grams = set()
    for r in bench:
        w = words(r["text"])
        grams |= {tuple(w[k:k + 10]) for k in range(max(len(w) - 9, 1))}
    clean = [(i, t) for i, t in alone if not any(tuple(words(t)[k:k + 10]) in grams for k in range(len(words(t))))]
    stage, expected = docs, [kept, cut, alone, clean]
    for k, (name, f) in enumerate(corpus_pipeline.STAGES):
        f(spark, stage, FOLDER).write.parquet(f"{tmp_path}/{k}")
        out = spark.read.parquet(f"{tmp_path}/{k}")
        if k < 4:
            assert out.columns == docs.columns
            assert sorted((r["doc_id"], r["text"]) for r in out.collect()) == expected[k], name
            stage = out
        else:
            mixed = mixing.mix(stage, mixing.mixing_rates(stage)).where("copies > 0")
            assert sorted(tuple(r) for r in out.select("doc_id", "copies").collect()) == sorted(tuple(r) for r in mixed.select("doc_id", "copies").collect())
            assert set(docs.columns) <= set(out.columns) and 0 < out.count() <= len(clean)


def test_stages_take_awkward_rows(spark):
    docs = documents(spark, AWKWARD)
    for k, (_, f) in enumerate(corpus_pipeline.STAGES):
        out = f(spark, docs, FOLDER)
        if k < 4:
            assert out.columns == docs.columns
            # one of the two repeated rows goes in the third stage, nothing else
            assert out.count() == len(AWKWARD) - (k == 2)
        assert f(spark, docs.limit(0), FOLDER).count() == 0
