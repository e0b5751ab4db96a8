"""The native operators against brute force, on small tables with awkward rows."""

import hashlib
import random
import re
import sys
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).parent))
sys.path.insert(0, str(Path(__file__).parents[2]))
from fixtures import AWKWARD, LOWER, WORD, documents, prose, words

import corpus_pipeline
from strataloom.llm import chat, decontamination, line_dedup, mixing, secrets
from strataloom.llm.queries import QUERIES, load_queries


def test_decontamination_equals_brute_force(spark):
    rng = random.Random(1)
    items = [(i, prose(rng, n)) for i, n in enumerate([30, 12, 10, 4, 1, 25])] + [(6, None), (7, ""), (None, prose(rng, 20)), (1, prose(rng, 11))]
    items[5] = (5, items[0][1].upper().replace(" ", " -- "))
    texts = [(i, prose(rng, 80, 300)) for i in range(12)]
    texts += [(20, prose(rng, 5) + " " + items[0][1] + " " + prose(rng, 5)), (21, "x " + " ".join(items[0][1].split()[3:13])),
              (22, " ".join(items[1][1].split()[:9])), (23, items[3][1] + " " + items[3][1]), (24, "!!" + items[1][1].upper() + "..")] + AWKWARD
    docs, bench = documents(spark, texts), spark.createDataFrame(items, "item_id bigint, text string")
    grams = {}
    for item, text in items:
        w = words(text)
        if item is not None and w:
            n = min(10, len(w))
            for i in range(len(w) - n + 1):
                grams.setdefault(tuple(w[i:i + n]), set()).add(str(item))
    expected, rest = Counter(), {}
    for doc_id, text in texts:
        w, hit, found = words(text), set(), set()
        for g, ids in grams.items():
            for i in range(len(w) - len(g) + 1):
                if tuple(w[i:i + len(g)]) == g:
                    hit.update(range(i, i + len(g)))
                    found |= ids
        expected[doc_id, len(w), len(hit), tuple(sorted(found)), bool(hit)] += 1
        rest[doc_id] = [x for k, x in enumerate(w) if k not in hit]
    got = decontamination.contamination(docs, bench).collect()
    assert Counter((r["doc_id"], r["n_words"], r["n_hit"], tuple(r["items"]), r["contaminated"]) for r in got) == expected
    clean = Counter(r["doc_id"] for r in got if not r["contaminated"])
    kept = decontamination.decontaminate(docs, bench)
    assert kept.columns == docs.columns and Counter(r["doc_id"] for r in kept.collect()) == clean
    cut = {r["doc_id"]: r["text"] for r in decontamination.decontaminate(docs, bench, remove="spans").collect()}
    assert cut[21] == "x " and cut[24] == "!!" and cut[902] == "" and cut[901] is None
    assert all(words(cut[i]) == rest[i] for i in rest if i is not None)
    shuffled = decontamination.find_hits(docs, decontamination.benchmark_grams(bench), broadcast_grams=0)
    assert shuffled.count() == decontamination.find_hits(docs, decontamination.benchmark_grams(bench)).count()


def test_decontamination_of_empty_tables(spark):
    docs, bench = documents(spark, [(1, "a b c")]), spark.createDataFrame([], "item_id bigint, text string")
    assert [tuple(r)[:4] for r in decontamination.contamination(docs, bench).collect()] == [(1, 3, 0, 0)]
    assert decontamination.contamination(docs.limit(0), bench).count() == 0


def line_brute_force(texts, threshold=0.8, least=1):
    tokens = lambda line: frozenset(t for t in re.split(r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", line.lower()) if t)
    lines = [(i, k, tokens(line)) for i, text in texts if text is not None for k, line in enumerate(text.split("\n"))]
    out = set()
    for a, (i, k, s) in enumerate(lines):
        if len(s) >= least and any(len(t) >= least and len(s & t) / len(s | t) >= threshold for _, _, t in lines[:a]):
            out.add((i, k))
    return out


def test_line_dedup_equals_brute_force(spark):
    rng = random.Random(2)
    base = [prose(rng, rng.randrange(3, 30), 60) for _ in range(30)]

    def near(line):
        w = line.split()
        for _ in range(rng.randrange(3)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(50)}"
        rng.shuffle(w)
        return " ".join(w)

    texts = [(i, "\n".join(near(rng.choice(base)) for _ in range(rng.randrange(1, 8)))) for i in range(40)]
    texts += [(100 + i, base[4] + " " + prose(rng, 12, 9) + "\nÄhnlich " + base[0].upper()) for i in range(5)]
    gone = line_brute_force(texts)
    assert len(gone) > 20
    got = {r["doc_id"]: r for r in line_dedup.dedup_lines(documents(spark, texts)).collect()}
    for i, text in texts:
        kept = [line for k, line in enumerate(text.split("\n")) if (i, k) not in gone]
        assert (got[i]["text"], got[i]["n_lines"], got[i]["n_removed"]) == ("\n".join(kept), text.count("\n") + 1, text.count("\n") + 1 - len(kept))


def test_line_tokens_are_hashed_once(spark):
    # the other hash is the constant of the empty token
    assert len(re.findall(r"xxhash64\((?!')", str(line_dedup._ordered(F.col("line"), F.col("levels"))))) == 1


def test_lines_are_split_once_and_long_ones_told_apart(spark, monkeypatch):
    words = lambda start: " ".join(f"w{i}" for i in range(start, start + 300))
    docs = documents(spark, [(0, words(0)), (1, words(300)), (2, words(3))])
    rows = {r["__row_id"]: r for r in line_dedup.token_table(line_dedup.keyed(docs, "doc_id", "text"), "text").collect()}
    bits = lambda a, b: sum(bin((rows[a][c] ^ rows[b][c]) & (2**64 - 1)).count("1") for c in ("low", "high"))
    # at most as many bits as tokens differ; sets of 300 tokens without a common one do not look alike
    assert bits(0, 2) <= 6 and bits(0, 1) > 30 and [rows[i]["n"] for i in range(3)] == [300] * 3
    ordered = spark.createDataFrame([([1, 2],)], "tokens array<int>").select(line_dedup._rarest_first(
        F.col("tokens"), F.array(F.lit(5).cast("tinyint"), F.lit(3).cast("tinyint"))).alias("o"))
    assert sorted(x & 0xFFFFFFFF for x in ordered.first()["o"]) == [1, 2]
    # the search splits every line in one place, the rarity of its tokens is counted on their numbers
    calls, split = [], line_dedup._ordered
    monkeypatch.setattr(line_dedup, "_ordered", lambda *a: calls.append(a) or split(*a))
    assert {r["doc_id"]: r["n_removed"] for r in line_dedup.dedup_lines(docs).collect()} == {0: 0, 1: 0, 2: 1}
    assert len(calls) == 1 and len(calls[0]) == 1


def test_op8_and_stage_compare_short_lines(spark, tmp_path):
    rng = random.Random(3)
    texts = [(i, "\n".join(prose(rng, rng.randrange(1, 9), 7) for _ in range(rng.randrange(1, 6)))) for i in range(40)]
    # four of five tokens reach 0.8, in either order, three of four do not
    texts += [(50, "k1 k2 k3 k4\nm1 m2 m3 m4 m5\nn1 n2 n3"), (51, "k1 k2 k3 k4 k5\nm5 m4 m3 m1\nn1 n2 n3 n4"), (52, "}\n\n中文一行\nend"), (53, "}\n\n中文一行"), (54, "END."), (55, None)]
    gone = line_brute_force(texts, least=1)
    assert {(51, 0), (51, 1), (53, 2), (54, 0)} <= gone and (51, 2) not in gone and (53, 0) not in gone
    cut = {i: text and "\n".join(line for k, line in enumerate(text.split("\n")) if (i, k) not in gone) for i, text in texts}
    docs = documents(spark, texts)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    load_queries()
    assert {r["doc_id"]: r["text"] for r in QUERIES["op8_line_dedup"](spark, str(tmp_path)).collect()} == cut
    staged = {r["doc_id"]: r["text"] for r in corpus_pipeline.line_dedup_stage(spark, docs, str(tmp_path)).collect()}
    assert staged == {i: cut[i] for i, text in texts if cut[i] == text or words(cut[i])}


def test_line_dedup_of_awkward_rows(spark):
    line = "alpha beta gamma delta epsilon zeta eta theta iota"
    docs = documents(spark, AWKWARD + [(1, line), (2, f"{line}\nunlike"), (3, line), (3, line), (None, line)])
    out = line_dedup.dedup_lines(docs)
    assert set(docs.columns) <= set(out.columns) and out.count() == docs.count()
    rows = [(r["doc_id"], r["text"], r["n_removed"]) for r in out.collect()]
    # a NULL id ranks as 0, before the others
    assert (None, line, 0) in rows and (1, "", 1) in rows and (2, "unlike", 1) in rows and rows.count((3, "", 1)) == 2
    assert (901, None, 0) in rows and (902, "", 0) in rows and rows.count((906, "same row here", 0)) == 2
    stage = line_dedup.without_repeats(docs)
    assert stage.columns == docs.columns
    left = Counter(r["doc_id"] for r in stage.collect())
    assert 1 not in left and 3 not in left and left[906] == 2 and left[2] == 1 and left[901] == left[902] == left[903] == 1
    assert [r["n_chars"] for r in stage.where("doc_id = 2").collect()] == [6]
    assert line_dedup.dedup_lines(docs.limit(0)).count() == 0


def spans_brute_force(text):
    text = text or ""
    out = []
    assign = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
    out += [(m.start(), 0, m.end()) for m in re.finditer(assign, text) if len(m[2]) >= 8]
    out += [(m.start(), 1, m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    out += [(m.start(), 2, m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 32]
    return sorted(out)


def test_secrets_equal_brute_force(spark):
    h = hashlib.md5(b"x").hexdigest()
    live, example = "Zx9" + "aB3dE5" * 5, "Qq1" + "rT7yU8" * 5
    texts = [(1, f"password = 'hunter22x' 😀 API_KEY:\"{h}\" é token=short {h}{h}g{h}"), (2, "akiaABC AKIA" + "A1" * 10 + " AKIAAKIA"),
             (3, f"key {live} end"), (4, "secret=token=abcdefgh1 PassWd:  abcdefgh"), (5, f"see {example}", "en", "a"), (6, f"see {example}", "en", "b"),
             (7, f"see {example}", "de", "c"), (8, f"apikey={live}"), (9, "password=" * 5 + "secret:abcdefgh12"), (10, f"{h[:31]} {h} \n{h}")] + AWKWARD
    docs = documents(spark, texts)
    out = secrets.summary(secrets.scan(docs)).collect()
    assert len(out) == len(texts)
    expected = Counter()
    for r in texts:
        base = spans_brute_force(r[1])
        name = ",".join(f"{secrets.KINDS[k]}:{a}:{e}" for a, k, e in base)
        n = Counter(k for _, k, _ in base)
        expected[r[0], n[0], n[1], n[2], hashlib.sha256(name.encode()).hexdigest()] += 1
    assert Counter((r["doc_id"], r["n_assign"], r["n_access"], r["n_hex"], r["base_sha256"]) for r in out) == expected
    spans = {r["doc_id"]: r for r in out}
    # the opaque run of few owners is added, the widely copied one is not, and none inside a base span
    assert spans[3]["spans"] == f"opaque:4:{4 + len(live)}" and spans[3]["n_live"] == 1
    assert spans[5]["spans"] == "" and "opaque" not in spans[8]["spans"]
    assert secrets.scan(docs.limit(0)).count() == 0


def rake_brute_force(weights, targets, rounds):
    w = dict(weights)
    for _ in range(rounds):
        for at, goal in enumerate(targets):
            sums = Counter()
            for key, v in w.items():
                sums[key[at]] += v
            w = {key: v * goal[key[at]] / sums[key[at]] for key, v in w.items()}
    return w


def test_mixing_meets_its_margins(spark):
    rng = random.Random(3)
    texts = [(i, prose(rng, rng.randrange(5, 200)) if i % 7 else "" if i % 2 else None, rng.choice(["en", "de", None]), rng.choice(["a", "a", "a", "b", "c", None])) for i in range(300)]
    docs = documents(spark, texts)
    rates = mixing.mixing_rates(docs, topic=F.lit("t"))
    cells = Counter()
    for _, text, lang, source in texts:
        cells[source or "", lang or ""] += -(-len((text or "").encode()) // 4)
    total = sum(cells.values())

    def goal(at, power):
        sums = Counter()
        for key, n in cells.items():
            sums[key[at]] += n
        scale = sum(n ** power for n in sums.values())
        return {k: n ** power / scale for k, n in sums.items()}

    expected = rake_brute_force({k: n / total for k, n in cells.items()}, [goal(0, 0.5), goal(1, 0.5)], 8)
    got = {(r["source"], r["lang"]): r["w"] for r in rates.collect()}
    assert got == pytest.approx(expected)
    mixed = mixing.mix(docs, rates, topic=F.lit("t"))
    rows = mixed.collect()
    assert len(rows) == len(texts) and set(docs.columns) - {"copies"} <= set(mixed.columns)
    assert sum(r["rate"] * r["tokens"] for r in rows) == pytest.approx(total / 2)
    assert all(r["copies"] - r["rate"] < 1 and r["rate"] - r["copies"] < 1 for r in rows)
    assert all(r["copies"] == 0 for r in rows if not r["text"])
    assert sum(r["copies"] * r["tokens"] for r in rows) == pytest.approx(total / 2, rel=0.25)
    plain = mixing.mix(docs, rates, topic=F.lit("t"), broadcast_cells=0)
    assert Counter(r["copies"] for r in plain.collect()) == Counter(r["copies"] for r in rows)
    nothing = docs.limit(0)
    assert mixing.mix(nothing, mixing.mixing_rates(nothing)).count() == 0


def test_topics_count_initials(spark):
    docs = documents(spark, [(1, "apple bee eel"), (2, "zoo yes x Zoo"), (3, None), (4, "gg hh aa")])
    assert {r["doc_id"]: r["t"] for r in docs.select("doc_id", mixing.initial_topic(F.col("text")).alias("t")).collect()} == {1: "t1", 2: "t6", 3: "t1", 4: "t2"}


def test_preference_pairs(spark):
    turns = [(0, 0, "user", "hi"), (0, 1, "assistant", "yes é"), (0, 2, "user", "more"), (1, 0, "user", "hi"), (1, 1, "assistant", "no"), (1, 1, "assistant", "no"),
             (2, 0, "user", "same"), (3, 0, "user", "same"), (4, 0, None, None), (4, None, "user", ""), (None, 0, "user", "lost"), (7, 0, "system", "s"), (7, 1, "assistant", "b")]
    df = spark.createDataFrame([(*t, "x", "y") for t in turns], "conv_id bigint, turn bigint, role string, text string, prompt string, chosen string")
    out = {r["pair_id"]: r for r in chat.format_pairs(chat.neighbour_pairs(chat.conversations(df))).collect()}
    assert sorted(out) == [0, 1, 2, 3]
    assert out[0]["n_common"] == 1 and out[0]["prompt"] == "<|user|>\nhi<|end|>\n"
    assert out[0]["chosen"] == "<|assistant|>\nyes é<|end|>\n<|user|>\nmore<|end|>\n" and out[0]["rejected"] == "<|assistant|>\nno<|end|>\n"
    for r in out.values():
        for side in ("chosen", "rejected"):
            at, trained = 0, []
            for run in r[f"{side}_mask"]:
                if run["train"]:
                    trained.append(r[side][at:at + run["n"]])
                at += run["n"]
            assert at == len(r[side])
            assert "".join(trained) == "".join(re.findall(r"<\|assistant\|>\n(.*?<\|end\|>\n)", r[side], re.S))
    assert out[1]["n_common"] == 1 and out[1]["chosen"] == out[1]["rejected"] == ""
    assert out[2]["rejected_id"] is None and out[3]["chosen_id"] is None and out[3]["prompt"] == ""
    assert chat.format_pairs(chat.neighbour_pairs(chat.conversations(df.limit(0)))).count() == 0


def test_pairs_of_large_and_negative_ids(spark):
    ids = [2 ** 60 + k for k in range(2, 6)] + [-4, -3, -1]
    df = spark.createDataFrame([(i, 0, "user", "hello") for i in ids], "conv_id bigint, turn bigint, role string, text string")
    got = sorted((r["chosen_id"], r["rejected_id"]) for r in chat.neighbour_pairs(chat.conversations(df)).where("chosen_id is not null").collect())
    assert got == [(-4, -3), (2 ** 60 + 2, 2 ** 60 + 3), (2 ** 60 + 4, 2 ** 60 + 5)]


def test_queries_without_the_tokenizer_library():
    import subprocess
    import sys

    code = "import sys; sys.modules['public_tokenizers'] = None; import __spark_entry__ as e; q = e.queries(); print(len(q), any(k.startswith('op') for k in q), len(e.oracle_sql()))"
    root = str(__import__("pathlib").Path(__file__).parents[2])
    out = subprocess.run([sys.executable, "-c", code], cwd=root, capture_output=True, text=True, check=True).stdout.split()
    assert int(out[0]) > 100 and out[1] == "False" and int(out[2]) > 100
