"""Conversation repair against a memoised search over all edit strings."""

import hashlib
import random
import re
import zlib
from functools import cache

from strataloom.llm import repair
from strataloom.llm.queries_text import op13_conversation_repair

FOLDER = "/root/testdata/sf0.001"
FIELDS = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
MOVES = {0: {"s": 1, "u": 2}, 1: {"u": 2}, 2: {"a": 3}, 3: {"u": 2}}


def brute_force(rows, damaged=True):
    """rows: (conv, turn, role, text) -> {conv: values of FIELDS}."""
    out = {}
    for conv in {r[0] for r in rows}:
        kept = []
        for _, turn, role, text in [r for r in rows if r[0] == conv]:
            role, text = (" " if x is None else x for x in (role, text))
            lot = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20 if damaged else 9
            if lot == 1:
                text = ""
            if lot == 2:
                text = re.sub("[.!?]", "", text)
            if lot == 4:
                role = "user"
            kept += [(turn, role, text)] * (lot != 0) * (1 + (lot == 3))
        kept.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1], r[2]))
        seen, faults = set(), []
        for _, role, text in kept:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            faults.append("blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else "")
            seen.add((role, text))
        turns = [r[0] for r in kept if r[0] is not None]
        initials = [r[1][:1] or " " for r in kept]

        @cache
        def best(i, state, inserts):
            """(cost, audit, repaired lines) of the rows from i on."""
            found = []
            if i == len(kept) and state in (0, 3):
                found.append((0, "", ()))
            if inserts < 4:
                for initial, to in MOVES[state].items():
                    if initial != "s":
                        c, a, lines = best(i, to, inserts + 1)
                        found.append((c + 3, "I" + a, (f"{'user' if initial == 'u' else 'assistant'}:",) + lines))
            if i < len(kept):
                _, role, text = kept[i]
                c, a, lines = best(i + 1, state, 0)
                found.append((c + 4, "D" + a, lines))
                if faults[i] not in ("blank", "duplicate"):
                    more = 3 * (faults[i] == "truncated")
                    for initial, to in MOVES[state].items():
                        c, a, lines = best(i + 1, to, 0)
                        if role[:1] == initial:
                            found.append((c + more, "K" + a, (f"{role}:{text}",) + lines))
                        if initial != "s":
                            found.append((c + more + 3, "R" + a, (f"{'user' if initial == 'u' else 'assistant'}:{text}",) + lines))
            return min(found, default=(10**9, "", ()))

        cost, audit, lines = best(0, 0, 0)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *[faults.count(f) for f in repair.FAULTS],
                     sum(a + b not in ("su", "ua", "au") for a, b in zip(initials, initials[1:])), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())
    return out


def result(df):
    return {r["conv_id"]: tuple(r[f] for f in FIELDS) for r in df.collect()}


def test_query_equals_brute_force(spark):
    table = spark.read.parquet(f"{FOLDER}/conversations.parquet")
    rows = [tuple(r) for r in table.select("conv_id", "turn", "role", "text").collect()]
    got = op13_conversation_repair(lambda name: spark.read.parquet(f"{FOLDER}/{name}.parquet"))
    assert got.columns == ["conv_id", *FIELDS]
    assert result(got) == brute_force(rows)


def test_random_conversations(spark):
    rng, rows = random.Random(5), []
    texts = ["Yes.", "no", " ", "", "What?", "Go on!\n", "中文。", "same."]
    for conv in [None, *range(120)]:
        for _ in range(rng.randrange(1, 9)):
            rows.append((conv, rng.choice([None, 0, 1, 2, 3, 5, 9]), rng.choice(["user", "assistant", "system", "tool", "", None, "user", "assistant"]), rng.choice([*texts, None])))
    rows += [(500, 0, "user", "Twice."), (500, 0, "user", "Twice."), (500, 0, "user", "Twice.")]
    turns = spark.createDataFrame([(*r, "x", 1, "y") for r in rows], "conv_id bigint, turn bigint, role string, text string, audit string, cost int, fault string")
    assert result(repair.repair(turns, repair.damage(turns))) == brute_force(rows)
    assert result(repair.repair(turns, repair.plain_rows(turns))) == brute_force(rows, damaged=False)


def test_long_and_empty(spark):
    rng = random.Random(6)
    turn = lambda c, k: (c, k, rng.choice(["user", "assistant"]), f"Row {k}" + rng.choice([".", "", "."]))
    rows, long = [turn(7, k) for k in range(120)], [turn(8, k) for k in range(30_000)]
    make = lambda rows: spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string")
    turns = make(rows + long)
    got = result(repair.repair(turns, repair.damage(turns)))
    assert got[7] == brute_force(rows)[7]
    audit = got[8][FIELDS.index("audit")]
    assert len(audit) - audit.count("I") == repair.damage(make(long)).count()
    assert repair.repair(turns.limit(0), repair.damage(turns.limit(0))).count() == 0


def test_shared_ends_are_computed_once():
    a, b = repair.node("a", repair.END), repair.node("u", repair.node("a", repair.END))
    assert repair.END == ((0, 6, 3, 0), ("", "I", "I", ""))
    assert b[0][0] == 0 and b[1][0] == "K" and a[0][2] == 0
