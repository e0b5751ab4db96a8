"""Repair of damaged conversations: the cheapest edits by an automaton that shares the ends of signatures."""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored

#: Prices of the edits; a row that is truncated and not deleted costs ``TRUNCATED`` more.
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3
#: The white space of a blank text, and what ends a sentence.
BLANK, STOP = r"[\x20\x09-\x0D]", "[.!?]"
FAULTS = ("blank", "duplicate", "truncated")
RESULTS = ["gaps", *FAULTS, "illegal", "cost", "audit", "repaired_sha256"]
KEY = ["__conv", "__no_conv"]
ORDER = ["__timed", "__turn", "__role", "__text", "__copy"]
#: Grammar states: nothing yet, after s, after u, after a. Which initials each takes, and what an inserted or re-roled row is.
STEP = ({"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2})
NEXT = ("u", "u", "a", "u")
FINAL, FAR = (0, 3), 1 << 60
ROLE_OF = {"u": "user", "a": "assistant"}
LEGAL = {"su", "ua", "au"}


def damage(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Rows of ``turns`` after a seeded damage, as (``KEY``, ``ORDER`` columns); NULL roles and texts are one space.

    By CRC-32 of ``conv:turn`` (a NULL is one space), modulo 20: 0 drops the row, 1 empties its text, 2 removes its
    sentence ends, 3 repeats it, 4 makes it the user's.
    """
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    lot = F.crc32(F.concat(space(conv), F.lit(":"), space(turn)).cast("binary")) % 20
    said = F.when(F.col("__lot") == 1, "").when(F.col("__lot") == 2, F.regexp_replace(space(text), STOP, "")).otherwise(space(text))
    return turns.withColumn("__lot", lot).where("__lot <> 0").select(
        *_keys(turns, conv), F.col(turn).isNotNull().alias("__timed"), F.coalesce(F.col(turn), F.lit(0)).cast("bigint").alias("__turn"),
        F.when(F.col("__lot") == 4, "user").otherwise(space(role)).alias("__role"), said.alias("__text"),
        F.explode(F.when(F.col("__lot") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))).alias("__copy"))


def plain_rows(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """The rows of ``turns`` in the shape of ``damage``, undamaged."""
    space = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    return turns.select(*_keys(turns, conv), F.col(turn).isNotNull().alias("__timed"), F.coalesce(F.col(turn), F.lit(0)).cast("bigint").alias("__turn"),
                        space(role).alias("__role"), space(text).alias("__text"), F.lit(0).alias("__copy"))


def _keys(turns: DataFrame, conv: str) -> list[Column]:
    return [F.coalesce(F.col(conv), F.lit("0").cast(turns.schema[conv].dataType)).alias(KEY[0]), F.col(conv).isNull().alias(KEY[1])]


def judged(rows: DataFrame) -> DataFrame:
    """Adds ``fault`` (NULL, or the first of ``FAULTS`` that holds) and ``sign``, the letter of the row in a signature.

    Equal rows are found by an aggregate joined back, so a row that fills a third of the table is
    reduced before it moves. Rows that agree in every column get numbers by their copy only; they are
    told apart by a running number of their key.
    """
    left = F.regexp_replace("__text", BLANK, "")
    rows = rows.groupBy(*KEY, *ORDER).agg(F.count("*").alias("times"))
    place = F.struct("__timed", "__turn", "__copy")
    firsts = rows.groupBy(*KEY, "__role", "__text").agg(F.min(place).alias("first"))
    same = [*KEY, "__role", "__text"]
    rows = rows.join(firsts, same)
    # a repeat within one aggregated row follows its first
    rows = rows.withColumn("again", F.explode(F.sequence(F.lit(1), F.col("times").cast("int"))))
    fault = (F.when(left == "", FAULTS[0]).when((place != F.col("first")) | (F.col("again") > 1), FAULTS[1])
             .when(~F.substring(left, -1, 1).rlike(STOP), FAULTS[2]))
    initial = F.substring("__role", 1, 1)
    known = F.when(initial.isin("s", "u", "a"), initial).otherwise("o")
    rows = rows.withColumn("fault", fault)
    # small: kept as it is; capital: truncated; x: has to go
    sign = F.when(F.col("fault").isin(*FAULTS[:2]), "x").when(F.col("fault") == FAULTS[2], F.upper(known)).otherwise(known)
    return rows.select(*KEY, *ORDER, "again", "fault", sign.alias("sign"), F.when(initial == "", " ").otherwise(initial).alias("initial"))


def node(sign: str, after: tuple) -> tuple:
    """The automaton node of ``sign`` before the node ``after``: per grammar state (cost-to-go, best edit).

    Each edit leads to one state, so the least suffix among equally cheap ones is the one with the least initial.
    """
    cost, edit = [], []
    fixed = sign == "x"
    more = TRUNCATED if sign.isupper() else 0
    for state in range(4):
        best = (after[0][state] + DELETE, "D")
        if not fixed:
            kept = STEP[state].get(sign.lower())
            if kept is not None:
                best = min(best, (after[0][kept] + more, "K"))
            best = min(best, (after[0][STEP[state][NEXT[state]]] + REROLE + more, "R"))
        cost.append(best[0])
        edit.append(best[1])
    return _with_inserts(cost, edit)


def _with_inserts(cost: list[int], edit: list[str]) -> tuple:
    for _ in range(3):  # an insert leads to u or a; no cheapest repair inserts more than three rows in one place
        for state in range(4):
            cost[state], edit[state] = min((cost[state], edit[state]), (cost[STEP[state][NEXT[state]]] + INSERT, "I"))
    return tuple(cost), tuple(edit)


END = _with_inserts([0 if s in FINAL else FAR for s in range(4)], ["" if s in FINAL else "~" for s in range(4)])


def repairs(signatures: DataFrame) -> DataFrame:
    """(signature, cost, audit) of the distinct ``signature`` strings.

    Signatures are ranged by their reversed letters, so those that share an end follow each other in
    one task: the nodes of the shared end are taken over, only those of the rest are made. Range
    bounds apart, every node of the automaton is computed once for all conversations.
    """
    ranged = signatures.select("signature").distinct().withColumn("backward", F.reverse("signature"))
    ranged = ranged.repartitionByRange("backward").sortWithinPartitions("backward")

    def walk(batches):
        path, nodes = "", [END]  # nodes[k]: of the last k letters
        for batch in batches:
            costs, audits = [], []
            for signature in batch.column(0).to_pylist():
                backward = signature[::-1]
                shared = 0
                for x, y in zip(backward, path):
                    if x != y:
                        break
                    shared += 1
                del nodes[shared + 1:]
                for sign in backward[shared:]:
                    nodes.append(node(sign, nodes[-1]))
                path = backward
                costs.append(nodes[-1][0][0])
                audits.append(_audit(signature, nodes))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(costs, pa.int64()), pa.array(audits, pa.string())], names=["signature", "cost", "audit"])

    return ranged.mapInArrow(walk, "signature string, cost bigint, audit string")


def _audit(signature: str, nodes: list[tuple]) -> str:
    """The edits from the first row on, read off the nodes."""
    state, out, left = 0, [], len(signature)
    while edit := nodes[left][1][state]:
        out.append(edit)
        if edit == "K":
            state = STEP[state][signature[-left].lower()]
        elif edit != "D":
            state = STEP[state][NEXT[state]]
        left -= edit != "I"
    return "".join(out)


def _in_order(rows: DataFrame) -> DataFrame:
    return rows.repartition(*KEY).sortWithinPartitions(*KEY, *ORDER, "again")


def _key_of(batch: pa.RecordBatch) -> list[tuple]:
    return list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))


def signatures(rows: DataFrame) -> DataFrame:
    """(``KEY``, signature, illegal) of judged rows, read as a sorted stream: a task holds a letter a row of one conversation."""
    kind = rows.schema[KEY[0]].dataType

    def read(batches):
        key, letters, last, illegal = None, [], None, 0
        pack = lambda found: pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], types[0]), pa.array([f[1] for f in found], pa.bool_()), pa.array([f[2] for f in found]), pa.array([f[3] for f in found], pa.int64())],
            names=[*KEY, "signature", "illegal"])
        types = [None]
        for batch in batches:
            types[0], found = batch.schema.field(0).type, []
            for k, sign, initial in zip(_key_of(batch), batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True):
                if k != key:
                    if key is not None:
                        found.append((*key, "".join(letters), illegal))
                    key, letters, last, illegal = k, [], None, 0
                letters.append(sign)
                illegal += last is not None and last + initial not in LEGAL
                last = initial
            if found:
                yield pack(found)
        if key is not None:
            yield pack([(*key, "".join(letters), illegal)])

    out = rows.select(*KEY, "sign", "initial", *ORDER, "again")
    return _in_order(out).select(*KEY, "sign", "initial").mapInArrow(read, f"{KEY[0]} {kind.simpleString()}, {KEY[1]} boolean, signature string, illegal bigint")


def repaired_digests(rows: DataFrame, audits: DataFrame) -> DataFrame:
    """(``KEY``, repaired_sha256): each conversation's repaired ``role:text`` lines are hashed as they stream by, in order."""
    kind = rows.schema[KEY[0]].dataType

    class Open:
        def __init__(self, key, audit):
            self.key, self.edits, self.state, self.hash, self.lines = key, iter(audit), 0, hashlib.sha256(), 0

        def line(self, role, text):
            self.hash.update((b"\n" if self.lines else b"") + role.encode() + b":" + text.encode())
            self.lines += 1

        def move(self, initial):
            self.state = STEP[self.state][initial]

        def insert(self):
            initial = NEXT[self.state]
            self.line(ROLE_OF[initial], "")
            self.move(initial)

        def row(self, role, text):
            while (edit := next(self.edits)) == "I":
                self.insert()
            if edit == "K":
                self.line(role, text)
                self.move(role[0])
            elif edit == "R":
                initial = NEXT[self.state]
                self.line(ROLE_OF[initial], text)
                self.move(initial)

        def end(self):
            for _ in self.edits:
                self.insert()
            return (*self.key, self.hash.hexdigest())

    def read(batches):
        now = None
        types = [None]
        pack = lambda found: pa.RecordBatch.from_arrays(
            [pa.array([f[0] for f in found], types[0]), pa.array([f[1] for f in found], pa.bool_()), pa.array([f[2] for f in found])], names=[*KEY, "repaired_sha256"])
        for batch in batches:
            types[0], found = batch.schema.field(0).type, []
            for k, role, text, audit in zip(_key_of(batch), *[batch.column(c).to_pylist() for c in (2, 3, 4)], strict=True):
                if audit is None:
                    now.row(role, text)
                else:
                    if now is not None:
                        found.append(now.end())
                    now = Open(k, audit)
            if found:
                yield pack(found)
        if now is not None:
            yield pack([now.end()])

    # the audit goes ahead of its conversation as a row of its own, sorted first by its NULLs
    out = rows.select(*KEY, *ORDER, "again", F.lit(None).cast("string").alias("audit")).unionByName(
        audits.select(*KEY, "audit"), allowMissingColumns=True)
    return _in_order(out).select(*KEY, "__role", "__text", "audit").mapInArrow(read, f"{KEY[0]} {kind.simpleString()}, {KEY[1]} boolean, repaired_sha256 string")


def repair(turns: DataFrame, rows: DataFrame, conv: str = "conv_id") -> DataFrame:
    """One row for each ``conv`` of ``turns``: faults of ``rows`` (``damage`` or ``plain_rows``), and the cheapest repair.

    Rows go by turn (NULLs first), then role, text and copy; rows equal in all of these are repeats.
    A NULL conversation is one of its own, a role without a letter has a space as its initial.
    Conversations without rows have zeros, an empty audit and the digest of an empty string. ``audit``
    holds an initial for each edit: Keep, Rerole, Delete, Insert.
    """
    rows = stored(judged(rows))
    span = F.max(F.when(F.col("__timed"), F.col("__turn"))) - F.min(F.when(F.col("__timed"), F.col("__turn"))) + 1
    turns_of = rows.groupBy(*KEY, "__timed", "__turn").agg(*[F.sum((F.coalesce("fault", F.lit("")) == f).cast("bigint")).alias(f) for f in FAULTS])
    counted = turns_of.groupBy(*KEY).agg(F.coalesce(span - F.sum(F.col("__timed").cast("bigint")), F.lit(0)).cast("bigint").alias("gaps"), *[F.sum(f).alias(f) for f in FAULTS])
    signed = stored(signatures(rows))
    solved = stored(signed.join(repairs(signed), "signature").select(*KEY, "illegal", "cost", "audit"))
    digests = repaired_digests(rows, solved.select(*KEY, "audit"))
    every = turns.select(F.col(conv), *_keys(turns, conv)).distinct()
    out = every.join(counted, KEY, "left").join(solved, KEY, "left").join(digests, KEY, "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("bigint").alias(c)
    return out.select(conv, *[zero(c) for c in ("gaps", *FAULTS, "illegal", "cost")], F.coalesce("audit", F.lit("")).alias("audit"),
                      F.coalesce("repaired_sha256", F.sha2(F.lit(""), 256)).alias("repaired_sha256"))
