"""Token counts by a tokenizer compiled to two deterministic transducers.

The first reads characters and emits a mark at each character that begins a word of the
tokenizer. Its state maps over chunks of text compose by a parallel prefix scan, so all chunks of
a batch advance together. The second reads the bytes of a word; each transition carries the
number of tokens by which the count changes. Both only count: no token is ever built.
"""

from __future__ import annotations

import json
import re

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

LETTER, NUMBER, SPACE, BLANK, OTHER, END = range(6)
#: States of the first transducer: what the last character belongs to.
START, IN_LETTERS, IN_NUMBERS, IN_OTHER, ONE_SPACE, IN_BLANKS, ONE_BLANK, ONE_MORE, TWO_MORE = range(9)
#: Its symbols: a class with what the characters ahead decide. A blank is the last of its run or inside;
#: an apostrophe may begin a contraction of two or three characters. From 8 on: first of a text.
S_LETTER, S_NUMBER, S_OTHER, S_LAST_SPACE, S_LAST_BLANK, S_BLANK, S_SHORT, S_LONG = range(8)
#: What may follow an apostrophe in a contraction.
SHORT, LONG = "stmd", ("re", "ve", "ll")
CHUNK = 128
SLICE_CHARS = 1 << 19
#: Words and states kept by a worker; past them the tables start anew.
MOST_WORDS, MOST_STATES = 1_000_000, 400_000


def load_tokenizer(path: str) -> dict:
    """What the transducers are compiled from: the merges in order, special strings, the scheme."""
    with open(path, encoding="utf-8") as f:
        spec = json.load(f)
    pre = spec["pre_tokenizer"] or {}
    if spec["model"]["type"] != "BPE" or pre.get("type") != "ByteLevel" or not pre.get("use_regex", True) or pre.get("add_prefix_space") or spec["normalizer"]:
        raise ValueError("only byte-level BPE with the standard splitting pattern is compiled")
    merges = [tuple(m) if isinstance(m, list) else tuple(m.split(" ")) for m in spec["model"]["merges"]]
    return {"merges": merges, "special": [t["content"] for t in spec["added_tokens"]]}


def byte_names() -> dict[str, int]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(others)}


def character_classes() -> np.ndarray:
    """Class of every code point."""
    table = np.full(0x110000, OTHER, dtype=np.uint8)
    for low in (0, 0xE000):
        text = "".join(map(chr, range(low, 0xD800 if low == 0 else 0x110000)))
        for kind, pattern in ((LETTER, r"\p{L}+"), (NUMBER, r"\p{N}+"), (BLANK, r"\p{White_Space}+")):
            for m in regex.finditer(pattern, text):
                table[low + m.start():low + m.end()] = kind
    table[ord(" ")] = SPACE
    return table


def _compile_marks() -> tuple[np.ndarray, np.ndarray]:
    """(next state, mark) of the first transducer, at state * 16 + symbol."""
    goes, marks = np.zeros((9, 16), dtype=np.uint8), np.zeros((9, 16), dtype=bool)
    into = {S_LETTER: IN_LETTERS, S_NUMBER: IN_NUMBERS, S_OTHER: IN_OTHER, S_LAST_SPACE: ONE_SPACE, S_LAST_BLANK: ONE_BLANK,
            S_BLANK: IN_BLANKS, S_SHORT: ONE_MORE, S_LONG: TWO_MORE}
    goes_on = {(IN_LETTERS, S_LETTER), (ONE_SPACE, S_LETTER), (IN_NUMBERS, S_NUMBER), (ONE_SPACE, S_NUMBER),
               (IN_OTHER, S_OTHER), (ONE_SPACE, S_OTHER), (IN_BLANKS, S_BLANK)}
    for state in range(9):
        for symbol in range(8):
            if state == TWO_MORE:
                to, mark = ONE_MORE, False
            elif state == ONE_MORE:
                to, mark = START, False
            elif symbol in (S_SHORT, S_LONG) and state in (IN_OTHER, ONE_SPACE):
                to, mark = IN_OTHER, False
            else:
                to, mark = into[symbol], (state, symbol) not in goes_on
            goes[state, symbol], marks[state, symbol] = to, mark
    goes[:, 8:], marks[:, 8:] = goes[START, :8], marks[START, :8]
    return goes.ravel(), marks.ravel()


GOES, MARKS = _compile_marks()


def symbols(codes: np.ndarray, firsts: np.ndarray, classes: np.ndarray) -> np.ndarray:
    """Symbol of each character; ``firsts`` are the positions at which texts begin."""
    kind = classes[codes]
    begins = np.zeros(len(codes) + 3, dtype=bool)
    begins[firsts] = begins[len(codes):] = True
    ahead = np.append(kind[1:], np.uint8(END))
    ahead[begins[1:len(codes) + 1]] = END
    out = np.array([S_LETTER, S_NUMBER, S_BLANK, S_BLANK, S_OTHER], dtype=np.uint8)[kind]
    solid = (ahead == LETTER) | (ahead == NUMBER) | (ahead == OTHER)
    out[(kind == SPACE) & solid] = S_LAST_SPACE
    out[(kind == BLANK) & solid] = S_LAST_BLANK
    marks = np.flatnonzero(codes == ord("'"))
    padded = np.append(codes, np.zeros(2, dtype=codes.dtype))
    one = np.where(begins[marks + 1], 0, padded[marks + 1])
    two = np.where(begins[marks + 1] | begins[marks + 2], 0, padded[marks + 2])
    out[marks[np.isin(one, [ord(c) for c in SHORT])]] = S_SHORT
    long = np.zeros(len(marks), dtype=bool)
    for a, b in LONG:
        long |= (one == ord(a)) & (two == ord(b))
    out[marks[long]] = S_LONG
    out[firsts] += 8
    return out


def word_starts(symbol: np.ndarray) -> np.ndarray:
    """Positions that begin a word.

    Every chunk is read once for all states at a time, which gives its state map; the maps compose
    pairwise in a logarithmic number of steps to the state before each chunk; then the chunks are
    read again from that state, and the marks are taken.
    """
    n = len(symbol)
    rows = -(-n // CHUNK)
    grid = np.zeros(rows * CHUNK, dtype=np.uint8)
    grid[:n] = symbol
    columns = np.ascontiguousarray(grid.reshape(rows, CHUNK).T)
    maps = np.tile(np.arange(9, dtype=np.uint8), (rows, 1))
    for column in columns:
        maps = GOES[maps * np.uint8(16) + column[:, None]]
    step = 1
    while step < rows:
        maps[step:] = np.take_along_axis(maps[step:], maps[:-step].astype(np.intp), axis=1)
        step *= 2
    state = np.concatenate([np.zeros(1, dtype=np.uint8), maps[:-1, START]])
    marked = np.zeros((CHUNK, rows), dtype=bool)
    for j, column in enumerate(columns):
        at = state * np.uint8(16) + column
        marked[j] = MARKS[at]
        state = GOES[at]
    return np.flatnonzero(marked.T.ravel()[:n])


class WordTransducer:
    """Counts the tokens of a word; its states are made when first reached.

    The last token of every prefix of a word decides how it goes on: a token may end here if it
    and the last token before it stay two tokens when merged together. A state therefore holds the
    longest ending that some token begins with, and for each place in it the last token and the
    count relative to now. The transition adds the difference between the counts.
    """

    def __init__(self, merges: list[tuple[str, str]]):
        names = byte_names()
        raw = lambda s: bytes(names[c] for c in s)
        self.merges = merges
        self.rank = {(raw(a), raw(b)): i for i, (a, b) in enumerate(merges)}
        self.tokens = {bytes([b]) for b in range(256)} | {a + b for a, b in self.rank}
        self.begun = {t[:k] for t in self.tokens for k in range(1, len(t))}
        self.apart: dict[tuple[bytes, bytes], bool] = {}
        self.reset()

    def reset(self) -> None:
        self.words: dict[str, int] = {}
        self.states: list[tuple] = [(b"", (None,), (0,))]
        self.known = {self.states[0]: 0}
        self.next: list[dict[int, tuple[int, int]]] = [{}]

    def merged(self, data: bytes) -> list[bytes]:
        """The tokens of a short string by merging, least rank first."""
        parts = [data[i:i + 1] for i in range(len(data))]
        while len(parts) > 1:
            ranks = [self.rank.get(pair, 1 << 30) for pair in zip(parts, parts[1:])]
            best = min(ranks)
            if best == 1 << 30:
                break
            at = ranks.index(best)
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def stay_apart(self, a: bytes, b: bytes) -> bool:
        known = self.apart.get((a, b))
        if known is None:
            known = self.apart[a, b] = self.merged(a + b) == [a, b]
        return known

    def extend(self, state: int, byte: int) -> tuple[int, int]:
        ending, last, count = self.states[state]
        ending += bytes([byte])
        for at in range(len(ending)):
            token = ending[at:]
            if token in self.tokens and (last[at] is None or self.stay_apart(last[at], token)):
                break
        change = count[at] + 1
        keep = next((k for k in range(len(ending)) if ending[k:] in self.begun), len(ending))
        key = (ending[keep:], (*last, token)[keep:], tuple(c - change for c in (*count, change)[keep:]))
        to = self.known.get(key)
        if to is None:
            to = self.known[key] = len(self.states)
            self.states.append(key)
            self.next.append({})
        self.next[state][byte] = (to, change)
        return to, change

    def count(self, word: str) -> int:
        if len(self.words) > MOST_WORDS or len(self.states) > MOST_STATES:
            self.reset()
        if len(self.apart) > MOST_WORDS:
            self.apart.clear()
        state = total = 0
        for byte in word.encode("utf-8"):
            step = self.next[state].get(byte) or self.extend(state, byte)
            state = step[0]
            total += step[1]
        self.words[word] = total
        return total


class TokenCounter:
    """Counts the tokens of lists of texts with a compiled tokenizer."""

    def __init__(self, spec: dict, classes: np.ndarray):
        self.classes, self.transducer = classes, WordTransducer(spec["merges"])
        self.special = re.compile("|".join(map(re.escape, sorted(spec["special"], key=len, reverse=True)))) if spec["special"] else None

    def counts(self, texts: list[str]) -> np.ndarray:
        total = np.zeros(len(texts), dtype=np.int64)
        # special strings are tokens of their own, and split the text
        pieces, owner = [], []
        for i, text in enumerate(texts):
            parts = self.special.split(text) if self.special else [text]
            total[i] += len(parts) - 1
            for part in parts:
                if part:
                    pieces.append(part)
                    owner.append(i)
        at = 0
        while at < len(pieces):
            end, size = at, 0
            while end < len(pieces) and (end == at or size + len(pieces[end]) <= SLICE_CHARS):
                size += len(pieces[end])
                end += 1
            np.add.at(total, owner[at:end], self._piece_counts(pieces[at:end]))
            at = end
        return total

    def _piece_counts(self, pieces: list[str]) -> np.ndarray:
        firsts = np.concatenate([[0], np.cumsum([len(p) for p in pieces])]).astype(np.int64)
        text = "".join(pieces)
        codes = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
        starts = word_starts(symbols(codes, firsts[:-1], self.classes))
        edges = starts.tolist() + [len(text)]
        transducer = self.transducer
        known = transducer.words
        counts = np.empty(len(starts), dtype=np.int64)
        for i, (a, b) in enumerate(zip(edges, edges[1:])):
            word = text[a:b]
            got = known.get(word)
            if got is None:
                got = transducer.count(word)
                known = transducer.words
            counts[i] = got
        return np.add.reduceat(counts, np.searchsorted(starts, firsts[:-1]))


def token_counts(docs: DataFrame, tokenizer: str, id: str = "doc_id", text: str = "text", limit: int = 1024) -> DataFrame:
    """One row per row of ``docs``: id, n_bytes, n_tokens, over_limit (more than ``limit`` tokens).

    Counts are those of the tokenizer's own library without added tokens; special strings inside
    a text count as the one token they are. NULL and empty texts have none. One pass without a
    shuffle; the compiled tables (under 3 MB) are broadcast, so executors need no tokenizer file.
    """
    compiled = docs.sparkSession.sparkContext.broadcast((load_tokenizer(tokenizer), character_classes()))

    def count(batches):
        counter = TokenCounter(*compiled.value)
        for batch in batches:
            texts = batch.column(1)
            for low in range(0, batch.num_rows, 256):
                n = min(256, batch.num_rows - low)
                got = counter.counts(["" if t is None else t for t in texts.slice(low, n).to_pylist()])
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(low, n), batch.column(2).slice(low, n), pa.array(got, pa.int64())], names=["id", "n_bytes", "n_tokens"])

    kind = docs.schema[id].dataType.simpleString()
    rows = docs.select(F.col(id).alias("id"), F.col(text).alias("text"), F.coalesce(F.octet_length(text), F.lit(0)).cast("bigint").alias("n_bytes"))
    return rows.mapInArrow(count, f"id {kind}, n_bytes bigint, n_tokens bigint").select(
        F.col("id").alias(id), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit"))
