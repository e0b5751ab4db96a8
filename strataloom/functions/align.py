"""Global alignment identity of two texts, for use inside tasks."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import functions as F, types as T

#: Score of a match, a mismatch, a gap's first letter and each further one.
MATCH, MISMATCH, GAP_OPEN, GAP_EXTEND = 10, 0, -10, -1  # in tenths
#: Cells of an anti-diagonal that are filled at once, over all pairs of a batch.
CELLS = 16384


def aligned_matches(pairs: list[tuple[str, str]]) -> np.ndarray:
    """Matches on a best global alignment with affine gaps, the most among equally good ones, of every pair.

    Pairs of similar lengths are aligned side by side, as many as fill ``CELLS``; memory grows with
    the shorter text of one pair only.
    """
    pairs = [(a, b) if len(a) <= len(b) else (b, a) for a, b in pairs]
    out = np.zeros(len(pairs), dtype=np.int64)
    # a batch costs what its longest texts do
    order = sorted(range(len(pairs)), key=lambda k: (len(pairs[k][0]) // 16, len(pairs[k][1])))
    while order:
        size = min(len(order), max(1, CELLS // (len(pairs[order[-1]][0]) + 1)))
        batch, order = order[-size:], order[:-size]
        out[batch] = _matches([pairs[k] for k in batch])
    return out


def _letters(texts: list[str], length: int) -> np.ndarray:
    """A column of code points per text, filled up to ``length``."""
    out = np.zeros((length, len(texts)), dtype=np.uint32)
    for k, text in enumerate(texts):
        out[:len(text), k] = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    return out


def _matches(pairs: list[tuple[str, str]]) -> np.ndarray:
    """``aligned_matches`` of (shorter, longer) pairs in one batch.

    Scores are kept in tenths, with the match count as tie break in the low digits, and the tables are
    filled one anti-diagonal at a time. Cell (i, j) holds its score less i + j extensions, so that only
    the first letter of a gap costs anything; cells past the end of a text are of no use to those before.
    """
    sizes = np.array([(len(a), len(b)) for a, b in pairs])
    n, m = (int(s) for s in sizes.max(axis=0))
    base = 1 << n.bit_length()  # above any match count, so that scores compare first
    match, mismatch = (MATCH - 2 * GAP_EXTEND) * base + 1, (MISMATCH - 2 * GAP_EXTEND) * base
    kind, low = (np.int32, -(1 << 30)) if match * (n + 8) < 1 << 30 else (np.int64, -(1 << 61))
    match, mismatch, start = kind(match), kind(mismatch), kind((GAP_OPEN - GAP_EXTEND) * base)
    x, y = _letters([a for a, _ in pairs], n), _letters([b for _, b in pairs], m)[::-1]
    # row i of each array is the cell with i letters of the shorter text on the current anti-diagonal
    shape = (n + 1, len(pairs))
    best = [np.full(shape, low, dtype=kind) for _ in range(3)]
    downs, side, gap = [np.full(shape, low, dtype=kind) for _ in range(2)], np.full(shape, low, dtype=kind), np.empty(shape, dtype=kind)
    best[0][0] = 0
    out = np.zeros(len(pairs), dtype=np.int64)
    ends: dict[int, list[int]] = {}
    for k, (a, b) in enumerate(pairs):
        ends.setdefault(len(a) + len(b), []).append(k)
    for d in range(1, n + m + 1):
        last, before, new = best[(d - 1) % 3], best[(d - 2) % 3], best[d % 3]
        above, down = downs[(d - 1) % 2], downs[d % 2]
        lo, hi = max(0, d - m), min(n, d)
        p, q = max(lo, 1), min(hi, d - 1)
        # cells p..hi have a letter of the shorter text to put against a gap, cells lo..q one of the longer
        first, final = max(lo - 1, 0), max(hi - 1, q)
        np.add(last[first:final + 1], start, out=gap[first:final + 1])
        np.maximum(gap[p - 1:hi], above[p - 1:hi], out=down[p:hi + 1])
        np.maximum(gap[lo:q + 1], side[lo:q + 1], out=side[lo:q + 1])
        if lo == 0:
            down[0] = low
        if hi == d:
            side[d] = low
        np.maximum(down[lo:hi + 1], side[lo:hi + 1], out=new[lo:hi + 1])
        if p <= q:
            paired = np.where(x[p - 1:q] == y[m - d + p:m - d + q + 1], match, mismatch)
            paired += before[p - 1:q]
            np.maximum(new[p:q + 1], paired, out=new[p:q + 1])
        for k in ends.get(d, ()):
            out[k] = int(new[sizes[k, 0], k]) % base
    return out


def identities(left, right) -> np.ndarray:
    """``sequence_identity`` of many pairs, NaN where a text is missing."""
    out, hard = np.full(len(left), np.nan), []
    for k, (a, b) in enumerate(zip(left, right)):
        if a is None or b is None:
            continue
        out[k] = float(a == b) if a and b else 0.0
        if a and b and a != b:
            hard.append((k, a, b))
    if hard:
        out[[k for k, _, _ in hard]] = aligned_matches([(a, b) for _, a, b in hard]) / [max(len(a), len(b)) for _, a, b in hard]
    return out


def sequence_identity(a: str | None, b: str | None) -> float | None:
    return None if a is None or b is None else float(identities([a], [b])[0])


@F.pandas_udf(T.DoubleType())
def identity(left: pd.Series, right: pd.Series) -> pd.Series:
    """Matches on the best global alignment over the longer length; NULL in, NULL out."""
    return pd.Series(identities(left, right))
