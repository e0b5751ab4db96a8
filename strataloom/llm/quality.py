"""Quality classifier: heuristic labellers, their accuracies by expectation-maximisation, a hashed linear scorer."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from .common import ROW_KEY, keyed, stored, unit_hash
from .wordhash import text_slices, word_hashes

BITS = 18
#: Documents that the scorer is fitted on at most: a bounded sample, drawn by a hash of the row key.
FIT_ROWS = 6000
#: Words up to which distinct words are held against all words.
FULL_WORDS = 2000
#: Common words of the languages at hand.
STOP_WORDS = ("the of and to in a is that it for was on as with be by he at from are this have not or "
              "de la le les des et en un une du que qui dans pour par sur au aux avec est pas "
              "der die das und zu den von mit sich ist im dem nicht ein eine auch auf "
              "el los las y por con para una del se no al lo como su").split()
_KIND = np.zeros(256, dtype=np.int8)
_KIND[[*range(48, 58)]] = 1
_KIND[[c for c in range(33, 127) if not chr(c).isalnum()]] = 2


def _stop_hashes() -> np.ndarray:
    data = " ".join(STOP_WORDS).encode()
    return np.unique(word_hashes(np.frombuffer(data, dtype=np.uint8), np.array([0, len(data)]))[0])


def votes(data: np.ndarray, offsets: np.ndarray, stops: np.ndarray) -> np.ndarray:
    """One row per text and one column per labeller: 1 good, 0 bad, -1 no opinion.

    The labellers look at length, mean word length, stop words, symbols, digits, repeated words and
    repeated lines. All but the first are silent on texts of fewer than ten words. Repeated words are
    judged at every length, by the distinct words over the words or, in long texts, over their scaled root.
    """
    n = len(offsets) - 1
    hashes, doc, start, end = word_hashes(data, offsets)
    count = np.bincount(doc, minlength=n)
    some = np.maximum(count, 1)
    length = np.bincount(doc, end - start, n) / some
    stop = np.bincount(doc, np.isin(hashes, stops), n) / some
    size = np.maximum(np.diff(offsets), 1)
    owner = np.repeat(np.arange(n), np.diff(offsets))
    kind = _KIND[data]
    symbols, digits = np.bincount(owner, kind == 2, n) / size, np.bincount(owner, kind == 1, n) / size
    # distinct words grow about as the root of the length: past FULL_WORDS words the share is taken of that
    scale = np.sqrt(some * np.minimum(some, FULL_WORDS))
    distinct = np.bincount(np.unique(np.stack([doc, hashes.view(np.int64)]), axis=1)[0], minlength=n) / scale if len(doc) else np.zeros(n)
    # a line is named by the sum of its words' hashes
    line = np.cumsum(data == 10)[start] if len(start) else start
    opens = np.ones(len(doc), dtype=bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (line[1:] != line[:-1])
    first = np.flatnonzero(opens)
    lines = np.add.reduceat(hashes, first) if len(first) else hashes
    n_lines = np.bincount(doc[first], minlength=n) if len(first) else np.zeros(n, dtype=np.int64)
    own_lines = np.bincount(np.unique(np.stack([doc[first], lines.view(np.int64)]), axis=1)[0], minlength=n) if len(first) else n_lines
    fresh = own_lines / np.maximum(n_lines, 1)

    def vote(good, bad, able):
        return np.where(able & good, 1, np.where(able & bad, 0, -1))

    able = count >= 10
    every = np.ones(n, dtype=bool)
    return np.stack([
        vote(count >= 30, count < 12, every),
        vote((length >= 3) & (length <= 8), (length < 2.5) | (length > 11), able),
        vote(stop >= 0.12, stop < 0.05, able),
        vote(symbols <= 0.06, symbols > 0.12, able),
        vote(digits <= 0.02, digits > 0.15, able),
        vote(distinct >= 0.25, distinct < 0.15, able),
        vote(fresh >= 0.9, fresh < 0.6, able & (n_lines >= 3)),
    ], axis=1).astype(np.int8)


@dataclass(frozen=True)
class VoteModel:
    """Prior of a good document, and of each labeller the chances of a good vote on good and on bad ones."""
    prior: float
    hit: np.ndarray
    false: np.ndarray

    def posterior(self, patterns: np.ndarray) -> np.ndarray:
        """Chance that a document with these votes is good, labellers taken as independent given the truth."""
        cast, up = patterns >= 0, patterns == 1
        good = np.where(cast, np.where(up, np.log(self.hit), np.log1p(-self.hit)), 0).sum(axis=1) + np.log(self.prior)
        bad = np.where(cast, np.where(up, np.log(self.false), np.log1p(-self.false)), 0).sum(axis=1) + np.log1p(-self.prior)
        return 1 / (1 + np.exp(np.clip(bad - good, -50, 50)))


def fit_votes(patterns: np.ndarray, counts: np.ndarray, rounds: int = 200) -> VoteModel:
    """Expectation-maximisation over the distinct vote patterns; it starts from labellers that
    seldom fault good documents and each see some faults only, and keeps a prior worth 2 % of the rows on that."""
    k = patterns.shape[1]
    model = VoteModel(0.85, np.full(k, 0.97), np.full(k, 0.7))
    cast, up = patterns >= 0, patterns == 1
    prior = 0.02 * counts.sum() + 1
    for _ in range(rounds):
        q = model.posterior(patterns)
        good, bad = counts * q, counts * (1 - q)
        rate = lambda w, start: ((w[:, None] * up).sum(axis=0) + prior * start) / ((w[:, None] * cast).sum(axis=0) + prior)
        model = VoteModel(float(np.clip((good.sum() + 1) / (counts.sum() + 2), 1e-3, 1 - 1e-3)),
                          np.clip(rate(good, 0.97), 1e-3, 1 - 1e-3), np.clip(rate(bad, 0.7), 1e-3, 1 - 1e-3))
    return model


def _buckets(hashes: np.ndarray, doc: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(document, bucket, value) of the hashed word features, each document scaled to length one."""
    size = 1 << BITS
    key, times = np.unique(doc * size + (hashes >> np.uint64(64 - BITS)).astype(np.int64), return_counts=True)
    owner, value = key // size, np.log1p(times)
    norm = np.sqrt(np.bincount(owner, value ** 2, n))
    return owner, key % size, value / np.maximum(norm[owner], 1e-9)


def fit_scorer(owner: np.ndarray, bucket: np.ndarray, value: np.ndarray, target: np.ndarray, rounds: int = 80, rate: float = 0.1,
               ridge: float = 1e-5) -> np.ndarray:
    """Logistic regression on posterior labels by Adam; the bias is the last weight."""
    names, column = np.unique(bucket, return_inverse=True)
    theta = np.zeros(len(names) + 1)
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    for t in range(1, rounds + 1):
        z = np.bincount(owner, theta[:-1][column] * value, len(target)) + theta[-1]
        error = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - target) / max(len(target), 1)
        gradient = np.append(np.bincount(column, error[owner] * value, len(names)) + ridge * theta[:-1], error.sum())
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    weights = np.zeros((1 << BITS) + 1)
    weights[names], weights[-1] = theta[:-1], theta[-1]
    return weights


def quality(docs: DataFrame, id: str = "doc_id", text: str = "text", fit_rows: int = FIT_ROWS, threshold: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: id, votes, posterior, score, good.

    ``votes`` are those of the labellers, ``posterior`` what the fitted label model makes of them,
    ``score`` the hashed linear scorer trained on posteriors, ``good`` whether the mean of both is at
    least ``threshold``. Labeller statistics cover all rows: they are counted per vote pattern, of
    which there are at most 3 ** 7. NULL and empty texts get a low vote for length and no word
    features; they and repeated rows are judged like any row. An empty table gives no rows.
    """
    stops = _stop_hashes()
    rows = keyed(docs.select(id, text), id, text)
    kind = rows.schema[id].dataType.simpleString()
    key_kind = rows.schema[ROW_KEY[0]].dataType.simpleString()

    def vote(batches):
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(2)):
                cast = votes(data, offsets, stops)
                n = len(cast)
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), batch.column(1).slice(first, n),
                                                  pa.array(list(cast), pa.list_(pa.int8()))], names=[*ROW_KEY, "votes"])

    cast = stored(rows.select(*ROW_KEY, text).mapInArrow(vote, f"{ROW_KEY[0]} {key_kind}, {ROW_KEY[1]} bigint, votes array<tinyint>"))
    counted = cast.groupBy("votes").agg(F.count("*").alias("n")).orderBy("votes").collect()  # at most 3 ** 7 patterns
    if not counted:
        return rows.select(id, F.array().cast("array<int>").alias("votes"), F.lit(0.0).alias("posterior"), F.lit(0.0).alias("score"), F.lit(False).alias("good"))
    model = fit_votes(np.array([r["votes"] for r in counted]), np.array([r["n"] for r in counted], dtype=np.float64))
    drawn = cast.select(*ROW_KEY, "votes").orderBy(unit_hash(*[F.col(k) for k in ROW_KEY]), *ROW_KEY).limit(fit_rows)
    chosen = rows.select(*ROW_KEY, text).join(F.broadcast(drawn.dropDuplicates(ROW_KEY)), ROW_KEY).dropDuplicates(ROW_KEY).select("votes", text)

    def features(batches):
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                n = len(offsets) - 1
                hashes, doc, _, _ = word_hashes(data, offsets)
                owner, bucket, value = _buckets(hashes, doc, n)
                edge = np.searchsorted(owner, np.arange(n + 1))
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.array([bucket[a:b].astype(np.int32) for a, b in zip(edge, edge[1:])], pa.list_(pa.int32())),
                    pa.array([value[a:b].astype(np.float32) for a, b in zip(edge, edge[1:])], pa.list_(pa.float32()))], names=["votes", "bucket", "value"])

    fitted = chosen.mapInArrow(features, "votes array<tinyint>, bucket array<int>, value array<float>").toArrow()
    target = model.posterior(np.array(fitted["votes"].to_pylist(), dtype=np.int64).reshape(-1, len(counted[0]["votes"])))
    buckets = [np.asarray(b.values) for b in fitted["bucket"]]
    weights = fit_scorer(np.repeat(np.arange(len(target)), [len(b) for b in buckets]), np.concatenate(buckets),
                         np.concatenate([np.asarray(v.values) for v in fitted["value"]]).astype(np.float64), target)
    shared = docs.sparkSession.sparkContext.broadcast((model, weights))

    def score(batches):
        model, weights = shared.value
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                n = len(offsets) - 1
                hashes, doc, _, _ = word_hashes(data, offsets)
                owner, bucket, value = _buckets(hashes, doc, n)
                cast = votes(data, offsets, stops)
                z = np.bincount(owner, weights[bucket] * value, n) + weights[-1]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.array(list(cast.astype(np.int32)), pa.list_(pa.int32())),
                    pa.array(model.posterior(cast.astype(np.int64)), pa.float64()), pa.array(1 / (1 + np.exp(-np.clip(z, -30, 30))), pa.float64())],
                    names=["id", "votes", "posterior", "score"])

    scored = rows.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(score, f"id {kind}, votes array<int>, posterior double, score double")
    return scored.select(F.col("id").alias(id), "votes", "posterior", "score", ((F.col("posterior") + F.col("score")) / 2 >= threshold).alias("good"))
