"""Toxicity by multiple-instance learning: document labels train sentence scores, joined by noisy-or."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .common import stored, unit_hash
from .wordhash import affix_hashes, text_slices, word_hashes

BITS = 20
#: Labelled documents of each class that are fitted at most: a bounded sample, drawn by a hash of the id.
FIT_PER_CLASS = 4000
#: Bytes of word beginnings and endings that are features beside the word.
AFFIXES = (3, 4, 5, 6, 8)
#: A feature is fitted if its share of documents differs between the classes by so many standard errors.
SCREEN = 4.0
_ENDS = np.zeros(256, dtype=bool)
_ENDS[[ord("."), ord("!"), ord("?"), ord("\n")]] = True


@dataclass(frozen=True)
class SentenceModel:
    """Weights by word hash, a bias, and what a text without a single sentence scores."""
    weights: np.ndarray
    bias: float


def sentences(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
    """(feature, its sentence, document of each sentence, sentence start, sentence end).

    Sentences end after ``.``, ``!``, ``?`` or a line feed, and with the text. Those without a
    word are left out; one whose set of words came before in its text is taken once, at its first
    place. Features are a sentence's distinct words and their affixes. Starts and ends span the
    words, in bytes of ``data``.
    """
    hashes, doc, start, end = word_hashes(data, offsets)
    # a word opens a sentence if its text or the number of sentence ends before it changes
    passed = np.cumsum(_ENDS[data])[start] if len(start) else start
    opens = np.ones(len(start), dtype=bool)
    opens[1:] = (doc[1:] != doc[:-1]) | (passed[1:] != passed[:-1])
    first = np.flatnonzero(opens)
    last = np.append(first[1:], len(start))[:len(first)] - 1
    sentence = np.cumsum(opens) - 1
    order = np.lexsort((hashes, sentence))
    once = np.ones(len(order), dtype=bool)
    once[1:] = (hashes[order][1:] != hashes[order][:-1]) | (sentence[order][1:] != sentence[order][:-1])
    word = order[once]
    name = np.add.reduceat(hashes[word], np.searchsorted(sentence[word], np.arange(len(first)))) if len(first) else hashes
    by_name = np.lexsort((np.arange(len(first)), name, doc[first]))
    fresh = np.ones(len(first), dtype=bool)
    fresh[1:] = (name[by_name][1:] != name[by_name][:-1]) | (doc[first][by_name][1:] != doc[first][by_name][:-1])
    kept = np.zeros(len(first), dtype=bool)
    kept[by_name[fresh]] = True
    word = word[kept[sentence[word]]]
    place = np.cumsum(kept) - 1
    affix, owner = affix_hashes(data, start[word], end[word], AFFIXES)
    feature = np.concatenate([hashes[word], affix])
    at = place[sentence[word]] if len(word) else word
    return ((feature >> np.uint64(64 - BITS)).astype(np.int64), np.concatenate([at, at[owner]]), doc[first][kept], start[first][kept], end[last][kept])


def _score_sentences(model: SentenceModel, bucket: np.ndarray, sentence: np.ndarray, n: int) -> np.ndarray:
    """Probability of each sentence: the logistic of the bias and the weights of its words."""
    z = np.bincount(sentence, model.weights[bucket], n) + model.bias
    return 1 / (1 + np.exp(-np.clip(z, -30, 30)))


def _noisy_or(p: np.ndarray, doc: np.ndarray, n_docs: int) -> np.ndarray:
    """One minus the chance that no sentence of the document is positive."""
    return -np.expm1(np.bincount(doc, np.log1p(-np.clip(p, 0, 1 - 1e-12)), n_docs))


def fit(feature: np.ndarray, sentence: np.ndarray, doc: np.ndarray, y: np.ndarray, weight: np.ndarray,
        rounds: int = 200, rate: float = 0.1, spread: float = 4.0) -> SentenceModel:
    """Adam on the noisy-or likelihood of the document labels; weights have a normal prior of variance ``spread``.

    The bias starts low: a sentence is clean until its words say otherwise.
    """
    names, column = np.unique(feature, return_inverse=True)
    theta = np.zeros(len(names) + 1)
    theta[-1] = -6.0
    m, v = np.zeros_like(theta), np.zeros_like(theta)
    n, total = len(y), weight.sum()
    for t in range(1, rounds + 1):
        z = np.clip(np.bincount(sentence, theta[:-1][column], len(doc)) + theta[-1], -30, 30)
        p = 1 / (1 + np.exp(-z))
        none = np.maximum(np.bincount(doc, np.logaddexp(0, z), n), 1e-9)
        pull = np.where(y == 1, -1 / np.expm1(np.minimum(none, 50)), 1.0) * weight / total
        by_sentence = pull[doc] * p
        gradient = np.append(np.bincount(column, by_sentence[sentence], len(names)), by_sentence.sum())
        gradient[:-1] += theta[:-1] / (spread * total)
        m, v = 0.9 * m + 0.1 * gradient, 0.999 * v + 0.001 * gradient ** 2
        theta -= rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-9)
    weights = np.zeros(1 << BITS)
    weights[names] = theta[:-1]
    return SentenceModel(weights, float(theta[-1]))


def _document_counts(batches):
    """(feature, documents of label 0, of label 1) over a partition."""
    counts = np.zeros((2, 1 << BITS), dtype=np.int64)
    for batch in batches:
        labels = np.array(batch.column(0))
        for first, data, offsets in text_slices(batch.column(1)):
            feature, sentence, doc, _, _ = sentences(data, offsets)
            pairs = np.unique((doc[sentence] << BITS) + feature) if len(feature) else feature
            for label in (0, 1):
                counts[label] += np.bincount(pairs[labels[first + (pairs >> BITS)] == label] & ((1 << BITS) - 1), minlength=1 << BITS)
    seen = np.flatnonzero(counts.any(axis=0))
    yield pa.RecordBatch.from_arrays([pa.array(seen, pa.int64()), pa.array(counts[0, seen]), pa.array(counts[1, seen])], names=["feature", "n0", "n1"])


def _kept_features(keep: np.ndarray):
    """(label, features, sentence of each, number of sentences) per document, of the screened features."""
    def read(batches):
        usable = np.zeros(1 << BITS, dtype=bool)
        usable[keep] = True
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                n = len(offsets) - 1
                feature, sentence, doc, _, _ = sentences(data, offsets)
                count = np.bincount(doc, minlength=n)
                base = np.cumsum(count) - count
                mine = np.flatnonzero(usable[feature])
                mine = mine[np.argsort(sentence[mine], kind="stable")]
                owner = doc[sentence[mine]] if len(mine) else mine
                edge = np.searchsorted(owner, np.arange(n + 1))
                lists = lambda x: pa.array([x[a:b].astype(np.int32) for a, b in zip(edge, edge[1:])], pa.list_(pa.int32()))
                yield pa.RecordBatch.from_arrays([batch.column(0).slice(first, n), lists(feature[mine]),
                                                  lists(sentence[mine] - base[owner]), pa.array(count, pa.int64())], names=["label", "feature", "sentence", "n"])
    return read


def held_out(id: Column) -> Column:
    """Rows never used for learning."""
    return F.coalesce(F.pmod(F.crc32(id.cast("string")), F.lit(3)) == 1, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id: str = "doc_id", text: str = "text", label: str = "toxic",
          per_class: int = FIT_PER_CLASS) -> SentenceModel:
    """Fit on at most ``per_class`` labelled documents of each class that are not held out.

    Documents labelled twice count once, with the higher label; NULL labels and ids do not count.
    Features whose document shares differ too little between the classes are screened out. The
    classes are weighted back to their shares of all labels. With one class only, nothing can
    be learnt: every sentence then scores that class's share.
    """
    known = labels.where(F.col(id).isNotNull() & F.col(label).isNotNull() & ~held_out(F.col(id))).groupBy(id).agg(F.max(label).alias("label"))
    share = {r["label"]: r["n"] for r in known.where("label IN (0, 1)").groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(share) < 2:
        return SentenceModel(np.zeros(1 << BITS), 6.0 if share.get(1) else -6.0)
    picks = [known.where(F.col("label") == c).orderBy(unit_hash(F.col(id)), id).limit(per_class) for c in (0, 1)]
    sample = picks[0].unionByName(picks[1])
    # at most two times per_class rows: of rows with one id, the least text counts
    drawn = stored(docs.select(F.col(id), F.col(text)).join(F.broadcast(sample), id).groupBy(id, "label").agg(F.min(text).alias("text")).select("label", "text"))
    size = {r["label"]: r["n"] for r in drawn.groupBy("label").agg(F.count("*").alias("n")).collect()}
    if len(size) < 2:
        return SentenceModel(np.zeros(1 << BITS), -6.0)
    n0, n1 = (F.lit(float(size[c])) for c in (0, 1))
    counts = drawn.mapInArrow(_document_counts, "feature bigint, n0 bigint, n1 bigint").groupBy("feature").agg(F.sum("n0").alias("n0"), F.sum("n1").alias("n1"))
    pooled = (F.col("n0") + F.col("n1") + 1) / (n0 + n1 + 2)
    error = (F.col("n1") / n1 - F.col("n0") / n0) / F.sqrt(pooled * (1 - pooled) * (1 / n0 + 1 / n1))
    # at most 2 ** BITS numbers
    keep = np.array([r["feature"] for r in counts.where(F.abs(error) >= SCREEN).orderBy("feature").collect()], dtype=np.int64)
    fitted = drawn.mapInArrow(_kept_features(keep), "label int, feature array<int>, sentence array<int>, n bigint").toArrow()
    y = np.array(fitted["label"].to_pylist(), dtype=np.int64)
    n = np.array(fitted["n"].to_pylist(), dtype=np.int64)
    base = np.cumsum(n) - n
    feature = np.concatenate([np.asarray(f.values) for f in fitted["feature"]]).astype(np.int64)
    sentence = np.concatenate([np.asarray(s.values) + b for s, b in zip(fitted["sentence"], base)]).astype(np.int64)
    weight = np.where(y == 1, share[1] / size[1], share[0] / size[0])
    return fit(feature, sentence, np.repeat(np.arange(len(y)), n), y, weight)


def score(docs: DataFrame, model: SentenceModel, id: str = "doc_id", text: str = "text", at_least: float = 0.5) -> DataFrame:
    """One row per row of ``docs``: id, score, n_sentences, offending (start, end, score).

    ``offending`` holds the sentences that score ``at_least``, in code points, end exclusive. NULL
    and empty texts, and texts without a word, score as one empty sentence and offend nowhere.
    One pass without a shuffle; the weights (8 MB) are broadcast.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batches):
        model = shared.value
        blank = float(_score_sentences(model, np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64), 1)[0])
        for batch in batches:
            for first, data, offsets in text_slices(batch.column(1)):
                n = len(offsets) - 1
                bucket, sentence, doc, start, end = sentences(data, offsets)
                p = _score_sentences(model, bucket, sentence, len(doc))
                count = np.bincount(doc, minlength=n)
                total = np.where(count > 0, _noisy_or(p, doc, n), blank)
                hits = np.flatnonzero(p >= at_least)
                place = np.concatenate([[0], np.cumsum((data & 0xC0) != 0x80)])
                spans: list[list] = [[] for _ in range(n)]
                for h in hits:
                    d, zero = doc[h], place[offsets[doc[h]]]
                    spans[d].append({"start": int(place[start[h]] - zero), "end": int(place[end[h]] - zero), "score": float(p[h])})
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, n), pa.array(total, pa.float64()), pa.array(count, pa.int64()),
                    pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())])))],
                    names=["id", "score", "n_sentences", "offending"])

    kind = docs.schema[id].dataType.simpleString()
    out = docs.select(F.col(id).alias("id"), F.col(text).alias("text")).mapInArrow(
        run, f"id {kind}, score double, n_sentences bigint, offending array<struct<start:bigint,end:bigint,score:double>>")
    return out.withColumnRenamed("id", id)


def without_toxic(docs: DataFrame, model: SentenceModel, text: str = "text", threshold: float = 0.7) -> DataFrame:
    """``docs`` without the rows that score ``threshold`` or more, columns as given.

    The score is computed beside the row it belongs to, so nothing is joined or shuffled.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)
    at = docs.columns.index(text)

    def run(batches):
        model = shared.value
        for batch in batches:
            keep = np.ones(batch.num_rows, dtype=bool)
            for first, data, offsets in text_slices(batch.column(at)):
                bucket, sentence, doc, _, _ = sentences(data, offsets)
                total = _noisy_or(_score_sentences(model, bucket, sentence, len(doc)), doc, len(offsets) - 1)
                keep[first:first + len(offsets) - 1] = total < threshold
            yield batch.filter(pa.array(keep))

    return docs.mapInArrow(run, docs.schema)
