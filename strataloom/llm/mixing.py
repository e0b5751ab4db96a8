"""Source mixing: token weights raked to source, language and topic marginals, then a calibrated sample."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import let, maybe_broadcast, stored, unit_hash

#: Groups of initial letters that stand for a topic where a table has no topic column.
INITIALS = ("abcd", "efgh", "ijkl", "mnop", "qrst", "uvwxyz")
MARGINS = ("source", "lang", "topic")
#: Cells (about 100 bytes each) up to which the rates are broadcast to the documents.
BROADCAST_CELLS = 200_000


def token_weight(text: Column) -> Column:
    """Estimated tokens: one per four bytes, rounded up."""
    return F.floor((F.coalesce(F.octet_length(text), F.lit(0)) + 3) / 4).cast("bigint")


def initial_topic(text: Column) -> Column:
    """The group of initial letters that most words of a text begin with, the first of equals."""
    initials = F.array_join(F.transform(F.split(F.coalesce(text, F.lit("")), " "), lambda w: F.substring(w, 1, 1)), "")
    counts = lambda s: F.array(*[F.length(s) - F.length(F.translate(s, g, "")) for g in INITIALS])
    return let(initials, lambda s: let(counts(s), lambda c: F.concat(F.lit("t"), F.array_position(c, F.array_max(c)).cast("string"))))


def label_cells(docs: DataFrame, text: str, source: str, lang: str, topic: Column | None = None) -> DataFrame:
    """Adds ``__source``, ``__lang``, ``__topic`` (NULL becomes empty) and ``__tokens``."""
    named = lambda c: F.coalesce(c.cast("string"), F.lit(""))
    return docs.withColumns({
        "__source": named(F.col(source)), "__lang": named(F.col(lang)),
        "__topic": named(topic if topic is not None else initial_topic(F.col(text))), "__tokens": token_weight(F.col(text))})


def tempered_targets(cells: DataFrame, margin: str, power: float) -> DataFrame:
    """Target share of each value of a margin: its token share to ``power``, scaled to sum to one."""
    sums = cells.groupBy(margin).agg(F.sum("tokens").alias("t"))
    shares = sums.withColumn("share", F.pow(F.col("t").cast("double"), F.lit(power)))
    total = shares.agg(F.sum("share").alias("all"))
    return shares.crossJoin(F.broadcast(total)).select(margin, F.when(F.col("all") > 0, F.col("share") / F.col("all")).otherwise(0.0).alias("target"))


def rake(cells: DataFrame, targets: dict[str, DataFrame], rounds: int = 8, stride: int = 4) -> DataFrame:
    """Iterative proportional fitting: ``rounds`` times, scale the weights to each margin in turn.

    ``cells`` has the margins and a start weight ``w``; it holds one row per combination of
    margin values, so its size follows the number of sources and not that of the documents.
    Values without a target get weight 0. The plan is cut every ``stride`` rounds.
    """
    for margin, target in targets.items():
        cells = cells.join(target.select(margin, F.col("target").alias(f"__to_{margin}")), margin, "left")
    for done in range(1, rounds + 1):
        for margin in targets:
            now = F.sum("w").over(W.partitionBy(margin))
            cells = cells.withColumn("w", F.coalesce(F.try_divide(F.col("w") * F.col(f"__to_{margin}"), now), F.lit(0.0)))
        if done % stride == 0 or done == rounds:
            cells = stored(cells)
    return cells.drop(*[f"__to_{m}" for m in targets])


def mixing_rates(docs: DataFrame, text: str = "text", source: str = "source", lang: str = "lang",
                 topic: Column | None = None, powers: Sequence[float] = (0.5, 0.5, 0.0), budget_share: float = 0.5,
                 targets: dict[str, DataFrame] | None = None, rounds: int = 8) -> DataFrame:
    """(source, lang, topic, tokens, w, rate) per cell: raked weight and expected copies of its documents.

    The budget is ``budget_share`` of all tokens; a cell's rate is budget * w / tokens, so the
    expected tokens of every margin value are its target share of the budget.
    """
    marked = label_cells(docs, text, source, lang, topic)
    cells = stored(marked.groupBy(*[F.col(f"__{m}").alias(m) for m in MARGINS]).agg(F.sum("__tokens").alias("tokens"))).where("tokens > 0")
    total = cells.agg(F.sum("tokens")).first()[0] or 0
    goals = targets or {m: stored(tempered_targets(cells, m, p)) for m, p in zip(MARGINS, powers, strict=True)}
    raked = rake(cells.withColumn("w", F.col("tokens") / F.lit(float(total or 1))), goals, rounds)
    return raked.withColumn("rate", F.col("w") * F.lit(budget_share * total) / F.col("tokens"))


def mix(docs: DataFrame, rates: DataFrame, id: str = "doc_id", text: str = "text", source: str = "source",
        lang: str = "lang", topic: Column | None = None, broadcast_cells: int = BROADCAST_CELLS) -> DataFrame:
    """``docs`` with ``tokens``, ``topic``, ``rate`` and ``copies`` (columns of these names are replaced).

    ``copies`` is the whole part of the rate, plus one with the probability of the rest, drawn by
    a hash of the id: repeatable, and the same for repeated rows. Rows without text have no
    tokens and rate 0. NULL sources and languages are values of their own. The rates join as a
    broadcast while their count allows; beyond that adaptive execution splits the hot cells.
    """
    marked = label_cells(docs, text, source, lang, topic)
    known = rates.select(*[F.col(m).alias(f"__{m}") for m in MARGINS], F.col("rate").alias("__rate"))
    joined = marked.join(maybe_broadcast(known, rates.count(), broadcast_cells), [f"__{m}" for m in MARGINS], "left")
    rate = F.when(F.col("__tokens") > 0, F.coalesce("__rate", F.lit(0.0))).otherwise(0.0)
    whole = F.floor(rate)
    copies = (whole + F.when(unit_hash(F.col(id)) < rate - whole, 1).otherwise(0)).cast("bigint")
    kept = [c for c in docs.columns if c not in ("tokens", "topic", "rate", "copies")]
    return joined.select(*kept, F.col("__tokens").alias("tokens"), F.col("__topic").alias("topic"), rate.alias("rate"), copies.alias("copies"))
