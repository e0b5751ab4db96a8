"""Line deduplication: an exact set-similarity self-join of lines, later matches removed."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from .common import ROW_KEY, keyed, let, maybe_broadcast, stored

THRESHOLD, LEAST_TOKENS = 0.8, 1
#: Fixed value: what separates the tokens of a line.
APART = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
#: Buckets of the frequency table, one byte each. Its size does not follow the data.
BUCKETS = 1 << 18
#: Lines (about 40 bytes each) up to which a set of them is broadcast; larger sets are joined by shuffle.
BROADCAST_ROWS = 1_000_000
#: Parts in which the token space is worked off.
PASSES = 2
LINE = [*ROW_KEY, "line"]


def line_tokens(line: Column) -> Column:
    """Distinct lower-cased tokens of a line."""
    return F.array_distinct(F.array_remove(F.split(F.lower(line), APART), ""))


def _bucket(h: Column) -> Column:
    return h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int")


def token_table(docs: DataFrame, text: str) -> DataFrame:
    """A row for each line: what its token set is known by, its size and bitmap, and ``tokens``, 31-bit numbers of its tokens.

    Every line is split and hashed here, once. Sets are told apart by 128 bits over 64-bit hashes; tokens that share a
    31-bit number only meet more often, as pairs are verified on the lines themselves.
    """
    # after the lines are exploded, so that arrays of numbers are made distinct and sorted by generated code
    lines = _lines(docs, text).select(*LINE, _ordered(F.col("content")).alias("hashes"))
    numbers = lines.select(*LINE, "hashes", _numbers(F.col("hashes")).alias("tokens"))
    return stored(numbers.select(
        *LINE, F.xxhash64("hashes").alias("set_a"), F.xxhash64(F.lit(7), "hashes").alias("set_b"), F.size("tokens").alias("n"),
        _bitmap(F.col("tokens"), 0).alias("low"), _bitmap(F.col("tokens"), 1).alias("high"), "tokens"))


def rarity_table(lines: DataFrame) -> DataFrame:
    """One row, ``__levels``: the level of each bucket of token numbers: how many lines hold its tokens, on a log scale.

    Tokens that share a bucket share a level, which only makes the order coarser: any order gives
    exact results, a good one gives short lists.
    """
    counts = lines.select(F.explode("tokens").alias("t")).groupBy(_bucket(F.col("t")).alias("b")).agg(F.count("*").alias("n"))
    level = F.coalesce(F.least(F.lit(127), F.floor(F.log2("n") * 4)).cast("int"), F.lit(0))
    every = lines.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("b")).join(counts, "b", "left").select("b", level.alias("l"))
    # BUCKETS numbers, one byte each
    return stored(every.agg(F.transform(F.array_sort(F.collect_list(F.struct("b", "l"))), lambda x: x["l"].cast("tinyint")).alias("__levels")))


def _ordered(line: Column, levels: Column | None = None) -> Column:
    """The token set of a line as sorted 64-bit hashes; with ``levels`` as numbers, rarest first."""
    # every token is hashed once; empty ones go by their hash
    hashes = F.array_remove(F.transform(F.split(F.lower(line), APART), lambda t: F.xxhash64(t)), F.xxhash64(F.lit("")))
    found = F.sort_array(F.array_distinct(hashes))
    return found if levels is None else _rarest_first(_numbers(found), levels)


def _numbers(hashes: Column) -> Column:
    return F.transform(hashes, lambda h: h.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))


def _rarest_first(tokens: Column, levels: Column) -> Column:
    """Token numbers in order: level in the upper byte, number below it."""
    # none can be NULL, so that they are sorted as numbers, not as objects
    return F.sort_array(let(levels, lambda found: F.transform(tokens, lambda t: F.shiftleft(
        F.coalesce(F.get(found, _bucket(t)).cast("bigint"), F.lit(0).cast("bigint")), 56).bitwiseOR(t.cast("bigint")))))


def _lines(docs: DataFrame, text: str) -> DataFrame:
    return docs.select(*ROW_KEY, F.posexplode(F.split(F.col(text), "\n", -1)).alias("line", "content"))


def _place(of: str = "") -> Column:
    return F.struct(*[F.col(f"{of}{c}").alias(c) for c in LINE])


def _bitmap(tokens: Column, half: int) -> Column:
    """Half of 128 bits, each token turns one over: two sets differ in at least as many tokens as their bitmaps in bits."""
    # bit 6 tells the half; a shift counts by the lowest six bits of its width
    mine = lambda t: F.shiftrightunsigned(t if half else F.bitwise_not(t), 6).bitwiseAND(F.lit(1)).cast("bigint")
    return F.aggregate(tokens, F.lit(0).cast("bigint"), lambda m, t: m.bitwiseXOR(F.call_function("shiftleft", mine(t), t)))


def _bits_off(a: str, b: str) -> Column:
    return F.bit_count(F.col(f"{a}low").bitwiseXOR(F.col(f"{b}low"))) + F.bit_count(F.col(f"{a}high").bitwiseXOR(F.col(f"{b}high")))


def _able(a: str, b: str, threshold: float) -> Column:
    """Whether two sets can reach the threshold: their sizes, the places at which their lists meet, their bitmaps."""
    n, m, at, bt = (F.col(f"{side}{c}") for c in ("n", "at") for side in (a, b))
    need = F.ceil(F.lit(threshold / (1 + threshold)) * (n + m) - F.lit(1e-9))
    return ((F.least(n, m) >= F.greatest(n, m) * threshold - 1e-9) & (F.least(n - at, m - bt) >= need)
            & (_bits_off(a, b) <= n + m - 2 * need))


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, text: str, threshold: float) -> DataFrame:
    """The distinct ``later`` ranks of the (later, earlier) pairs of sets whose lines reach the threshold, compared token by token."""
    ranks = stored(pairs.select(F.col("later").alias("rank")).union(pairs.select("earlier")).distinct())
    n = ranks.count()
    places = stored(sets.select("rank", "first").join(maybe_broadcast(ranks, n, BROADCAST_ROWS), "rank", "left_semi").select("rank", "first.*"))
    some = docs.join(maybe_broadcast(places.select(*ROW_KEY).distinct(), n, BROADCAST_ROWS), ROW_KEY, "left_semi")
    # rows repeated as a whole hold the same line at one place; a line is split once, however many it is compared with
    lines = stored(_lines(some, text).join(maybe_broadcast(places, n, BROADCAST_ROWS), LINE).select(
        "rank", "content").dropDuplicates(["rank"]).select("rank", line_tokens(F.col("content")).alias("words")))
    both = pairs.join(lines.select(F.col("rank").alias("later"), F.col("words").alias("x")), "later").join(
        lines.select(F.col("rank").alias("earlier"), F.col("words").alias("y")), "earlier")
    both = both.select("later", F.size("x").alias("n"), F.size("y").alias("m"), F.size(F.array_intersect("x", "y")).alias("common"))
    return both.where(F.col("common") / (F.col("n") + F.col("m") - F.col("common")) >= threshold).select("later").distinct()


def _in_passes(find, lists: DataFrame) -> DataFrame:
    """What ``find`` makes of the lists, one part of the token space after the other, which bounds
    the shuffle files on disk at one time."""
    parts = [stored(find(lists.where(F.pmod("token", F.lit(PASSES)) == k))) for k in range(PASSES)]
    out = parts[0]
    for part in parts[1:]:
        out = out.union(part)
    return out


def repeated_lines(docs: DataFrame, text: str, threshold: float = THRESHOLD, least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """(row key, line): the lines of keyed ``docs`` that match an earlier line.

    Lines are ordered by row key and place. Lines of one token set become one representative, the
    first. Representatives meet at the tokens of their prefix lists, rarest first, under length,
    position and bitmap filters, and what is left is verified on the lines themselves. A set so small
    that one more token takes it below the threshold matches equal sets only and needs no list. First, every
    line is compared with one line only, the nearest of the earliest lines at its tokens, which
    settles families of copies without pairing them all. Only lines not settled so go on to the
    join with all earlier ones.
    """
    every = token_table(docs, text)
    lines = every.where(F.col("n") >= least_tokens)
    size = F.col("n")
    # one value of a fixed size, not a row beside every line
    ordered = lines.withColumn("__levels", rarity_table(every).scalar()).select(
        *LINE, "set_a", "set_b", "n", "low", "high", _rarest_first(F.col("tokens"), F.col("__levels")).alias("ordered"))
    prefixed = ordered.select(*LINE, "set_a", "set_b", "n", "low", "high", F.when(size >= (size + 1) * threshold - 1e-9, F.slice(
        "ordered", F.lit(1), (size - F.ceil(size * threshold - 1e-9) + 1).cast("int"))).alias("prefix"))
    # equal sets: only the first line goes on, a line that fills a third of all rows costs one row a task
    distinct = prefixed.groupBy("set_a", "set_b").agg(
        F.min(_place()).alias("first"), (F.count("*") > 1).alias("many"), F.first("n").alias("n"), F.first("low").alias("low"), F.first("high").alias("high"), F.first("prefix").alias("prefix"))
    # numbered in the order of their places, so that one number stands for a place
    place = [F.col(f"first.{c}") for c in LINE]
    sets = stored(distinct.repartitionByRange(*place).sortWithinPartitions(*place).withColumn("rank", F.monotonically_increasing_id()))
    listed = ["rank", "n", "at", "low", "high"]
    unroll = lambda df, *more: df.select("rank", "n", "low", "high", *more, "prefix", F.posexplode("prefix").alias("at", "token")).withColumn(
        "before", F.coalesce(F.get("prefix", F.col("at") - 1), F.lit(0))).drop("prefix")
    lists = unroll(sets)

    def with_heads(part: DataFrame) -> DataFrame:
        ranked = W.partitionBy("token").orderBy("rank").rowsBetween(W.unboundedPreceding, W.currentRow)
        met = part.select("token", *listed, *[F.first(c).over(ranked).alias(f"head_{c}") for c in listed])
        return met.where((F.col("head_rank") < F.col("rank")) & _able("", "head_", threshold)).groupBy(F.col("rank").alias("later")).agg(
            F.min(F.struct(_bits_off("", "head_").alias("off"), F.col("head_rank").alias("earlier"))).alias("best"))

    # of the first lines at its tokens, a line is compared with the one whose bitmap is nearest
    heads = stored(_in_passes(with_heads, lists).groupBy("later").agg(F.min("best").alias("best")).select("later", "best.earlier"))
    settled = stored(_verified(heads, sets, docs, text, threshold))
    # of the rest, each line looks at all earlier ones that share a token of its list
    done = maybe_broadcast(settled.select(F.col("later").alias("rank"), F.lit(True).alias("done")), settled.count(), BROADCAST_ROWS)
    marked = sets.join(done, "rank", "left").withColumn("open", F.col("done").isNull())

    def with_all(part: DataFrame) -> DataFrame:
        mine, other = part.alias("l"), part.alias("e")
        # lists that agree in the token before have met there, with more tokens left
        anew = (F.col("l.at") == 0) | (F.col("e.at") == 0) | (F.col("l.before") != F.col("e.before"))
        # both sides use the same columns, and no condition is of one side alone, so that both read one shuffle
        open_ = F.col("l.open") | (F.col("e.open") & (F.col("e.rank") >= F.col("l.rank")))
        return mine.join(other, (F.col("l.token") == F.col("e.token")) & (F.col("e.rank") < F.col("l.rank")) & open_ & anew & _able("l.", "e.", threshold)).select(
            F.col("l.rank").alias("later"), F.col("e.rank").alias("earlier")).distinct()

    pairs = stored(_in_passes(with_all, unroll(marked, "open")).distinct())
    late = settled.union(stored(_verified(pairs, sets, docs, text, threshold))).select(F.col("later").alias("rank"), F.lit(True).alias("late"))
    # a set of one line that matches no earlier one says nothing
    judged = stored(sets.select("set_a", "set_b", "first", "many", "rank").join(maybe_broadcast(late, late.count(), BROADCAST_ROWS), "rank", "left").where(
        F.col("many") | F.col("late")).select("set_a", "set_b", "first", F.coalesce("late", F.lit(False)).alias("late")))
    return lines.select(*LINE, "set_a", "set_b").join(maybe_broadcast(judged, judged.count(), BROADCAST_ROWS), ["set_a", "set_b"]).where(
        F.col("late") | (F.col("first") < _place())).select(*LINE).distinct()


def dedup_lines(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                least_tokens: int = LEAST_TOKENS) -> DataFrame:
    """``docs`` with ``text`` cut to its kept lines, and ``n_lines``, ``n_removed`` (such columns are replaced).

    A line goes if its token set has a Jaccard similarity of at least ``threshold`` with that of an
    earlier line, kept or not; earlier means by id (NULL ids rank as 0), then text hash, then place. Lines of
    fewer than ``least_tokens`` distinct tokens always stay. NULL texts have no line and stay
    NULL; an empty text is one empty line. Rows repeated as a whole count once and are cut alike.
    """
    joined, cut, lines, gone = _cut(docs, id, text, threshold, least_tokens)
    keep = [F.col(c) if c != text else cut.alias(text) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return joined.select(*keep, lines.alias("n_lines"), gone.alias("n_removed"))


def _cut(docs: DataFrame, id: str, text: str, threshold: float, least_tokens: int) -> tuple[DataFrame, Column, Column, Column]:
    """Rows with their removed line numbers, and as columns the cut text, the lines and the removed ones."""
    rows = keyed(docs, id, text)
    gone = stored(repeated_lines(rows.select(*ROW_KEY, text), text, threshold, least_tokens).groupBy(*ROW_KEY).agg(
        F.collect_set("line").alias("__gone")))
    joined = rows.join(maybe_broadcast(gone, gone.agg(F.sum(F.size("__gone"))).first()[0] or 0, BROADCAST_ROWS), ROW_KEY, "left")
    lines = F.split(F.col(text), "\n", -1)
    none = F.array().cast("array<int>")
    cut = F.when(F.col("__gone").isNull(), F.col(text)).otherwise(F.array_join(
        F.filter(lines, lambda x, i: ~F.array_contains(F.coalesce("__gone", none), i)), "\n"))
    return (joined, cut, F.coalesce(F.size(F.when(F.col(text).isNotNull(), lines)), F.lit(0)).cast("bigint"),
            F.size(F.coalesce("__gone", none)).cast("bigint"))


def without_repeats(docs: DataFrame, id: str = "doc_id", text: str = "text", threshold: float = THRESHOLD,
                    least_tokens: int = LEAST_TOKENS, length: str = "n_chars") -> DataFrame:
    """``docs`` with later matching lines cut, columns as given; see ``dedup_lines``.

    A row that loses lines and has no word left is dropped; rows that lose none stay as they are.
    The ``length`` column, if there, follows a text that was cut.
    """
    joined, cut, _, _ = _cut(docs, id, text, threshold, least_tokens)
    out = joined.withColumn("__cut", cut).where(F.col("__gone").isNull() | F.coalesce(
        F.col("__cut").rlike(r"[0-9A-Za-z\x{80}-\x{10FFFF}]"), F.lit(False)))
    columns = {text: F.col("__cut")}
    if length in docs.columns and length != text:
        columns[length] = F.when(F.col("__gone").isNull(), F.col(length)).otherwise(F.char_length("__cut").cast(docs.schema[length].dataType))
    return out.select(*[columns[c].alias(c) if c in columns else F.col(c) for c in docs.columns])
