"""Building blocks that keep a hot key out of a single task.

* ``with_group_agg`` adds a group's aggregate to each of its rows, in two salted levels.
* ``ordered_scan`` computes running aggregates in a total order over range partitions.
* ``exact_quantile`` / ``exact_median`` scan only the values around an order statistic.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window as W, functions as F

from ..session import checkpointed, shuffle_width

_MERGE = {"sum": F.sum, "count": F.sum, "min": F.min, "max": F.max}
_PARTIAL = {"sum": F.sum, "count": F.count, "min": F.min, "max": F.max}


def _merge(kind: str, column: str, window) -> Column:
    if kind == "set":
        return F.array_sort(F.array_distinct(F.flatten(F.collect_list(column).over(window))))
    return _MERGE[kind](column).over(window)


def join_groups(left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner") -> DataFrame:
    """Equi-join in which NULL keys match each other, as they do in a grouping."""
    names = {k: f"__j{i}" for i, k in enumerate(keys)}
    other = right.select(*[F.col(k).alias(n) for k, n in names.items()], *[c for c in right.columns if c not in keys])
    same = F.lit(True)
    for k, n in names.items():
        same = same & F.col(k).eqNullSafe(F.col(n))
    return left.join(other, same, how).drop(*names.values())


def with_group_agg(
    df: DataFrame,
    keys: Sequence[str],
    aggs: Mapping[str, tuple[str, str]],
    salt_on: Sequence[str],
    salts: int | None = None,
) -> DataFrame:
    """Add ``{out: (kind, column)}`` aggregates of the group ``keys`` to every row.

    Kinds: sum, count, min, max, and set (distinct values of few-valued columns). A group is
    spread over ``salts`` parts by a hash of ``salt_on``; each part is reduced first, the at
    most ``salts`` partial rows of a group are merged, and rows meet their group's value on
    (keys, salt). No exchange is ever keyed by the group alone except that of the partials.
    """
    salts = salts or max(8, shuffle_width(df.sparkSession))
    salted = df.withColumn("__salt", F.pmod(F.xxhash64(*salt_on), F.lit(salts)).cast("int"))
    partial = salted.groupBy(*keys, "__salt").agg(*[
        (F.collect_set(column) if kind == "set" else _PARTIAL[kind](column)).alias(out)
        for out, (kind, column) in aggs.items()
    ])
    window = W.partitionBy(*keys)
    merged = partial.select(
        *keys, "__salt",
        *[_merge(kind, out, window).alias(out) for out, (kind, _) in aggs.items()],
    )
    return join_groups(salted, merged, [*keys, "__salt"]).select(*df.columns, *aggs)


#: Groups of at most this many rows are sorted by one task.
GROUP_ROWS = 1_000_000


def ordered_scan(
    df: DataFrame,
    order: Sequence[str | Column],
    aggs: Mapping[str, tuple[str, str]],
    keys: Sequence[str] = (),
    exclusive: Sequence[str] = (),
    group_rows: int = GROUP_ROWS,
    largest: int | None = None,
) -> DataFrame:
    """Running ``{out: (kind, column)}`` aggregates in ``order`` inside ``keys``.

    Kinds: sum, count, min, max. ``order`` must be total (end it with a unique id). Outputs
    named in ``exclusive`` leave the current row out (NULL, or 0 for sum and count, on the
    first row). Groups are counted first, unless the caller knows how many rows the ``largest``
    has. Those of at most ``group_rows`` rows run as a plain window; the rows of larger ones are
    range partitioned, see ``_range_scan``.
    """
    order = [F.col(o) if isinstance(o, str) else o for o in order]
    if largest is not None and largest <= group_rows:
        return _window_scan(df, order, aggs, keys, exclusive)
    large = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > group_rows)
    # at most total / group_rows keys are large
    large = checkpointed(large) if keys else large
    rows = large.agg(F.sum("__n")).first()[0]
    if rows is None:
        return _window_scan(df, order, aggs, keys, exclusive)
    # a range holds about as many rows as the largest group that one task sorts
    ranges = max(shuffle_width(df.sparkSession), -(-rows // max(1, group_rows)))
    if not keys:
        return _range_scan(df, order, aggs, keys, exclusive, ranges)
    large = large.drop("__n")
    small_part = _window_scan(join_groups(df, large, keys, "left_anti"), order, aggs, keys, exclusive)
    return small_part.unionByName(_range_scan(join_groups(df, large, keys, "left_semi"), order, aggs, keys, exclusive, ranges))


def _running(kind: str, column: str, out: str, window, exclusive: Sequence[str]) -> Column:
    return _PARTIAL[kind](column).over(window.rowsBetween(W.unboundedPreceding, -1 if out in exclusive else 0))


def _window_scan(df: DataFrame, order, aggs, keys, exclusive) -> DataFrame:
    window = W.partitionBy(*keys).orderBy(*order)
    columns = []
    for out, (kind, column) in aggs.items():
        value = _running(kind, column, out, window, exclusive)
        columns.append((F.coalesce(value, F.lit(0)) if kind in ("sum", "count") else value).alias(out))
    return df.select(*df.columns, *columns)


def _range_scan(df: DataFrame, order, aggs, keys, exclusive, ranges: int) -> DataFrame:
    """The scan over ``ranges`` range partitions of (keys, order): a key may span any number of tasks.

    Ranges are dealt out again by their number over as many tasks, so a task sorts few of them however many rows
    there are. Only one summary row per (key, range) is carried across ranges. The ranges are written once,
    because both passes must see the same boundaries even after a lost executor.
    """
    ranged = checkpointed(
        df.repartitionByRange(ranges, *[F.col(k) for k in keys], *order)
        .withColumn("__range", F.spark_partition_id())
    )
    summary = ranged.groupBy(*keys, "__range").agg(*[
        _PARTIAL[kind](column).alias(f"__{out}") for out, (kind, column) in aggs.items()
    ])
    before = W.partitionBy(*keys).orderBy("__range").rowsBetween(W.unboundedPreceding, -1)
    carried = summary.select(
        *keys, "__range",
        *[_MERGE[kind](f"__{out}").over(before).alias(f"__{out}") for out, (kind, _) in aggs.items()],
    )
    ranged = ranged.repartition(ranges, "__range")
    local = W.partitionBy("__range", *keys).orderBy(*order)
    columns = []
    for out, (kind, column) in aggs.items():
        value, carry = _running(kind, column, out, local, exclusive), F.col(f"__{out}")
        if kind in ("sum", "count"):
            value = F.coalesce(value, F.lit(0)) + F.coalesce(carry, F.lit(0))
        else:
            value = (F.least if kind == "min" else F.greatest)(value, carry)
        columns.append(value.alias(out))
    return join_groups(ranged, carried, [*keys, "__range"]).select(*df.columns, *columns)


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """(keys, value, n): rows per distinct value, the form order statistics are read from."""
    return df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count("*").alias("n"))


#: Parts into which the values of a group are dealt to find those around a quantile.
BINS = 4096
#: Groups, one row of three numbers each, up to which their table is broadcast.
BROADCAST_GROUPS = 100_000


def finite(value: str) -> Column:
    return F.when(~F.isnan(F.col(value).cast("double")) & (F.abs(F.col(value).cast("double")) < float("inf")), F.col(value).cast("double"))


def bounds(value: str, n: str = "n") -> list[Column]:
    """What ``quantile_of_counts`` has to know of a group, as aggregates: its size and its least and greatest finite value."""
    return [F.sum(n).alias("__total"), F.min(finite(value)).alias("__lo"), F.max(finite(value)).alias("__hi")]


def quantile_of_counts(counts: DataFrame, keys: Sequence[str], value: str, at: float, out: str, totals: DataFrame | None = None) -> DataFrame:
    """Linear-interpolated quantile of a table of values and counts ``n``, exact at any group size.

    Values are dealt into equal bins between the bounds of their group, and only the rows of the at most two
    bins that hold the quantile's ranks are ordered; bins are counted map-side. A value may come in
    several rows. ``totals`` (keys and ``bounds``) saves a pass where the caller has it.
    """
    if totals is None:
        totals = counts.groupBy(*keys).agg(*bounds(value))
    # one row a group, read by both passes; beside few groups the rows stay where they are
    totals = checkpointed(totals)
    few = totals.count() <= BROADCAST_GROUPS
    beside = lambda df: F.broadcast(df) if few else df
    meet = lambda left, right: join_groups(left, right, keys) if keys else left.crossJoin(right)
    # any function that never falls will do: what is not finite goes to either end, and a group without a width is one bin
    place = (F.col(value).cast("double") - F.col("__lo")) / (F.col("__hi") - F.col("__lo")) * BINS
    bin_ = F.when(F.col("__hi") > F.col("__lo"), F.floor(F.greatest(F.lit(0.0), F.least(F.lit(float(BINS)), place)))).otherwise(0).cast("int")
    placed = meet(counts, beside(totals)).withColumn("__bin", bin_)
    rank = F.lit(float(at)) * (F.col("__total") - 1)
    low, high = F.floor(rank), F.ceil(rank)
    # at most BINS + 1 rows a group
    sizes = placed.groupBy(*keys, "__bin").agg(F.sum("n").alias("__n"), F.first("__total").alias("__total"))
    before = F.coalesce(F.sum("__n").over(W.partitionBy(*keys).orderBy("__bin").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    hit = sizes.withColumn("__before", before).where((F.col("__before") <= high) & (low < F.col("__before") + F.col("__n")))
    chosen = checkpointed(hit.select(*keys, "__bin", "__before"))
    near = checkpointed(join_groups(placed, beside(chosen), [*keys, "__bin"]).groupBy(*keys, "__bin", value).agg(
        F.sum("n").alias("n"), F.first("__total").alias("__total"), F.first("__before").alias("__before")))
    scanned = ordered_scan(near, [value], {"__cum": ("sum", "n")}, [*keys, "__bin"])
    first = F.col("__before") + F.col("__cum") - F.col("n")
    last = F.col("__before") + F.col("__cum") - 1
    hit_low = (first <= low) & (low <= last)
    hit_high = (first <= high) & (high <= last)
    picked = scanned.where(hit_low | hit_high).groupBy(*keys).agg(
        F.max(F.when(hit_low, F.col(value))).alias("__low"),
        F.max(F.when(hit_high, F.col(value))).alias("__high"),
        F.max(rank - low).alias("__part"),
    )
    return picked.select(
        *keys, (F.col("__low") + (F.col("__high") - F.col("__low")) * F.col("__part")).alias(out)
    )


def exact_quantile(df: DataFrame, keys: Sequence[str], value: str, at: float, out: str) -> DataFrame:
    """Exact quantile of ``value`` per ``keys``. Equal values are counted before the scan."""
    return quantile_of_counts(checkpointed(value_counts(df, keys, value)), keys, value, at, out)


def exact_median(df: DataFrame, keys: Sequence[str], value: str, out: str) -> DataFrame:
    return exact_quantile(df, keys, value, 0.5, out)


def row_numbers(
    df: DataFrame, order: Sequence[str | Column], out: str, keys: Sequence[str] = (), group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """1-based position in ``order`` inside ``keys`` by a distributed scan."""
    return ordered_scan(
        df.withColumn("__one", F.lit(1).cast("bigint")), order, {out: ("sum", "__one")}, keys, group_rows=group_rows
    ).drop("__one")


def neighbour_values(
    df: DataFrame, keys: Sequence[str], order: str, values: Mapping[str, tuple[str, int]], group_rows: int = GROUP_ROWS,
) -> DataFrame:
    """Add ``{out: (column, offset)}``: the column of the row ``offset`` places on inside ``keys``.

    Groups of at most ``group_rows`` rows, which are counted, use a window; larger ones number
    their rows in a distributed scan and meet their neighbours by position.
    """
    large = df.groupBy(*keys).agg(F.count("*").alias("__n")).where(F.col("__n") > group_rows).drop("__n")
    window = W.partitionBy(*keys).orderBy(order)
    plain = lambda part: part.select("*", *[F.lead(c, n).over(window).alias(out) if n > 0 else F.lag(c, -n).over(window).alias(out)
                                            for out, (c, n) in values.items()])
    if large.isEmpty():
        return plain(df)
    large = checkpointed(large)
    placed = checkpointed(row_numbers(df.join(large, list(keys), "left_semi"), [order], "__at", keys, group_rows))
    out = placed
    for name, (column, offset) in values.items():
        shifted = placed.select(*keys, (F.col("__at") - offset).alias("__at"), F.col(column).alias(name))
        out = out.join(shifted, [*keys, "__at"], "left")
    return plain(df.join(large, list(keys), "left_anti")).unionByName(out.drop("__at"))
