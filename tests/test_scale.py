"""The hot-key building blocks against plain computations."""

import random

import pandas as pd
from pyspark.sql import functions as F

from strataloom.operators import clusters as C, greedy as G, scale as S


def skewed(n=400, seed=1):
    rng = random.Random(seed)
    return pd.DataFrame([(("hot" if rng.random() < 0.5 else f"k{rng.randrange(40)}"), i, rng.randrange(50)) for i in range(n)],
                        columns=["k", "id", "v"])


def test_ordered_scan_ranges_equal_windows(spark):
    pdf = skewed()
    df = spark.createDataFrame(pdf).repartition(7)
    aggs = {"total": ("sum", "v"), "low": ("min", "v"), "before": ("count", "v"), "high": ("max", "v")}
    for keys in (["k"], []):
        outs = [S.ordered_scan(df, ["v", "id"], aggs, keys, exclusive=["before"], group_rows=n).toPandas().sort_values("id")
                for n in (20, 10**6)]
        assert outs[0].reset_index(drop=True).equals(outs[1].reset_index(drop=True)[outs[0].columns])
    want = pdf.sort_values(["v", "id"])
    want["total"] = want.groupby("k")["v"].cumsum()
    want["before"] = want.groupby("k").cumcount()
    got = S.ordered_scan(df, ["v", "id"], aggs, ["k"], exclusive=["before"], group_rows=20).toPandas()
    merged = want.merge(got, on="id", suffixes=("", "_got"))
    assert (merged["total"] == merged["total_got"]).all() and (merged["before"] == merged["before_got"]).all()


def test_group_aggregate_of_a_hot_key(spark):
    pdf = skewed()
    got = S.with_group_agg(spark.createDataFrame(pdf), ["k"], {
        "s": ("sum", "v"), "n": ("count", "v"), "lo": ("min", "v"), "all": ("set", "v")}, ["id"], salts=5).toPandas()
    for k, g in pdf.groupby("k"):
        mine = got[got["k"] == k]
        assert len(mine) == len(g) and set(mine["s"]) == {g["v"].sum()} and set(mine["n"]) == {len(g)} and set(mine["lo"]) == {g["v"].min()}
        assert list(mine["all"].iloc[0]) == sorted(set(g["v"]))


def test_exact_quantile(spark):
    pdf = skewed()
    got = {r["k"]: r["m"] for r in S.exact_median(spark.createDataFrame(pdf), ["k"], "v", "m").collect()}
    assert got == pdf.groupby("k")["v"].median().to_dict()


def union_find(pairs):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in pairs:
        a, b = find(u), find(v)
        if a != b:
            parent[max(a, b)] = min(a, b)
    return {x: find(x) for x in parent if find(x) != x}


def test_components_by_rounds(spark):
    rng = random.Random(5)
    pairs = [(rng.randrange(120), rng.randrange(120)) for _ in range(80)] + [(i, i + 1) for i in range(200, 230)] + [(300, i) for i in range(301, 330)]
    edges = spark.createDataFrame(pairs, "u bigint, v bigint")
    assert {r["node"]: r["label"] for r in C.connected_labels(edges).collect()} == union_find(pairs)


def test_union_of_clusters_with_shared_content(spark):
    rows = [("a", 11, "AAAA"), ("b", 22, "AAAA"), ("c", 22, "AAAT")]
    out = C.union_clusters(spark.createDataFrame(rows, "id string, cluster bigint, sequence string"), "sequence", "cluster")
    assert {r["id"]: r["canonical"] for r in out.collect()} == {"a": 11, "b": 11, "c": 11}
    stats = C.union_stats(out, "sequence", "cluster").first()
    assert (stats["conflicting_keys"], stats["clusters_merged"]) == (1, 1)


def greedy(rows):
    used_a, used_b, kept = set(), set(), []
    for r, a, b in sorted(rows):
        if a not in used_a and b not in used_b:
            kept.append(r)
            used_a.add(a), used_b.add(b)
    return sorted(kept)


def test_greedy_unique_equals_the_walk(spark):
    for seed in (1, 2):
        rng = random.Random(seed)
        rows = [(i, rng.randrange(15), rng.randrange(15)) for i in range(60)]
        df = spark.createDataFrame(rows, "r bigint, a bigint, b bigint")
        assert sorted(x["r"] for x in G.greedy_unique(df, [F.col("r")], ("a", "b")).collect()) == greedy(rows)


def test_greedy_unique_settles_a_chain_of_many_rounds(spark):
    # each row shares a key with the one before and the one after: every round settles one
    df = spark.range(24).select(F.col("id").alias("r"), F.floor(F.col("id") / 2).alias("a"), F.floor((F.col("id") + 1) / 2).alias("b"))
    assert sorted(x["r"] for x in G.greedy_unique(df, [F.col("r")], ("a", "b")).collect()) == list(range(0, 24, 2))


def batches(sizes, budget):
    out, batch, filled = {}, 0, 0
    for size, i in sorted((s, i) for i, s in enumerate(sizes)):
        if size <= budget and size * (filled + 1) <= budget:
            filled += 1
        else:
            batch, filled = batch + (filled > 0), 1
        out[i] = batch
    return out


def test_token_batches_equal_the_fold(spark):
    rng = random.Random(3)
    cases = [([10, 7000, 8000], 6000), ([rng.randrange(0, 120) for _ in range(300)], 100), ([5] * 40 + [0] * 3, 20)]
    for sizes, budget in cases:
        got = G.token_batches(spark.createDataFrame(list(enumerate(sizes)), "i bigint, s bigint"), "i", "s", budget).collect()
        assert {r["i"]: r["batch"] for r in got} == batches(sizes, budget)


def shards(sizes, budget):
    out, shard, used = [], 0, 0
    for s in sizes:
        padded = 512 + -(-s // 512) * 512
        if used and used + padded > budget:
            shard, used = shard + 1, 0
        used += padded
        out.append(shard)
    return out


def test_shard_plan_equals_the_fold(spark):
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        for seed, budget in ((1, 3000), (2, 20000), (3, 10**7)):
            rng = random.Random(seed)
            sizes = [rng.choice([0, 100, 600, 1500, 4000]) for _ in range(300)]
            df = spark.createDataFrame(list(enumerate(sizes)), "i bigint, s bigint").repartition(5)
            plan = G.shard_plan(df, "i", "s", budget, ["i"])
            assert [r["shard"] for r in plan.orderBy("i").collect()] == shards(sizes, budget)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    summary = G.shard_summary(plan).collect()
    assert sum(r["records"] for r in summary) == 300 and summary[0]["name"] == "shard-00000"


def test_stratified_pick_takes_one_per_bin(spark):
    letters = "ACDEFGHIKLMNPQRSTVWY"
    lengths = [60, 120, 250, 350, 450, 550, 650, 750, 80]
    rows = [(f"c{i}", n, 1 if i == 8 else i + 1, "".join(letters[(i + k) % 20] for k in range(n))) for i, n in enumerate(lengths)]
    df = spark.createDataFrame(rows, "chain string, length int, cluster int, content string")
    picked = G.stratified_pick(df, "chain", "length", "cluster", "content", G.length_bins(50, 800, 4), 4, seed=42).collect()
    assert len({r["length_bin"] for r in picked}) == 4 and len({r["cluster"] for r in picked}) == 4
    assert [r["record_id"] for r in sorted(picked, key=lambda r: r["record_id"])] == [f"record-{i:04d}" for i in range(1, 5)]


def test_length_bins_cover_the_range():
    bins = G.length_bins(50, 800, 4)
    assert bins[0][1] == 50 and bins[-1][2] == 800 and all(a[2] + 1 == b[1] for a, b in zip(bins, bins[1:]))


def test_neighbour_values_of_large_and_small_groups(spark):
    pdf = skewed(120)
    df = spark.createDataFrame(pdf)
    values = {"before": ("v", -1), "after": ("v", 2)}
    a, b = (S.neighbour_values(df, ["k"], "id", values, n).toPandas().sort_values("id").reset_index(drop=True) for n in (10, 10**6))
    assert a[["id", "before", "after"]].equals(b[["id", "before", "after"]])
    want = pdf.sort_values("id").groupby("k")["v"].shift(1)
    assert b["before"].fillna(-1).tolist() == want.fillna(-1).tolist()


def test_null_groups_are_kept(spark):
    rows = [(None, i, i % 7) for i in range(40)] + [("a", 100 + i, i) for i in range(5)]
    df = spark.createDataFrame(rows, "k string, id bigint, v bigint")
    for n in (10, 10**6):
        got = S.ordered_scan(df, ["id"], {"at": ("count", "v")}, ["k"], group_rows=n)
        assert got.count() == 45 and got.where("k is null").agg(F.max("at")).first()[0] == 40
    assert S.with_group_agg(df, ["k"], {"n": ("count", "v")}, ["id"]).where("n = 40").count() == 40
    from strataloom.operators.metrics import metric_summary

    summary = {r["scope"]: (r["count"], r["median"]) for r in metric_summary(df, ["v"], "k").collect()}
    assert summary == {None: (40, 3.0), "a": (5, 2.0), "overall": (45, 3.0)}


def test_correlation_of_equal_values(spark):
    """Partial aggregates of 49 equal values each, whose merged variance is not exactly zero."""
    from strataloom.operators.metrics import safe_corr

    rows = spark.range(0, 147, 1, 3).select(F.lit(1.0).alias("x"), (F.col("id") * 0.5).alias("y"))
    flat, line = rows.agg(safe_corr(F.col("x"), F.col("y")).alias("flat"), safe_corr(F.col("y"), F.col("y") * 2).alias("line")).first()
    assert flat is None and abs(line - 1) < 1e-12


def test_ranges_grow_with_the_rows(spark):
    """A table of many times the rows of one task's group is cut into as many ranges, and the scan stays exact."""
    rows = spark.range(0, 4000, 1, 3).select(((F.col("id") * 7) % 4000).alias("at"), F.lit(1).alias("one"))
    out = S.ordered_scan(rows, ["at"], {"n": ("sum", "one")}, group_rows=100)
    assert out.where("n <> at + 1").count() == 0 and out.count() == 4000
    assert out.withColumn("task", F.spark_partition_id()).groupBy("task").count().agg(F.max("count")).first()[0] < 600


def test_quantiles_of_counts_in_bins(spark):
    """Values at the bounds, in one bin, in several rows, not finite, of one kind only, under a NULL key."""
    groups = {"even": [1.0, 2.0, 3.0, 4.0], "far": [1e-9 * k for k in range(50)] + [1e300, -1e300], "one": [7.0] * 3, "odd": [-float("inf"), 1.0, 2.0, float("inf"), float("inf")],
              "nan": [1.0, 2.0, float("nan")], "endless": [float("inf")] * 2, None: [float(k % 97) for k in range(1000)]}
    rows = [(k, v, 1) for k, vs in groups.items() for v in vs]
    counts = spark.createDataFrame(rows, "k string, v double, n bigint")
    for at in (0.0, 0.5, 0.75, 1.0):
        got = {r["k"]: r["q"] for r in S.quantile_of_counts(counts, ["k"], "v", at, "q").collect()}
        for k, vs in groups.items():
            vs = sorted(vs, key=lambda v: (v != v, v))
            rank = at * (len(vs) - 1)
            low, high = vs[int(rank // 1)], vs[int(-(-rank // 1))]
            assert repr(got[k]) == repr(low + (high - low) * (rank % 1)), (k, at)


def test_median_orders_only_the_middle(spark, monkeypatch):
    """Of 40,000 values a few at the median are scanned, not all."""
    scanned, scan = [], S.ordered_scan
    monkeypatch.setattr(S, "ordered_scan", lambda df, *a, **kw: scanned.append(df.count()) or scan(df, *a, **kw))
    df = spark.range(40_000).select((F.col("id") % 2).alias("k"), (F.col("id") * 1.5).alias("v"))
    assert {r["k"]: r["m"] for r in S.exact_median(df, ["k"], "v", "m").collect()} == {0: 29998.5, 1: 30000.0}
    assert scanned and scanned[0] <= 40


def test_reduce_tasks_read_little(spark):
    """Coalesced partitions end at 16 MB, whatever the cluster's own setting."""
    from strataloom.session import tune

    key = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    before = spark.conf.get(key)
    try:
        spark.conf.set(key, "64m")
        assert tune(spark).conf.get(key) == "16m"
    finally:
        spark.conf.set(key, before)
