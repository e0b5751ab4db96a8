"""Queries over ranking, greedy selection, batching, shard plans, crops and neighbours."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.vector import rbf
from ..operators import crop as K, greedy as G, pairs as P, select as S
from .registry import query


@query("canonical_member", """
SELECT source, doc_id FROM (SELECT source, doc_id, row_number() OVER (PARTITION BY source ORDER BY
  CAST(regexp_extract('a' || lang || doc_id, '[0-9]+$') AS BIGINT), doc_id) AS rn
  FROM (SELECT source, doc_id, 'x' AS lang FROM documents)) WHERE rn = 1""")
def canonical_member(t):
    docs = t.documents.select("source", "doc_id", F.concat(F.lit("ax"), "doc_id").alias("member"))
    return S.canonical_member(docs, ["source"], "member", "doc_id").select("source", "doc_id")


@query("canonical_member_mixed", """
SELECT p_brand, p_name, p_partkey FROM (SELECT p_brand, p_name, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY
  p_size, lower(p_name), p_partkey) AS rn FROM part) WHERE rn = 1""")
def canonical_member_mixed(t):
    parts = t.part.withColumn("member", F.concat("p_size", "p_name"))
    return S.canonical_member(parts, ["p_brand"], "member", "p_partkey").select("p_brand", "p_name", "p_partkey")


@query("first_turn", "SELECT conv_id, min(turn) AS turn FROM conversations GROUP BY conv_id")
def first_turn(t):
    return S.least_row(t.conversations.select("conv_id", "turn"), ["conv_id"], ["turn"])


@query("target_member", """
SELECT l_orderkey, l_linenumber, l_quantity, l_extendedprice FROM (
  SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_quantity DESC, l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) AS rn FROM lineitem)
WHERE rn = 1""")
def target_member(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_partkey", "l_suppkey")
    return S.least_row(lines, ["l_orderkey"], [
        -F.col("l_quantity"), -F.col("l_extendedprice"), "l_linenumber", "l_partkey", "l_suppkey"]
    ).select("l_orderkey", "l_linenumber", "l_quantity", "l_extendedprice")


@query("spatial_rank", """
SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY
  CASE WHEN o_totalprice < 1000 THEN 'infinity'::DOUBLE ELSE o_totalprice END, o_orderkey) AS spatial_rank FROM orders""")
def spatial_rank(t):
    orders = t.orders.select("o_custkey", "o_orderkey", F.when(F.col("o_totalprice") >= 1000, F.col("o_totalprice")).alias("d"))
    return S.spatial_rank(orders, ["o_custkey"], "d", "o_orderkey").select("o_custkey", "o_orderkey", "spatial_rank")


@query("smoke_selection", """
SELECT source, doc_id, n_chars FROM (SELECT *, row_number() OVER (PARTITION BY source ORDER BY n_chars DESC, doc_id DESC) AS rn
FROM documents) WHERE rn = 1""")
def smoke_selection(t):
    return S.smoke_or_full(t.documents.select("source", "doc_id", "n_chars"), "source", "n_chars", "doc_id", "smoke")


@query("epoch_sample", """
SELECT cluster, doc_id FROM (SELECT doc_id // 5 AS cluster, doc_id, row_number() OVER (PARTITION BY doc_id // 5 ORDER BY
  sha256('11' || chr(0) || '3' || chr(0) || doc_id), doc_id) AS rn FROM documents) WHERE rn = 1""")
def epoch_sample(t):
    docs = t.documents.select("doc_id", F.floor(F.col("doc_id") / 5).alias("cluster"))
    return S.epoch_sample(docs, "cluster", "doc_id", seed=11, epoch=3)


@query("evaluation_order", """
SELECT o_orderkey, row_number() OVER (ORDER BY o_custkey, o_orderpriority, o_orderkey) - 1 AS position FROM orders""")
def evaluation_order(t):
    orders = t.orders.select("o_orderkey", "o_custkey", "o_orderpriority")
    return S.evaluation_order(orders, "o_custkey", ["o_orderpriority", "o_orderkey"]).select("o_orderkey", "position")


@query("role_picks", """
WITH a AS (SELECT p_partkey FROM part ORDER BY p_retailprice, p_partkey LIMIT 1),
b AS (SELECT p_partkey FROM part WHERE p_size >= 40 AND p_partkey NOT IN (FROM a) ORDER BY p_retailprice, p_partkey LIMIT 1),
c AS (SELECT p_partkey FROM part WHERE p_partkey NOT IN (FROM a UNION FROM b) ORDER BY p_size DESC, p_partkey LIMIT 1),
d AS (SELECT p_partkey FROM part WHERE p_partkey NOT IN (FROM a UNION FROM b UNION FROM c) ORDER BY p_retailprice DESC, p_partkey LIMIT 1)
SELECT 'lowest' AS role, p_partkey FROM a UNION ALL SELECT 'lowest_high_coverage', p_partkey FROM b
UNION ALL SELECT 'longest', p_partkey FROM c UNION ALL SELECT 'highest_control', p_partkey FROM d""")
def role_picks(t):
    part = t.part.select("p_partkey", "p_retailprice", "p_size")
    return S.role_picks(part, "p_partkey", [
        ("lowest", [F.col("p_retailprice")], None),
        ("lowest_high_coverage", [F.col("p_retailprice")], F.col("p_size") >= 40),
        ("longest", [F.col("p_size").desc()], None),
        ("highest_control", [F.col("p_retailprice").desc()], None),
    ]).select("role", "p_partkey")


@query("lowest_n_report", """
SELECT o_orderkey, o_totalprice FROM orders ORDER BY o_totalprice, o_orderkey LIMIT 10""")
def lowest_n_report(t):
    return S.lowest_n(t.orders.select("o_orderkey", "o_totalprice"), [F.col("o_totalprice"), F.col("o_orderkey")], 10)


@query("best_and_latest_epoch", """
SELECT user_id, arg_min(event_id, value) AS best_epoch, min(value) AS best_loss, max(event_id) AS latest_epoch,
       arg_max(value, event_id) AS latest_loss
FROM (SELECT user_id, event_id, value, row_number() OVER (PARTITION BY user_id, value ORDER BY event_id) AS rn FROM events)
GROUP BY user_id""")
def best_and_latest_epoch(t):
    return S.best_and_latest(t.events.select("user_id", "event_id", "value"), "user_id", "event_id", "value")


@query("running_best", """
SELECT user_id, event_id, b AS best_before, (b IS NULL OR value < b) AS improved FROM (
  SELECT user_id, event_id, value, min(value) OVER (PARTITION BY user_id ORDER BY event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS b
  FROM events)""")
def running_best(t):
    rows = t.events.select("user_id", "event_id", "value")
    return S.running_best(rows, "user_id", "event_id", "value").select("user_id", "event_id", "best_before", "improved")


BINS = G.length_bins(1, 200000, 40)
BIN_SQL = "CASE " + " ".join(f"WHEN n_chars BETWEEN {a} AND {b} THEN '{n}'" for n, a, b in BINS) + " END"


@query("length_bins", f"SELECT {BIN_SQL} AS length_bin, count(*) AS n, min(n_chars) AS shortest, max(n_chars) AS longest FROM documents GROUP BY 1")
def length_bins(t):
    return t.documents.groupBy(G.bin_label(F.col("n_chars"), BINS).alias("length_bin")).agg(
        F.count("*").alias("n"), F.min("n_chars").alias("shortest"), F.max("n_chars").alias("longest"))


GREEDY_SQL = """
ranked AS MATERIALIZED (SELECT doc_id, source, lang, row_number() OVER (ORDER BY sha256('5' || chr(0) || doc_id), doc_id) AS rk FROM rows_in),
walk(rk, a, b, kept) AS (
  SELECT 0::BIGINT, []::VARCHAR[], []::VARCHAR[], NULL::BIGINT
  UNION ALL
  SELECT r.rk,
    CASE WHEN list_contains(w.a, r.k1) OR list_contains(w.b, r.k2) THEN w.a ELSE list_append(w.a, r.k1) END,
    CASE WHEN list_contains(w.a, r.k1) OR list_contains(w.b, r.k2) THEN w.b ELSE list_append(w.b, r.k2) END,
    CASE WHEN list_contains(w.a, r.k1) OR list_contains(w.b, r.k2) THEN NULL ELSE r.doc_id END
  FROM walk w JOIN (SELECT rk, doc_id, source || (doc_id % 7)::VARCHAR AS k1, (doc_id // 3)::VARCHAR AS k2 FROM ranked) r ON r.rk = w.rk + 1)
"""


@query("greedy_unique", f"""WITH RECURSIVE rows_in AS (SELECT doc_id, source, lang FROM documents), {GREEDY_SQL}
SELECT kept AS doc_id FROM walk WHERE kept IS NOT NULL""")
def greedy_unique(t):
    docs = t.documents.select(
        "doc_id", F.concat("source", (F.col("doc_id") % 7).cast("string")).alias("k1"),
        F.floor(F.col("doc_id") / 3).cast("string").alias("k2"), X.rank_hash(5, F.col("doc_id")).alias("h"))
    return G.greedy_unique(docs, [F.col("h"), F.col("doc_id")], ("k1", "k2")).select("doc_id")


@query("eligibility_funnel", """
SELECT count(*) AS n_rows, count(*) FILTER (lang = 'en') AS english, count(*) FILTER (lang = 'en' AND n_chars BETWEEN 200 AND 5000) AS length_ok,
  count(*) FILTER (lang = 'en' AND n_chars BETWEEN 200 AND 5000 AND quality = 1) AS good
FROM documents LEFT JOIN labels USING (doc_id)""")
def eligibility_funnel(t):
    docs = t.documents.select("doc_id", "lang", "n_chars").join(t.labels.select("doc_id", "quality"), "doc_id", "left")
    return G.eligibility_funnel(docs, [
        ("english", F.col("lang") == "en"), ("length_ok", F.col("n_chars").between(200, 5000)), ("good", F.col("quality") == 1),
    ]).withColumnRenamed("rows", "n_rows")


PICK_BINS = G.length_bins(1, 200000, 30)
PICK_N = 60


# oracle: one walk per bin for the candidates, then one walk over (scarce bins first, all rows last)
PICK_SQL = f"""WITH RECURSIVE
docs AS MATERIALIZED (SELECT doc_id, n_chars, (doc_id // 2)::VARCHAR AS cl, sha256(text) AS seq,
  sha256('13' || chr(0) || doc_id || chr(0) || sha256(text)) AS h,
  CASE {" ".join(f"WHEN n_chars BETWEEN {a} AND {b} THEN {i}" for i, (_, a, b) in enumerate(PICK_BINS))} END AS bin FROM documents),
o1 AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY bin ORDER BY h, doc_id) AS rk FROM docs),
w1(bin, rk, a, b, kept) AS (
  SELECT bin, 0::BIGINT, []::VARCHAR[], []::VARCHAR[], NULL::BIGINT FROM (SELECT DISTINCT bin FROM docs)
  UNION ALL
  SELECT bin, rk, CASE WHEN hit THEN a ELSE list_append(a, cl) END, CASE WHEN hit THEN b ELSE list_append(b, seq) END,
    CASE WHEN hit THEN NULL ELSE doc_id END
  FROM (SELECT o.bin, o.rk, o.cl, o.seq, o.doc_id, w.a, w.b, list_contains(w.a, o.cl) OR list_contains(w.b, o.seq) AS hit
        FROM w1 w JOIN o1 o ON o.bin = w.bin AND o.rk = w.rk + 1)),
cand AS (SELECT docs.*, count(*) OVER (PARTITION BY docs.bin) AS n FROM w1 JOIN docs ON docs.doc_id = w1.kept),
steps AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY phase, n, bin, h, doc_id) AS st FROM (
  SELECT 1 AS phase, n, bin, h, doc_id, cl, seq FROM cand
  UNION ALL SELECT 2, 0, 0, h, doc_id, cl, seq FROM docs)),
w2(st, bin, inbin, total, a, b, kept) AS (
  SELECT 0::BIGINT, -1, 0::BIGINT, 0::BIGINT, []::VARCHAR[], []::VARCHAR[], NULL::BIGINT
  UNION ALL
  SELECT st, bin, CASE WHEN take THEN prior + 1 ELSE prior END, CASE WHEN take THEN total + 1 ELSE total END,
    CASE WHEN take THEN list_append(a, cl) ELSE a END, CASE WHEN take THEN list_append(b, seq) ELSE b END,
    CASE WHEN take THEN doc_id END
  FROM (SELECT s.st, s.bin, s.cl, s.seq, s.doc_id, w.total, w.a, w.b,
          CASE WHEN s.bin = w.bin THEN w.inbin ELSE 0 END AS prior,
          NOT list_contains(w.a, s.cl) AND NOT list_contains(w.b, s.seq) AND w.total < {PICK_N} AND (s.phase = 2 OR
            CASE WHEN s.bin = w.bin THEN w.inbin ELSE 0 END < {PICK_N // 30}) AS take
        FROM w2 w JOIN steps s ON s.st = w.st + 1)),
got AS (SELECT docs.*, row_number() OVER (ORDER BY docs.bin, n_chars, docs.doc_id) AS rn FROM w2 JOIN docs ON docs.doc_id = w2.kept)
SELECT 'record-' || lpad(rn::VARCHAR, 4, '0') AS record_id,
  CASE bin {" ".join(f"WHEN {i} THEN '{n}'" for i, (n, _, _) in enumerate(PICK_BINS))} END AS length_bin, doc_id, n_chars FROM got"""


@query("stratified_pick", PICK_SQL)
def stratified_pick(t):
    # a document without an id or a text has no key and is never picked
    docs = t.documents.where("doc_id IS NOT NULL AND text IS NOT NULL").select(
        "doc_id", "n_chars", F.floor(F.col("doc_id") / 2).alias("cluster"), F.sha2("text", 256).alias("content"))
    return G.stratified_pick(docs, "doc_id", "n_chars", "cluster", "content", PICK_BINS, PICK_N, seed=13, strict=False).select(
        "record_id", "length_bin", "doc_id", "n_chars")


@query("token_batches", """WITH RECURSIVE
o AS MATERIALIZED (SELECT doc_id, n_chars, row_number() OVER (ORDER BY n_chars, doc_id) AS rk FROM documents),
w(rk, doc_id, n_chars, batch, filled) AS (
  SELECT 0::BIGINT, NULL::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT UNION ALL
  SELECT o.rk, o.doc_id, o.n_chars,
    CASE WHEN o.n_chars > 20000 THEN w.batch + CASE WHEN w.filled > 0 THEN 1 ELSE 0 END
         WHEN o.n_chars * (w.filled + 1) <= 20000 THEN w.batch ELSE w.batch + CASE WHEN w.filled > 0 THEN 1 ELSE 0 END END,
    CASE WHEN o.n_chars > 20000 THEN 1 WHEN o.n_chars * (w.filled + 1) <= 20000 THEN w.filled + 1 ELSE 1 END
  FROM w JOIN o ON o.rk = w.rk + 1)
SELECT doc_id, n_chars, batch FROM w WHERE rk > 0""")
def token_batches(t):
    return G.token_batches(t.documents.select("doc_id", "n_chars"), "doc_id", "n_chars", budget=20000)


@query("shard_plan", """WITH RECURSIVE
o AS MATERIALIZED (SELECT doc_id, 512 + CAST(ceil(n_chars / 512.0) AS BIGINT) * 512 AS p, row_number() OVER (ORDER BY doc_id) AS rk FROM documents),
w(rk, doc_id, p, shard, used) AS (
  SELECT 0::BIGINT, NULL::BIGINT, 0::BIGINT, 0::BIGINT, 0::BIGINT UNION ALL
  SELECT o.rk, o.doc_id, o.p, CASE WHEN w.used > 0 AND w.used + o.p > 16384 THEN w.shard + 1 ELSE w.shard END,
    CASE WHEN w.used > 0 AND w.used + o.p > 16384 THEN o.p ELSE w.used + o.p END
  FROM w JOIN o ON o.rk = w.rk + 1)
SELECT doc_id, p AS padded_bytes, shard FROM w WHERE rk > 0""")
def shard_plan(t):
    return G.shard_plan(t.documents.select("doc_id", "n_chars"), "doc_id", "n_chars", 16384, ["doc_id"])


@query("shard_summary", """WITH RECURSIVE
o AS MATERIALIZED (SELECT o_orderkey, 512 + CAST(ceil(o_totalprice / 512.0) AS BIGINT) * 512 AS p, row_number() OVER (ORDER BY o_orderkey) AS rk FROM orders),
pre AS MATERIALIZED (SELECT rk, p, sum(p) OVER (ORDER BY rk) AS cum FROM o),
w(start, shard) AS (
  SELECT 1::BIGINT, 0::BIGINT UNION ALL
  SELECT (SELECT min(f.rk) FROM pre f WHERE f.rk > w.start AND f.cum - (s.cum - s.p) > 8000000), w.shard + 1
  FROM w JOIN pre s ON s.rk = w.start
  WHERE (SELECT min(f.rk) FROM pre f WHERE f.rk > w.start AND f.cum - (s.cum - s.p) > 8000000) IS NOT NULL),
e AS (SELECT start, shard, lead(start) OVER (ORDER BY shard) AS stop FROM w)
SELECT shard, 'shard-' || lpad(shard::VARCHAR, 5, '0') AS name, count(*) AS records, CAST(sum(p) AS BIGINT) AS bytes
FROM e JOIN pre ON rk >= start AND (stop IS NULL OR rk < stop) GROUP BY shard""")
def shard_summary(t):
    orders = t.orders.select("o_orderkey", F.col("o_totalprice").alias("bytes"))
    return G.shard_summary(G.shard_plan(orders, "o_orderkey", "bytes", 8_000_000, ["o_orderkey"]))


CROP_SQL = """
l AS (SELECT l_orderkey AS entry, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS chain,
      CAST(l_quantity AS BIGINT) AS length, l_extendedprice AS d FROM lineitem),
tg AS (SELECT entry, chain, length FROM (SELECT *, row_number() OVER (PARTITION BY entry ORDER BY length DESC, chain) AS rn FROM l) WHERE rn = 1),
c AS MATERIALIZED (SELECT l.entry, l.chain, l.length, row_number() OVER (PARTITION BY l.entry ORDER BY d, l.chain) AS rk
      FROM l JOIN tg ON tg.entry = l.entry AND tg.chain <> l.chain),
w(entry, chain, rk, remaining, kept, start, stop, stopped) AS (
  SELECT entry, chain, 0::BIGINT, 80 - length, 1::BIGINT, 0::BIGINT, length, false FROM tg
  UNION ALL
  SELECT entry, chain, rk, remaining - CASE WHEN take THEN size ELSE 0 END, kept + CASE WHEN take THEN 1 ELSE 0 END,
         CASE WHEN take THEN st END, CASE WHEN take THEN st + size END, over FROM (
    SELECT c.entry, c.chain, c.rk, w.remaining, w.kept, least(c.length, w.remaining) AS size,
      (w.stopped OR w.remaining < 5 OR w.kept >= 4) AS over,
      NOT (w.stopped OR w.remaining < 5 OR w.kept >= 4) AND least(c.length, w.remaining) >= 5 AS take,
      greatest(0, least(c.length // 3 - least(c.length, w.remaining) // 2, c.length - least(c.length, w.remaining))) AS st
    FROM w JOIN c ON c.entry = w.entry AND c.rk = w.rk + 1))
"""


@query("budget_crop", f"""WITH RECURSIVE {CROP_SQL}
SELECT entry, chain, rk AS spatial_rank, start AS crop_start, stop AS crop_end FROM w WHERE start IS NOT NULL""")
def budget_crop(t):
    """Orders as entries, lines as chains; quantity is the length and price the distance."""
    lines = t.lineitem.select(
        F.col("l_orderkey").alias("entry"), "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice",
        F.col("l_quantity").cast("bigint").alias("length"))
    ranked = K.rank_chains(lines, ["l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "length", "l_extendedprice")
    chains = ranked.withColumn("center", F.floor(F.col("length") / 3))
    crops, _ = K.budget_crop(chains, budget=80, max_chains=4, min_length=5)
    return crops.select("entry", "chain", "spatial_rank", F.col("start").alias("crop_start"), F.col("end").alias("crop_end"))


@query("nearest_pair", """
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
tg AS (SELECT label FROM e ORDER BY vec_id LIMIT 1),
p AS (SELECT c.label, list_distance(a.v, c.v) AS d, a.vec_id AS i, c.vec_id AS j
      FROM e a JOIN tg ON a.label = tg.label JOIN e c ON c.label <> tg.label)
SELECT label, round(d, 6) AS distance, i AS target_index, j AS context_index
FROM (SELECT *, row_number() OVER (PARTITION BY label ORDER BY d, i, j) AS rn FROM p) WHERE rn = 1""")
def nearest_pair(t):
    points = t.embeddings.select(F.lit(1).alias("entry"), F.col("label"), "vec_id", F.col("embedding").alias("vec"))
    targets = t.embeddings.agg(F.min_by("label", "vec_id").alias("label")).select(F.lit(1).alias("entry"), "label")
    return P.nearest_pairs(points, ["entry"], "label", "vec_id", "vec", targets, cell=0.05).select(
        "label", F.round("distance", 6).alias("distance"), "target_index", "context_index")


KNN_SQL = """
WITH e AS (SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings),
p AS (SELECT a.label, a.vec_id AS i, b.vec_id AS j, sqrt(pow(list_distance(a.v, b.v), 2) + 1e-6) AS d
      FROM e a JOIN e b ON a.label = b.label),
k AS (SELECT *, row_number() OVER (PARTITION BY label, i ORDER BY d, j) AS rank FROM p QUALIFY rank <= 8)
"""


@query("knn_graph", KNN_SQL + "SELECT label, i, j, rank, round(d, 6) AS dist FROM k")
def knn_graph(t):
    edges = P.knn_edges(t.embeddings, ["label"], "vec_id", "embedding", 8, cell=0.05)
    return edges.withColumn("dist", F.round("dist", 6))


@query("rbf_edges", KNN_SQL + """
SELECT label, i, j, list_transform(range(16), lambda c: round(exp(-pow((d * 10 - (2.0 + c * 20.0 / 15)) / 1.25, 2)), 6)) AS rbf FROM k""")
def rbf_edges(t):
    edges = P.knn_edges(t.embeddings, ["label"], "vec_id", "embedding", 8, cell=0.05)
    return edges.select("label", "i", "j", F.transform(rbf(F.col("dist") * 10), lambda x: F.round(x, 6)).alias("rbf"))
