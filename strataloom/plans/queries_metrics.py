"""Queries over losses, summaries, comparisons, gates and fingerprints."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import gates as G, metrics as M
from ..operators.audit import matrix_gaps as gaps, pending
from .registry import query

r9 = lambda c: F.round(c, 9)


@query("masked_nll", """
SELECT l_returnflag, count(*) FILTER (l_discount > 0)::DOUBLE AS tokens, round(sum(l_tax) FILTER (l_discount > 0) / count(*) FILTER (l_discount > 0), 9) AS nll,
  round(exp(sum(l_tax) FILTER (l_discount > 0) / count(*) FILTER (l_discount > 0)), 9) AS perplexity,
  round(count(*) FILTER (l_discount > 0 AND l_linestatus = 'F') / count(*) FILTER (l_discount > 0), 9) AS accuracy
FROM lineitem GROUP BY l_returnflag""")
def masked_nll(t):
    out = M.masked_mean(t.lineitem, ["l_returnflag"], F.col("l_tax"), (F.col("l_discount") > 0).cast("int"), F.col("l_linestatus") == "F")
    return out.select("l_returnflag", "tokens", r9("nll").alias("nll"), r9("perplexity").alias("perplexity"), r9("accuracy").alias("accuracy"))


LOGITS_SQL = """
WITH z AS (SELECT label AS g, vec_id, embedding::DOUBLE[] AS e, CAST(vec_id % 64 AS INTEGER) AS y, CASE WHEN vec_id % 5 = 0 THEN 0 ELSE 1 END AS m FROM embeddings),
lp AS (SELECT g, y, m, list_transform(e, lambda x: x - ln(list_sum(list_transform(e, lambda v: exp(v))))) AS lp FROM z)
"""


def _log_probs(t):
    e = t.embeddings.select(F.col("label").alias("g"), F.col("embedding").cast("array<double>").alias("e"), (F.col("vec_id") % 64).cast("int").alias("y"),
                            F.when(F.col("vec_id") % 5 == 0, 0).otherwise(1).alias("m"))
    norm = F.log(F.aggregate("e", F.lit(0.0), lambda a, x: a + F.exp(x)))
    return e.withColumn("norm", norm).select("g", "y", "m", F.transform("e", lambda x: x - F.col("norm")).alias("lp"))


@query("log_prob_nll", LOGITS_SQL + """
SELECT g, sum(m)::DOUBLE AS tokens, round(sum(-lp[y + 1] * m) / sum(m), 9) AS nll, round(exp(sum(-lp[y + 1] * m) / sum(m)), 9) AS perplexity,
  round(sum(CASE WHEN list_position(lp, list_max(lp)) - 1 = y THEN m ELSE 0 END) / sum(m), 9) AS accuracy FROM lp GROUP BY g""")
def log_prob_nll(t):
    out = M.masked_nll(_log_probs(t), ["g"], "lp", "y", "m")
    return out.select("g", "tokens", r9("nll").alias("nll"), r9("perplexity").alias("perplexity"), r9("accuracy").alias("accuracy"))


@query("smoothed_nll", LOGITS_SQL + """
SELECT g, round(sum(-(list_sum(lp) * 0.1 / 64 + lp[y + 1]) / 1.1 * m) / 2000.0, 9) AS training, round(sum(-(list_sum(lp) * 0.1 / 64 + lp[y + 1]) / 1.1 * m) / sum(m), 9) AS inference
FROM lp GROUP BY g""")
def smoothed_nll(t):
    lp = _log_probs(t)
    a = M.smoothed_nll(lp, ["g"], "lp", "y", "m", True).withColumnRenamed("smoothed_nll", "training")
    b = M.smoothed_nll(lp, ["g"], "lp", "y", "m", False).withColumnRenamed("smoothed_nll", "inference")
    return a.join(b, "g").select("g", r9("training").alias("training"), r9("inference").alias("inference"))


@query("structure_scores", """
WITH p AS (SELECT l_returnflag AS s, l_linestatus AS r, sum(l_tax) FILTER (l_quantity > 25) / count(*) FILTER (l_quantity > 25) AS score, sum(l_tax) / count(*) AS g FROM lineitem GROUP BY 1, 2)
SELECT s, round(avg(score), 9) AS score_mean, round(stddev_pop(score), 9) AS score_std, round(avg(g), 9) AS global_score_mean, round(stddev_pop(g), 9) AS global_score_std FROM p GROUP BY s""")
def structure_scores(t):
    out = M.structure_scores(t.lineitem.withColumnRenamed("l_returnflag", "s"), ["s"], "l_linestatus", F.col("l_tax"), F.col("l_quantity") > 25, F.lit(1))
    return out.select("s", *[r9(c).alias(c) for c in out.columns[1:]])


@query("sequence_recovery", """
WITH p AS (SELECT a.doc_id // 5 AS cluster, a.doc_id, a.text AS x, b.text AS y, least(length(a.text), length(b.text)) AS n
  FROM documents a JOIN documents b ON b.doc_id = a.doc_id + 1 AND b.doc_id // 5 = a.doc_id // 5)
SELECT cluster, CAST(sum(n) AS BIGINT) AS designable, CAST(sum(mut) AS BIGINT) AS mutations, round(1 - sum(mut) / sum(n), 9) AS recovery FROM (
  SELECT cluster, n, len([i FOR i IN range(1, n + 1) IF substr(x, i, 1) <> substr(y, i, 1)]) AS mut FROM p) GROUP BY cluster""")
def sequence_recovery(t):
    d = t.documents.select("doc_id", "text", F.floor(F.col("doc_id") / 5).alias("cluster"))
    nxt = d.select((F.col("doc_id") - 1).alias("doc_id"), "cluster", F.col("text").alias("other"))
    n, mutations = M.string_recovery(F.col("text"), F.col("other"))
    pairs = d.join(nxt, ["doc_id", "cluster"]).select("cluster", n.alias("n"), mutations.alias("m"))
    out = pairs.groupBy("cluster").agg(F.sum("n").alias("designable"), F.sum("m").alias("mutations"))
    return out.withColumn("recovery", r9(1 - F.col("mutations") / F.col("designable")))


@query("residue_recovery", """
SELECT l_returnflag, count(*) FILTER (l_quantity > 5) AS designable, count(*) FILTER (l_quantity > 5 AND l_linestatus <> CASE WHEN l_partkey % 3 = 0 THEN 'F' ELSE 'O' END) AS mutations,
  round(1 - count(*) FILTER (l_quantity > 5 AND l_linestatus <> CASE WHEN l_partkey % 3 = 0 THEN 'F' ELSE 'O' END) / count(*) FILTER (l_quantity > 5), 9) AS recovery
FROM lineitem GROUP BY 1""")
def residue_recovery(t):
    out = M.sequence_recovery(t.lineitem, ["l_returnflag"], F.col("l_linestatus"), F.when(F.col("l_partkey") % 3 == 0, "F").otherwise("O"), F.col("l_quantity") > 5)
    return out.withColumn("recovery", r9("recovery"))


@query("metric_summary", """
WITH l AS (UNPIVOT (SELECT l_returnflag, l_quantity, l_extendedprice, l_discount FROM lineitem) ON l_quantity, l_extendedprice, l_discount INTO NAME metric VALUE value),
s AS (SELECT l_returnflag AS scope, metric, value FROM l UNION ALL SELECT 'overall', metric, value FROM l)
SELECT scope, metric, count(*) AS count, round(avg(value), 6) AS mean, round(median(value), 6) AS median, min(value) AS min, max(value) AS max FROM s GROUP BY 1, 2""")
def metric_summary(t):
    out = M.metric_summary(t.lineitem.select("l_returnflag", "l_quantity", "l_extendedprice", "l_discount"), ["l_quantity", "l_extendedprice", "l_discount"], "l_returnflag")
    return out.select("scope", "metric", "count", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "min", "max")


@query("model_summary", """
WITH l AS (UNPIVOT (SELECT o_orderpriority AS model, o_orderstatus AS record, o_totalprice AS price, o_custkey::DOUBLE AS customer FROM orders) ON price, customer INTO NAME metric VALUE value)
SELECT record, model, metric, count(*) AS count, round(avg(value), 6) AS mean, round(median(value), 6) AS median, min(value) AS min, max(value) AS max FROM l GROUP BY 1, 2, 3
UNION ALL SELECT NULL, model, metric, count(*), round(avg(value), 6), round(median(value), 6), min(value), max(value) FROM l GROUP BY 2, 3""")
def model_summary(t):
    o = t.orders.select(F.col("o_orderpriority").alias("model"), F.col("o_orderstatus").alias("record"), F.col("o_totalprice").alias("price"), F.col("o_custkey").alias("customer"))
    by_model, by_record = M.model_summary(o, "model", "record", ["price", "customer"])
    out = by_record.unionByName(by_model, allowMissingColumns=True)
    return out.select("record", "model", "metric", "count", F.round("mean", 6).alias("mean"), F.round("median", 6).alias("median"), "min", "max")


@query("pearson_by_bin", """
SELECT l_returnflag, round(CASE WHEN count(*) >= 2 AND var_pop(l_quantity) * var_pop(l_extendedprice) > 0 THEN corr(l_quantity, l_extendedprice) END, 6) AS r,
  CAST(CASE WHEN var_pop(1.0) > 0 THEN 1.0 END AS DOUBLE) AS flat FROM lineitem GROUP BY 1""")
def pearson_by_bin(t):
    return t.lineitem.groupBy("l_returnflag").agg(
        F.round(M.safe_corr(F.col("l_quantity"), F.col("l_extendedprice")), 6).alias("r"), M.safe_corr(F.lit(1.0), F.col("l_quantity")).alias("flat"))


PAIR_SQL = """
WITH d AS (SELECT user_id, date_trunc('day', ts) AS day, event_type, avg(value) AS mean_value, count(*)::DOUBLE AS n FROM events WHERE event_type IN ('click', 'view') GROUP BY ALL),
p AS (SELECT a.user_id, a.day, b.mean_value - a.mean_value AS dv, b.n - a.n AS dn FROM d a JOIN d b USING (user_id, day) WHERE a.event_type = 'click' AND b.event_type = 'view')
"""


def _daily(t):
    return t.events.where(F.col("event_type").isin("click", "view")).groupBy("user_id", F.date_trunc("day", "ts").alias("day"), "event_type").agg(
        F.avg("value").alias("mean_value"), F.count("*").cast("double").alias("n"))


@query("paired_delta", PAIR_SQL + "SELECT user_id, CAST(day AS DATE) AS day, round(dv, 6) AS mean_value, dn AS n FROM p")
def paired_delta(t):
    return M.pair_arms(_daily(t), ["user_id", "day"], "event_type", "click", "view", ["mean_value", "n"]).select(
        "user_id", F.col("day").cast("date").alias("day"), F.round("mean_value", 6).alias("mean_value"), "n")


@query("paired_wins", PAIR_SQL + """
SELECT 'mean_value' AS metric, count(*) AS pairs, round(avg(dv), 6) AS mean_delta, count(*) FILTER (dv > 0) AS wins FROM p
UNION ALL SELECT 'n', count(*), round(avg(dn), 6), count(*) FILTER (dn < 0) FROM p""")
def paired_wins(t):
    return M.paired_delta(_daily(t), ["user_id", "day"], "event_type", "click", "view", ["mean_value", "n"], ["n"]).withColumn("mean_delta", F.round("mean_delta", 6))


@query("seed_summary", PAIR_SQL + """
SELECT user_id, count(*) AS seeds, count(*) FILTER (dv < 0) AS wins, round(avg(dv), 6) AS mean_delta, round(min(dv), 6) AS min_delta, round(max(dv), 6) AS max_delta,
  CASE WHEN count(*) FILTER (dv < 0) = count(*) THEN 'consistently_improved' WHEN count(*) FILTER (dv < 0) > 0 THEN 'mixed' ELSE 'not_improved' END AS status FROM p GROUP BY user_id""")
def seed_summary(t):
    deltas = M.pair_arms(_daily(t), ["user_id", "day"], "event_type", "click", "view", ["mean_value"])
    out = M.seed_summary(deltas, "mean_value", ["user_id"])
    return out.select("user_id", "seeds", "wins", *[F.round(c, 6).alias(c) for c in ("mean_delta", "min_delta", "max_delta")], "status")


@query("arm_delta", """
WITH e AS (SELECT l_returnflag, l_linestatus, avg(l_tax) AS nll, exp(avg(l_tax)) AS perplexity, avg(l_discount) AS accuracy FROM lineitem GROUP BY 1, 2)
SELECT a.l_returnflag, round(b.nll - a.nll, 9) AS nll, round(b.perplexity - a.perplexity, 9) AS perplexity, round(b.accuracy - a.accuracy, 9) AS accuracy,
  CASE WHEN b.nll - a.nll < 0 THEN 'improved' ELSE 'not_improved' END AS status
FROM e a JOIN e b USING (l_returnflag) WHERE a.l_linestatus = 'F' AND b.l_linestatus = 'O'""")
def arm_delta(t):
    e = t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(F.avg("l_tax").alias("nll"), F.exp(F.avg("l_tax")).alias("perplexity"), F.avg("l_discount").alias("accuracy"))
    out = M.arm_delta(e, ["l_returnflag"], "l_linestatus", "F", "O")
    return out.select("l_returnflag", *[r9(c).alias(c) for c in ("nll", "perplexity", "accuracy")], "status")


EVAL_SQL = """
WITH ev AS (SELECT p_brand AS label, CASE WHEN p_size % 2 = 0 THEN 'crops' ELSE 'v1' END AS dataset, avg(p_retailprice) AS nll FROM part GROUP BY 1, 2),
w AS (SELECT label, max(nll) FILTER (dataset = 'crops') AS crops, max(nll) FILTER (dataset = 'v1') AS v1 FROM ev GROUP BY label),
g AS (SELECT w.label, w.crops, w.v1, w.crops - b.crops AS cd, w.v1 - b.v1 AS vd FROM w, (SELECT * FROM w WHERE label = 'Brand#1') b WHERE w.label <> 'Brand#1')
"""


def _gated(t):
    ev = t.part.groupBy(F.col("p_brand").alias("label"), F.when(F.col("p_size") % 2 == 0, "crops").otherwise("v1").alias("dataset")).agg(F.avg("p_retailprice").alias("nll"))
    return G.gate(ev, "Brand#1", "crops", "v1", max_regression=20.0)


@query("gate_deltas", EVAL_SQL + """
SELECT label, round(crops, 6) AS crops, round(v1, 6) AS v1, round(cd, 6) AS crops_delta, round(vd, 6) AS v1_delta, coalesce(cd < 0 AND vd <= 20, false) AS passed FROM g""")
def gate_deltas(t):
    g = _gated(t)
    return g.select("label", *[F.round(c, 6).alias(c) for c in ("crops", "v1", "crops_delta", "v1_delta")], "passed")


@query("gate_select", EVAL_SQL + "SELECT label, round(crops, 6) AS crops FROM g WHERE cd < 0 AND vd <= 20 ORDER BY g.crops, label LIMIT 1")
def gate_select(t):
    return G.select_candidate(_gated(t), "crops").select("label", F.round("crops", 6).alias("crops"))


@query("id_fingerprint", """
SELECT o_orderstatus, count(*) AS n_ids, sha256(string_agg(o_orderkey::VARCHAR, chr(10) ORDER BY o_orderdate, o_orderkey)) AS ids_sha256
FROM orders GROUP BY o_orderstatus""")
def id_fingerprint(t):
    return M.fingerprint(t.orders.select("o_orderstatus", "o_orderdate", "o_orderkey"), ["o_orderstatus"], ["o_orderdate", "o_orderkey"], "o_orderkey")


@query("population_match", """
WITH e AS (SELECT o_orderstatus AS dataset, o_orderpriority AS label, count(*) AS records, sha256(string_agg(CAST(o_custkey % 2 AS VARCHAR), chr(10) ORDER BY o_orderkey)) AS h FROM orders GROUP BY 1, 2)
SELECT dataset, count(*) AS evaluations, min(h) = max(h) AS same_ids, min(records) = max(records) AS same_count, max(records) AS records FROM e GROUP BY 1""")
def population_match(t):
    o = t.orders.select("o_orderstatus", "o_orderpriority", "o_orderkey", (F.col("o_custkey") % 2).alias("v"))
    prints = M.fingerprint(o, ["o_orderstatus", "o_orderpriority"], ["o_orderkey"], "v")
    return G.population_match(prints.select(F.col("o_orderstatus").alias("dataset"), F.col("n_ids").alias("records"), "ids_sha256"))


@query("matrix_gaps", """
WITH grid AS (SELECT n_nationkey, c_mktsegment FROM nation, (SELECT DISTINCT c_mktsegment FROM customer)),
seen AS (SELECT DISTINCT c_nationkey AS n_nationkey, c_mktsegment FROM customer WHERE c_acctbal > 9000)
SELECT n_nationkey, c_mktsegment, 'missing' AS state FROM (FROM grid EXCEPT FROM seen) UNION ALL SELECT *, 'unexpected' FROM (FROM seen EXCEPT FROM grid)""")
def matrix_gaps(t):
    seen = t.customer.where("c_acctbal > 9000").select(F.col("c_nationkey").alias("n_nationkey"), "c_mktsegment").distinct()
    return gaps([t.nation.select("n_nationkey"), t.customer.select("c_mktsegment")], seen)


@query("pending_work", "SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels WHERE quality = 1)")
def pending_work(t):
    results = t.labels.select("doc_id", F.when(F.col("quality") == 1, "succeeded").otherwise("failed").alias("status"))
    return pending(t.documents.select("doc_id"), results, ["doc_id"], retry_failed=True)


@query("run_summary", """
SELECT count(*) AS selected, count(*) FILTER (quality = 1) AS succeeded, count(*) FILTER (quality = 0) AS failed, count(*) FILTER (quality IS NULL) AS pending,
  sum(toxic) FILTER (quality = 1)::DOUBLE AS total_seconds, round(avg(toxic) FILTER (quality = 1), 9) AS mean_seconds, max(toxic) FILTER (quality = 1)::DOUBLE AS peak,
  CASE WHEN count(*) FILTER (quality = 1) = count(*) THEN 'passed' WHEN count(*) FILTER (quality = 0) > 0 THEN 'failed' ELSE 'running' END AS status
FROM documents LEFT JOIN labels USING (doc_id)""")
def run_summary(t):
    results = t.labels.select("doc_id", F.when(F.col("quality") == 1, "succeeded").otherwise("failed").alias("status"), "toxic")
    return M.run_summary(t.documents.select("doc_id"), results, "doc_id", "toxic", "toxic").withColumn("mean_seconds", r9("mean_seconds"))


@query("recovery_check", """
WITH m AS (SELECT l_returnflag, avg(l_tax) AS mean_recovery FROM lineitem GROUP BY 1), r AS (SELECT l_returnflag, sum(l_tax) / count(*) + CASE WHEN l_returnflag = 'A' THEN 1e-3 ELSE 0 END AS recorded FROM lineitem GROUP BY 1)
SELECT l_returnflag, round(mean_recovery, 9) AS mean_recovery, round(recorded, 9) AS recorded, abs(mean_recovery - recorded) <= 1e-9 AS ok FROM m JOIN r USING (l_returnflag)""")
def recovery_check(t):
    recorded = t.lineitem.groupBy("l_returnflag").agg((F.sum("l_tax") / F.count("*") + F.when(F.col("l_returnflag") == "A", 1e-3).otherwise(0.0)).alias("mean_recovery"))
    out = M.recovery_check(t.lineitem.select("l_returnflag", "l_tax"), "l_returnflag", "l_tax", recorded, 1e-9)
    return out.select("l_returnflag", r9("mean_recovery").alias("mean_recovery"), r9("recorded").alias("recorded"), "ok")


@query("kept_totals", """
SELECT count(*) AS lines, CAST(sum(l_quantity) AS DOUBLE) AS quantity FROM lineitem WHERE l_orderkey IN (SELECT o_orderkey FROM orders WHERE o_orderstatus = 'F')""")
def kept_totals(t):
    lines = t.lineitem.select(F.col("l_orderkey").alias("k"), "l_quantity", F.lit(1).alias("one"))
    kept = t.orders.where("o_orderstatus = 'F'").select(F.col("o_orderkey").alias("k"))
    return M.kept_totals(lines, kept, "k", {"lines": "one", "quantity": "l_quantity"})


@query("inventory", "SELECT count(*) AS n_rows, count(DISTINCT source) AS n_clusters, count(DISTINCT source) = 20 AS as_expected FROM documents")
def inventory(t):
    return M.inventory(t.documents.select("source"), "source", expected={"n_clusters": 20})


METRICS_SQL = """
WITH p AS (SELECT label AS record, vec_id AS pos, embedding[1]::DOUBLE * 20 AS x, embedding[2]::DOUBLE * 20 AS y, embedding[3]::DOUBLE * 20 AS z,
  (embedding[1]::DOUBLE + 0.1 * embedding[4]::DOUBLE) * 20 AS u, (embedding[2]::DOUBLE + 0.1 * embedding[5]::DOUBLE) * 20 AS v, (embedding[3]::DOUBLE + 0.1 * embedding[6]::DOUBLE) * 20 AS w FROM embeddings),
c AS (SELECT a.record, sqrt((a.x-b.x)**2 + (a.y-b.y)**2 + (a.z-b.z)**2) AS n, sqrt((a.u-b.u)**2 + (a.v-b.v)**2 + (a.w-b.w)**2) AS m
  FROM p a JOIN p b ON a.record = b.record AND a.pos <> b.pos)
SELECT record, count(*) AS contacts, round(avg(((abs(n-m) <= 0.5)::INT + (abs(n-m) <= 1)::INT + (abs(n-m) <= 2)::INT + (abs(n-m) <= 4)::INT) / 4.0), 9) AS lddt FROM c WHERE n <= 15.0 GROUP BY record"""


def _points(t):
    e = lambda i: F.get("embedding", F.lit(i)).cast("double")
    point = lambda f: F.struct(*[f(i).alias(a) for i, a in enumerate("xyz")])
    return t.embeddings.select(F.col("label").alias("record"), F.col("vec_id").alias("pos"), point(lambda i: e(i) * 20).alias("native"),
                               point(lambda i: (e(i) + 0.1 * e(i + 3)) * 20).alias("model"), (F.col("vec_id") % 9 != 0).alias("mask"))


@query("contact_agreement", METRICS_SQL)
def contact_agreement(t):
    from ..operators.pairs import contact_agreement as agree
    p = _points(t).select("record", "pos", F.array("native.x", "native.y", "native.z").alias("n"), F.array("model.x", "model.y", "model.z").alias("m"))
    return agree(p, ["record"], "pos", "n", "m").withColumn("lddt", r9("lddt"))


def _superposition_sql() -> str:
    """The fit by sums, a squared quaternion matrix and its first direction; then distances of the moved points."""
    sums = ", ".join(f"sum({m} * {n}) - sum({m}) * sum({n}) / count(*) AS {m}{n}" for m in "uvw" for n in "xyz")
    spread = " + ".join(f"sum({c} * {c}) - sum({c}) * sum({c}) / count(*)" for c in "xyzuvw")
    k = ("ux + vy + wz, vz - wy, wx - uz, uy - vx, vz - wy, ux - vy - wz, uy + vx, wx + uz, "
         "wx - uz, uy + vx, vy - ux - wz, vz + wy, uy - vx, wx + uz, vz + wy, wz - ux - vy")
    square = " + ".join(f"m[4 * (i // 4) + {j + 1}] * m[{4 * j} + i % 4 + 1]" for j in range(4))
    moved = {"x": "(w * w + a * a - b * b - c * c) * (u - mu) + 2 * (a * b - w * c) * (v - mv) + 2 * (a * c + w * b) * (o - mw)",
             "y": "2 * (a * b + w * c) * (u - mu) + (w * w - a * a + b * b - c * c) * (v - mv) + 2 * (b * c - w * a) * (o - mw)",
             "z": "2 * (a * c - w * b) * (u - mu) + 2 * (b * c + w * a) * (v - mv) + (w * w - a * a - b * b + c * c) * (o - mw)"}
    off = " + ".join(f"({m} - ({n} - m{n})) ** 2" for n, m in moved.items())
    scale = lambda size: f"greatest(0.5, 1.24 * cbrt(greatest({size} - 15, 0)) - 1.8)"
    local = METRICS_SQL.replace("FROM embeddings)", "FROM embeddings WHERE vec_id % 9 <> 0)").replace(", 9) AS lddt", ", 6) AS ca_lddt").removeprefix("\nWITH ")
    points, local = local.split("),\n", 1)
    return f"""
WITH {points}),
total AS (SELECT label AS record, count(*) AS length FROM embeddings GROUP BY 1),
s AS (SELECT record, count(*)::DOUBLE AS n, {", ".join(f"avg({c}) AS m{c}" for c in "xyzuvw")}, {spread} AS g, {sums} FROM p GROUP BY 1),
k AS (SELECT *, [{k}] AS k FROM s),
f AS (SELECT *, list_reduce(list_prepend(list_transform(range(16), lambda i: k[i + 1] + CASE WHEN i % 5 = 0 THEN g / 2 ELSE 0 END), list_transform(range(40), lambda i: [0::DOUBLE])),
  lambda m, t: list_transform(range(16), lambda i: ({square}) / list_sum(list_transform(m, lambda e: e * e)))) AS m FROM k),
t AS (SELECT *, list_position([m[1], m[6], m[11], m[16]], greatest(m[1], m[6], m[11], m[16])) AS top FROM f),
r AS (SELECT *, m[4 * top - 3:4 * top] AS v FROM t),
q AS (SELECT *, list_transform(v, lambda e: e / sqrt(list_sum(list_transform(v, lambda d: d * d)))) AS q FROM r),
d AS (SELECT record, n, length, {off} AS d2 FROM (
  SELECT p.record, n, length, x, y, z, u, v, w AS o, mx, my, mz, mu, mv, mw, q[1] AS w, q[2] AS a, q[3] AS b, q[4] AS c
  FROM (SELECT record, x, y, z, u, v, w FROM p) p JOIN (SELECT record, n, mx, my, mz, mu, mv, mw, q FROM q) USING (record) JOIN total USING (record))),
whole AS (SELECT record, max(n)::BIGINT AS resolved, max(length) AS length, round(sqrt(avg(d2)), 6) AS ca_rmsd,
  round(sum(1 / (1 + d2 / {scale("n")} ** 2)) / max(n), 6) AS tm_resolved, round(sum(1 / (1 + d2 / {scale("length")} ** 2)) / max(length), 6) AS tm_full FROM d GROUP BY 1),
{local.replace("\nSELECT record, count(*)", ",\nlddt AS (SELECT record, count(*)")})
SELECT record, resolved, length, ca_rmsd, tm_resolved, tm_full, ca_lddt FROM whole LEFT JOIN lddt USING (record)"""


@query("structure_metrics", _superposition_sql())
def structure_metrics(t):
    """Superposition metrics of points against a disturbed copy, one record per label."""
    out = M.structure_metrics(_points(t), ["record"], "pos", "native", "model", "mask")
    return out.select("record", "resolved", "length", *[F.round(c, 6).alias(c) for c in ("ca_rmsd", "tm_resolved", "tm_full", "ca_lddt")])


@query("argmin_passing", "SELECT p_partkey, p_retailprice FROM part WHERE p_size >= 30 AND p_brand <> 'Brand#1' ORDER BY p_retailprice, p_partkey LIMIT 1")
def argmin_passing(t):
    from ..operators.select import argmin_passing as pick
    part = t.part.select("p_partkey", "p_retailprice", "p_size", "p_brand")
    return pick(part, (F.col("p_size") >= 30) & (F.col("p_brand") != "Brand#1"), "p_retailprice", "p_partkey").select("p_partkey", "p_retailprice")


@query("record_join", """
SELECT CASE WHEN a.c_custkey IS NULL THEN 'missing_experimental' WHEN b.c_custkey IS NULL THEN 'missing_native_prediction' WHEN c.c_custkey IS NULL THEN 'missing_baseline' END AS problem, count(*) AS n
FROM orders LEFT JOIN (FROM customer WHERE c_acctbal > 0) a ON a.c_custkey = o_custkey LEFT JOIN (FROM customer WHERE c_nationkey < 20) b ON b.c_custkey = o_custkey
LEFT JOIN (FROM customer WHERE c_mktsegment <> 'MACHINERY') c ON c.c_custkey = o_custkey GROUP BY 1""")
def record_join(t):
    c = t.customer.withColumnRenamed("c_custkey", "k")
    designs = t.orders.select(F.col("o_custkey").alias("k"), "o_orderkey")
    joined = G.record_join(designs, c.where("c_acctbal > 0").select("k", "c_acctbal"), c.where("c_nationkey < 20").select("k", "c_nationkey"),
                           c.where("c_mktsegment <> 'MACHINERY'").select("k", "c_mktsegment"), "k")
    return joined.groupBy("problem").agg(F.count("*").alias("n"))


@query("flatten_metrics", """
SELECT metric, count(*) AS pairs, round(avg(value), 6) AS mean FROM (UNPIVOT (SELECT l_tax AS recovery, 1 - l_tax AS mutation_fraction, l_discount AS score FROM lineitem)
ON recovery, mutation_fraction, score INTO NAME metric VALUE value) GROUP BY 1""")
def flatten_metrics(t):
    nested = t.lineitem.select("l_orderkey", F.struct(F.struct(F.col("l_tax").alias("recovery")).alias("sequence"), F.col("l_discount").alias("score")).alias("result"))
    flat = M.flatten_metrics(nested, {"recovery": "result.sequence.recovery", "score": "result.score"}, ["l_orderkey"], {"mutation_fraction": "recovery"})
    return M.to_long(flat, ["l_orderkey"], ["recovery", "score", "mutation_fraction"]).groupBy("metric").agg(
        F.count("*").alias("pairs"), F.round(F.avg("value"), 6).alias("mean"))


def _backbone(t):
    """Vectors as residues: four groups of three coordinates, one structure per label."""
    e = lambda i: F.get("embedding", F.lit(i)).cast("double") * 20
    atom = lambda at: F.struct(*[e(at + i).alias(a) for i, a in enumerate("xyz")])
    return t.embeddings.select(F.col("label").alias("structure"), F.col("vec_id").alias("idx"), (F.col("vec_id") % 3).alias("chain_no"), F.lit(True).alias("mask"),
                               atom(0).alias("n"), atom(3).alias("ca"), atom(6).alias("c"), atom(9).alias("o"))


@query("edge_features", """
WITH r AS (SELECT label AS structure, vec_id AS idx, vec_id % 3 AS c, list_transform(embedding::DOUBLE[], lambda x: x * 20) AS v FROM embeddings),
p AS (SELECT a.structure, a.idx AS i, b.idx AS j, a.c AS ac, b.c AS bc, a.v AS av, b.v AS bv, sqrt(pow(list_distance(a.v[4:6], b.v[4:6]), 2) + 1e-6) AS d FROM r a JOIN r b USING (structure)),
k AS (SELECT *, row_number() OVER (PARTITION BY structure, i ORDER BY d, j) AS rank FROM p QUALIFY rank <= 6)
SELECT structure, i, j, rank, round(d, 6) AS dist, CAST(CASE WHEN ac = bc THEN least(greatest(i - j + 32, 0), 64) ELSE 65 END AS INTEGER) AS "offset",
  round(sqrt(pow(list_distance(av[1:3], bv[1:3]), 2) + 1e-6), 6) AS n_n, round(sqrt(pow(list_distance(av[4:6], bv[1:3]), 2) + 1e-6), 6) AS ca_n,
  round(sqrt(pow(list_distance(av[7:9], bv[10:12]), 2) + 1e-6), 6) AS c_o FROM k""")
def edge_features(t):
    from ..operators.features import edge_features as edges
    out = edges(_backbone(t), ["structure"], "idx", 6)
    at = lambda i: F.round(F.get("distances", F.lit(i)), 6)
    return out.select("structure", "i", "j", "rank", F.round("dist", 6).alias("dist"), "offset", at(1).alias("n_n"), at(5).alias("ca_n"), at(24).alias("c_o"))


@query("trace_frames", """
WITH s AS (SELECT label AS structure, vec_id AS idx, embedding[4]::DOUBLE * 20 AS x FROM embeddings)
SELECT structure, idx, coalesce(lag(x) OVER w, 0) AS before_x, coalesce(lead(x) OVER w, 0) AS after_x FROM s WINDOW w AS (PARTITION BY structure ORDER BY idx)""")
def trace_frames(t):
    from ..operators.features import trace_frames as frames
    return frames(_backbone(t), ["structure"], "idx").select("structure", "idx", F.col("ca_before.x").alias("before_x"), F.col("ca_after.x").alias("after_x"))
