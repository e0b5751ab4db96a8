"""Queries over cluster union, splits, inheritance and leak audits."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import clusters as C
from .registry import query

# oracle: clusters joined by equal text, least id per component by walking the edges
COMPONENTS_SQL = """
docs AS (SELECT doc_id, text, doc_id // 5 AS cluster FROM documents),
star AS (SELECT DISTINCT d.cluster AS a, m.low AS b FROM docs d
         JOIN (SELECT text, min(cluster) AS low FROM docs GROUP BY text) m USING (text) WHERE d.cluster <> m.low),
edge AS (SELECT a, b FROM star UNION SELECT b, a FROM star),
reach(node, seen) AS (
  SELECT DISTINCT cluster, cluster FROM docs
  UNION
  SELECT reach.node, edge.b FROM reach JOIN edge ON reach.seen = edge.a),
label AS (SELECT node AS cluster, min(seen) AS canonical FROM reach GROUP BY node)
"""
SPLIT_SQL = """
ranked AS (SELECT canonical, row_number() OVER (ORDER BY sha256('7' || chr(0) || canonical), canonical) AS rk,
           count(*) OVER () AS n FROM (SELECT DISTINCT canonical FROM label)),
sized AS (SELECT canonical, rk,
          CASE WHEN n >= 3 THEN greatest(1, floor(n * 0.1)) ELSE 0 END AS nv,
          CASE WHEN n >= 3 THEN greatest(1, floor(n * 0.1)) ELSE 0 END AS nt FROM ranked),
splits AS (SELECT canonical, CASE WHEN rk <= nv THEN 'valid' WHEN rk <= nv + nt THEN 'test' ELSE 'train' END AS split
           FROM sized)
"""


def _docs(t):
    return t.documents.select("doc_id", "text", F.floor(F.col("doc_id") / 5).alias("cluster"))


def _split_docs(t):
    united = C.union_clusters(_docs(t), "text", "cluster")
    splits = C.assign_splits(united, "canonical", 0.1, 0.1, seed=7)
    return C.label_split(united, splits, "canonical")


@query("cluster_union", f"""WITH RECURSIVE {COMPONENTS_SQL}
SELECT doc_id, docs.cluster AS cluster, canonical FROM docs JOIN label USING (cluster)""")
def cluster_union(t):
    return C.union_clusters(_docs(t), "text", "cluster").select("doc_id", "cluster", "canonical")


@query("cluster_union_stats", f"""WITH RECURSIVE {COMPONENTS_SQL}
SELECT (SELECT count(*) FROM (SELECT text FROM docs GROUP BY text HAVING count(DISTINCT cluster) > 1)) AS conflicting_keys,
       (SELECT count(*) FROM label WHERE cluster <> canonical) AS clusters_merged""")
def cluster_union_stats(t):
    return C.union_stats(C.union_clusters(_docs(t), "text", "cluster"), "text", "cluster")


@query("split_assignment", f"""WITH RECURSIVE {COMPONENTS_SQL}, {SPLIT_SQL}
SELECT canonical, split FROM splits""")
def split_assignment(t):
    return C.assign_splits(C.union_clusters(_docs(t), "text", "cluster"), "canonical", 0.1, 0.1, seed=7)


@query("split_leak_audit", f"""WITH RECURSIVE {COMPONENTS_SQL}, {SPLIT_SQL},
placed AS (SELECT doc_id, text, canonical, split FROM docs JOIN label USING (cluster) JOIN splits USING (canonical))
SELECT split, count(*) AS n_rows, count(DISTINCT canonical) AS n_clusters,
  (SELECT count(*) FROM (SELECT text FROM placed GROUP BY text HAVING count(DISTINCT split) > 1)) AS content_leaks,
  (SELECT count(*) FROM (SELECT canonical FROM placed GROUP BY canonical HAVING count(DISTINCT split) > 1)) AS cluster_leaks
FROM placed GROUP BY split""")
def split_leak_audit(t):
    placed = _split_docs(t).withColumn("h", F.sha2("text", 256)).drop("text")
    leaks = C.leak_report(placed, "split", {"content": F.col("h"), "cluster": F.col("canonical")}).agg(
        F.sum(F.when(F.col("key") == "content", F.col("leaks"))).alias("content_leaks"),
        F.sum(F.when(F.col("key") == "cluster", F.col("leaks"))).alias("cluster_leaks"))
    per_split = placed.groupBy("split").agg(
        F.count("*").alias("n_rows"), F.count_distinct("canonical").alias("n_clusters"))
    return per_split.crossJoin(leaks)
