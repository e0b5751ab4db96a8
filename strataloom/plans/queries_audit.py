"""Queries over expectations, audits, contracts and the work ledger."""

from __future__ import annotations

from pyspark.sql import Window as W, functions as F

from ..functions import canonical as J, text as X
from ..operators import audit as A, clusters as C, contracts as K, ledger as D, schemas as Y, select as S
from ..operators.expect import duplicates, expect
from .queries_splits import COMPONENTS_SQL, SPLIT_SQL, _split_docs
from ..session import shuffle_width
from .registry import query


@query("row_expectations", """
WITH r AS (SELECT l_orderkey, l_quantity BETWEEN 1 AND 50 AS a, l_discount <= 0.05 AS b, l_tax < 0.08 AS c, count(*) OVER () AS n FROM lineitem)
SELECT 'quantity_range' AS rule, max(n) AS checked, count(*) FILTER (NOT a) AS failed, min(l_orderkey) FILTER (NOT a)::VARCHAR AS example FROM r
UNION ALL SELECT 'discount', max(n), count(*) FILTER (NOT b), min(l_orderkey) FILTER (NOT b)::VARCHAR FROM r
UNION ALL SELECT 'tax', max(n), count(*) FILTER (NOT c), min(l_orderkey) FILTER (NOT c)::VARCHAR FROM r""")
def row_expectations(t):
    return expect(t.lineitem, {"quantity_range": F.col("l_quantity").between(1, 50), "discount": F.col("l_discount") <= 0.05,
                               "tax": F.col("l_tax") < 0.08}, "l_orderkey")


@query("ref_audit", """
WITH a AS (SELECT l_orderkey AS k, sum(l_extendedprice) AS p, max(l_returnflag) AS f FROM lineitem GROUP BY 1), b AS (SELECT o_orderkey AS k, o_totalprice AS p, o_orderstatus AS f FROM orders),
j AS (SELECT a.k AS ak, b.k AS bk, a.p AS ap, b.p AS bp, a.f AS af, b.f AS bf FROM a FULL JOIN b ON a.k = b.k)
SELECT 'left_only' AS "check", count(*) FILTER (bk IS NULL) AS failed FROM j UNION ALL SELECT 'right_only', count(*) FILTER (ak IS NULL) FROM j
UNION ALL SELECT 'f_differs', count(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL AND af <> bf) FROM j
UNION ALL SELECT 'p_differs', count(*) FILTER (ak IS NOT NULL AND bk IS NOT NULL AND abs(ap - bp) > greatest(1e-6, 1e-6 * greatest(abs(ap), abs(bp)))) FROM j""")
def ref_audit(t):
    a = t.lineitem.groupBy(F.col("l_orderkey").alias("k")).agg(F.sum("l_extendedprice").alias("p"), F.max("l_returnflag").alias("f"))
    b = t.orders.select(F.col("o_orderkey").alias("k"), F.col("o_totalprice").alias("p"), F.col("o_orderstatus").alias("f"))
    return A.reference_audit(a, b, "k", ["f"], ["p"])


@query("duplicate_keys", "SELECT l_orderkey, l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(t):
    return duplicates(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("index_bounds", """
WITH s AS (SELECT o_custkey AS shard, CAST(max(o_totalprice) AS BIGINT) AS bytes, CAST(max(o_totalprice) AS BIGINT) + CASE WHEN o_custkey % 50 = 0 THEN 1 ELSE 0 END AS disk FROM orders WHERE o_custkey % 20 <> 1 GROUP BY o_custkey),
i AS (SELECT o_orderkey, o_custkey AS shard, CAST(o_totalprice AS BIGINT) - 1000 AS "offset", CAST(o_orderkey % 2000 AS BIGINT) AS size FROM orders)
SELECT o_orderkey, CASE WHEN bytes IS NULL THEN 'unknown_shard' WHEN "offset" < 512 THEN 'offset' WHEN size <= 0 THEN 'size' WHEN "offset" + size > bytes THEN 'past_end'
  WHEN disk <> bytes THEN 'shard_size' END AS problem FROM i LEFT JOIN s USING (shard)""")
def index_bounds(t):
    price = F.round("o_totalprice").cast("bigint")
    shards = t.orders.where("o_custkey % 20 <> 1").groupBy(F.col("o_custkey").alias("shard")).agg(F.round(F.max("o_totalprice")).cast("bigint").alias("bytes"))
    shards = shards.withColumn("disk_bytes", F.col("bytes") + F.when(F.col("shard") % 50 == 0, 1).otherwise(0))
    index = t.orders.select("o_orderkey", F.col("o_custkey").alias("shard"), (price - 1000).alias("offset"), (F.col("o_orderkey") % 2000).alias("size"))
    return A.index_bounds(index, shards).select("o_orderkey", "problem")


@query("split_anchors", """
WITH d AS (SELECT doc_id, text, doc_id // 5 AS cluster, CASE WHEN (doc_id // 5) % 10 = 0 THEN 'valid' WHEN (doc_id // 5) % 10 = 1 THEN 'test' ELSE 'train' END AS split FROM documents),
a AS (SELECT s.doc_id, r.split FROM d s JOIN d r USING (cluster) WHERE s.doc_id % 2 = 1 AND r.doc_id % 2 = 0
  UNION SELECT s.doc_id, r.split FROM d s JOIN d r USING (text) WHERE s.doc_id % 2 = 1 AND r.doc_id % 2 = 0)
SELECT doc_id, string_agg(split, ',' ORDER BY split) AS splits FROM a GROUP BY doc_id""")
def split_anchors(t):
    d = _reference_docs(t).withColumn("content", F.sha2("text", 256))
    out = A.split_anchors(d.where("doc_id % 2 = 1").drop("split"), d.where("doc_id % 2 = 0"), "doc_id", "cluster", "content", "split")
    return out.select("doc_id", F.array_join("splits", ",").alias("splits"))


def _reference_docs(t):
    c = F.floor(F.col("doc_id") / 5)
    return t.documents.select("doc_id", "text", c.alias("cluster"), F.when(c % 10 == 0, "valid").when(c % 10 == 1, "test").otherwise("train").alias("split"))


# oracle of the quarantine: rounds of components over reference and what is left of the stage
def _round_sql(n: int) -> str:
    left = f"left{n}"
    return f"""
both{n} AS MATERIALIZED (SELECT cluster AS c, text AS k FROM ref UNION ALL SELECT cluster, text FROM {left}),
star{n} AS MATERIALIZED (SELECT DISTINCT b.c AS a, m.low AS b FROM both{n} b JOIN (SELECT k, min(c) AS low FROM both{n} GROUP BY k) m USING (k) WHERE b.c <> m.low),
edge{n} AS MATERIALIZED (SELECT a, b FROM star{n} UNION SELECT b, a FROM star{n}),
reach{n}(node, seen) AS (SELECT DISTINCT c, c FROM both{n} UNION SELECT r.node, e.b FROM reach{n} r JOIN edge{n} e ON r.seen = e.a),
label{n} AS MATERIALIZED (SELECT node AS cluster, min(seen) AS canonical FROM reach{n} GROUP BY node),
refs{n} AS MATERIALIZED (SELECT canonical, count(DISTINCT split) AS n, string_agg(DISTINCT split, ',' ORDER BY split) AS splits FROM ref JOIN label{n} USING (cluster) GROUP BY canonical),
placed{n} AS MATERIALIZED (SELECT l.doc_id, l.cluster, l.text, label{n}.canonical, r.n, r.splits FROM {left} l JOIN label{n} USING (cluster) LEFT JOIN refs{n} r USING (canonical)),
left{n + 1} AS MATERIALIZED (SELECT doc_id, text, cluster FROM placed{n} WHERE coalesce(n, 0) <= 1)"""


ROUNDS = 3
INHERIT_SQL = """WITH RECURSIVE
ref AS MATERIALIZED (SELECT doc_id, text, 10000000 + doc_id AS cluster, CASE WHEN c % 10 = 0 THEN 'valid' WHEN c % 10 = 1 THEN 'test' ELSE 'train' END AS split
  FROM (SELECT min(doc_id) AS doc_id, text, min(doc_id) // 5 AS c FROM documents WHERE doc_id % 2 = 0 GROUP BY text)),
left0 AS MATERIALIZED (SELECT doc_id, text, doc_id // 25 AS cluster FROM documents WHERE doc_id % 2 = 1),
""" + ",".join(_round_sql(i) for i in range(ROUNDS))


def _inherited(t):
    """Even documents are the reference, one cluster per text; odd ones the stage, in wider clusters."""
    even = t.documents.where("doc_id % 2 = 0").groupBy("text").agg(F.min("doc_id").alias("doc_id"))
    c = F.floor(F.col("doc_id") / 5) % 10
    ref = even.select("doc_id", "text", (F.col("doc_id") + 10000000).alias("cluster"), F.when(c == 0, "valid").when(c == 1, "test").otherwise("train").alias("split"))
    stage = t.documents.where("doc_id % 2 = 1").select("doc_id", "text", F.floor(F.col("doc_id") / 25).alias("cluster"))
    return C.inherit_splits(stage, ref, "doc_id", "text", "cluster")


@query("inherit_splits", INHERIT_SQL + f"SELECT doc_id, canonical AS cluster, coalesce(splits, 'train') AS split FROM placed{ROUNDS - 1} WHERE coalesce(n, 0) <= 1")
def inherit_splits(t):
    return _inherited(t)["kept"]


@query("quarantined", INHERIT_SQL + " UNION ALL ".join(
    f"{'SELECT' if i == 0 else ' SELECT'} doc_id, cluster AS original_cluster, canonical AS reconciled_cluster, splits AS reference_splits FROM placed{i} WHERE n > 1" for i in range(ROUNDS)))
def quarantined(t):
    return _inherited(t)["quarantined"].withColumn("reference_splits", F.array_join("reference_splits", ","))


@query("rewrite_index", f"""WITH RECURSIVE {COMPONENTS_SQL},
rows_in AS (SELECT doc_id, canonical, doc_id // 3 AS entry FROM docs JOIN label USING (cluster) WHERE doc_id % 31 <> 0)
SELECT d.doc_id // 3 AS entry_id, count(*) AS n_chains, string_agg(DISTINCT canonical, ',' ORDER BY canonical) AS clusters FROM documents d LEFT JOIN rows_in USING (doc_id)
GROUP BY 1 HAVING bool_and(canonical IS NOT NULL)""")
def rewrite_index(t):
    docs = t.documents.select("doc_id", "text", F.floor(F.col("doc_id") / 5).alias("cluster"))
    rows = C.union_clusters(docs, "text", "cluster").where("doc_id % 31 <> 0").select(F.col("doc_id").alias("chain_id"), F.col("canonical").alias("cluster"))
    chains = t.documents.select(F.col("doc_id").alias("chain_id"), F.floor(F.col("doc_id") / 3).alias("entry_id"), F.lit(0).cast("bigint").alias("cluster"))
    records = chains.groupBy("entry_id").agg(F.collect_list("chain_id").alias("chains"))
    _, out = C.rewrite_index(chains, records, rows)
    return out.select("entry_id", F.size("chains").cast("bigint").alias("n_chains"), F.array_join("clusters", ",").alias("clusters"))


@query("release_audit", f"""WITH RECURSIVE {COMPONENTS_SQL}, {SPLIT_SQL},
p AS (SELECT doc_id, text, doc_id // 2 AS entry, canonical, split FROM docs JOIN label USING (cluster) JOIN splits USING (canonical))
SELECT 'duplicate_id' AS rule, 0 AS failed UNION ALL
SELECT 'entry_with_two_targets', count(*) FROM (SELECT entry FROM p GROUP BY 1 HAVING count(*) > 1) UNION ALL
SELECT 'unknown_split_cluster', 0 UNION ALL SELECT 'cluster_in_two_splits', 0 UNION ALL
SELECT 'leak_content', count(*) FROM (SELECT text FROM p GROUP BY 1 HAVING count(DISTINCT split) > 1) UNION ALL
SELECT 'leak_entry', count(*) FROM (SELECT entry FROM p GROUP BY 1 HAVING count(DISTINCT split) > 1) UNION ALL
SELECT 'leak_cluster', count(*) FROM (SELECT canonical FROM p GROUP BY 1 HAVING count(DISTINCT split) > 1)""")
def release_audit(t):
    placed = _split_docs(t)
    splits = placed.select(F.col("canonical").alias("cluster"), "split").distinct()
    rows = placed.select(F.col("doc_id").alias("chain_id"), F.floor(F.col("doc_id") / 2).alias("entry_id"), F.col("canonical").alias("cluster"), F.col("text").alias("sequence"))
    return A.release_audit(rows, splits, None).select("rule", "failed")


@query("region_overlap", """
WITH r AS (SELECT event_id, user_id, event_type = 'purchase' AS p, epoch_ms(ts) // 1000 AS s, epoch_ms(ts) // 1000 + CAST(floor(value * 20) AS BIGINT) AS e FROM events)
SELECT user_id, event_id, EXISTS (SELECT 1 FROM r q WHERE q.user_id = r.user_id AND q.p AND greatest(q.s, r.s) <= least(q.e, r.e)) AS overlaps FROM r WHERE NOT p""")
def region_overlap(t):
    s = F.unix_seconds(F.col("ts").cast("timestamp"))
    regions = t.events.select("user_id", "event_id", (F.col("event_type") == "purchase").alias("p"), s.alias("s"), (s + F.floor(F.col("value") * 20)).alias("e"))
    return K.overlapping_regions(regions, ["user_id"], "s", "e", "p", "event_id")


@query("adjacent_pairs", """
WITH o AS (SELECT conv_id * 100 + turn AS doc_id, string_split(text, ' ') AS d FROM conversations)
SELECT doc_id, CAST(i AS INTEGER) AS "at", d[i + 1] AS "left", d[i + 2] AS "right" FROM (SELECT doc_id, d, unnest(range(0, len(d) - 1)) AS i FROM o)""")
def adjacent_pairs(t):
    """The words of a turn as an order of domains."""
    orders = t.conversations.select((F.col("conv_id") * 100 + F.col("turn")).alias("doc_id"), F.split("text", " ").alias("domain_order"), F.lit(0).alias("order_id"))
    return K.adjacent_pairs(orders).drop("order_id")


@query("candidate_rules", """
WITH c AS (SELECT doc_id, quality, toxic, lang FROM documents LEFT JOIN labels USING (doc_id))
SELECT 'checks_agree' AS rule, count(*) AS checked, count(*) FILTER (quality IS NOT NULL AND quality <> toxic) AS failed FROM c
UNION ALL SELECT 'not_run_without_transcript', count(*), count(*) FILTER (quality IS NULL AND doc_id % 4 <> 0) FROM c""")
def candidate_rules(t):
    c = t.documents.select("doc_id").join(t.labels, "doc_id", "left")
    rows = c.select(
        "doc_id", F.lit("ACDE").alias("protein_sequence"), F.when(F.col("quality").isNotNull(), "GCTTGTGATGAA").alias("cds_sequence"),
        F.col("quality").cast("string").alias("translation_check"), F.lit(None).cast("string").alias("translated_protein_sha256"),
        F.when(F.col("quality").isNotNull(), F.col("toxic").cast("string")).when(F.col("doc_id") % 4 == 0, "not_run").otherwise("passed").alias("check_translation"),
        F.lit("passed").alias("check_immutable"), F.lit("passed").alias("check_length"), F.lit("passed").alias("check_safety"),
        F.lit("rejected").alias("decision"), F.lit(None).cast("map<string,double>").alias("scores"))
    rules = K.candidate_rules()
    return expect(rows, {k: rules[k] for k in ("checks_agree", "not_run_without_transcript")}).drop("example")


@query("schema_report", """
WITH e AS (SELECT CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events)
SELECT '$.k:required' AS rule, count(*) AS checked, 0 AS failed FROM e UNION ALL SELECT '$:extra', count(*), 0 FROM e UNION ALL SELECT '$.k:type', count(*), 0 FROM e
UNION ALL SELECT '$.k:minimum', count(*), count(*) FILTER (k < 10) FROM e UNION ALL SELECT '$.k:maximum', count(*), count(*) FILTER (k > 80) FROM e""")
def schema_report(t):
    schema = {"required": ["k"], "additionalProperties": False, "properties": {"k": {"type": "integer", "minimum": 10, "maximum": 80}}}
    return K.schema_report(t.events, "props", schema).drop("example")


#: An order with its lines: references, objects in arrays, conditions.
ORDER_SCHEMA = {
    "type": "object", "additionalProperties": False, "required": ["key", "status", "total", "date", "lines"],
    "$defs": {"line": {
        "type": "object", "additionalProperties": False, "required": ["number", "quantity"], "properties": {
            "number": {"type": "integer", "minimum": 1, "maximum": 6}, "quantity": {"type": "number", "exclusiveMinimum": 1, "maximum": 49},
            "flag": {"enum": ["N", "R"]}, "shipped": {"type": "string", "format": "date"}}}},
    "properties": {
        "key": {"type": "integer"}, "status": {"enum": ["O", "F"]}, "total": {"type": "number", "minimum": 2000},
        "date": {"type": "string", "format": "date", "pattern": "^199[3-7]-"}, "priority": {"type": "string", "maxLength": 8},
        "lines": {"type": "array", "minItems": 2, "maxItems": 6, "uniqueItems": True, "items": {"$ref": "#/$defs/line"}}},
    "if": {"properties": {"status": {"const": "F"}}}, "then": {"required": ["priority"]},
    "else": {"properties": {"total": {"maximum": 450000}}},
}


@query("schema_orders", """
WITH l AS (SELECT l_orderkey AS k, count(*) AS n, count(DISTINCT (l_linenumber, l_quantity, l_returnflag, CAST(l_shipdate AS DATE))) AS d, max(l_linenumber) AS top,
    min(l_linenumber) AS low, min(l_quantity) AS least, max(l_quantity) AS most, count(*) FILTER (l_returnflag NOT IN ('N', 'R')) AS other FROM lineitem GROUP BY 1),
o AS (SELECT *, o_orderpriority = '5-LOW' AS bare FROM orders LEFT JOIN l ON k = o_orderkey),
f AS (SELECT count(*) AS checked, 0::BIGINT AS "$:type", 0::BIGINT AS "$:extra", 0::BIGINT AS "$.key:required", 0::BIGINT AS "$.status:required", 0::BIGINT AS "$.total:required",
    0::BIGINT AS "$.date:required", count(*) FILTER (n IS NULL) AS "$.lines:required", 0::BIGINT AS "$.key:type", count(*) FILTER (o_orderstatus NOT IN ('O', 'F')) AS "$.status:enum",
    0::BIGINT AS "$.total:type", count(*) FILTER (o_totalprice < 2000) AS "$.total:minimum", 0::BIGINT AS "$.date:type", 0::BIGINT AS "$.date:format",
    count(*) FILTER (year(o_orderdate) NOT BETWEEN 1993 AND 1997) AS "$.date:pattern", 0::BIGINT AS "$.priority:type",
    count(*) FILTER (NOT bare AND length(o_orderpriority) > 8) AS "$.priority:maxLength", 0::BIGINT AS "$.lines:type", count(*) FILTER (n < 2) AS "$.lines:minItems",
    count(*) FILTER (n > 6) AS "$.lines:maxItems", count(*) FILTER (d < n) AS "$.lines:uniqueItems", 0::BIGINT AS "$.lines[]:type", 0::BIGINT AS "$.lines[]:extra",
    0::BIGINT AS "$.lines[].number:required", 0::BIGINT AS "$.lines[].quantity:required", 0::BIGINT AS "$.lines[].number:type", count(*) FILTER (low < 1) AS "$.lines[].number:minimum",
    count(*) FILTER (top > 6) AS "$.lines[].number:maximum", 0::BIGINT AS "$.lines[].quantity:type", count(*) FILTER (least <= 1) AS "$.lines[].quantity:exclusiveMinimum",
    count(*) FILTER (most > 49) AS "$.lines[].quantity:maximum", count(*) FILTER (other > 0) AS "$.lines[].flag:enum", 0::BIGINT AS "$.lines[].shipped:type",
    0::BIGINT AS "$.lines[].shipped:format", count(*) FILTER (o_orderstatus = 'F' AND bare) AS "$.priority:conditional",
    count(*) FILTER (o_orderstatus <> 'F' AND o_totalprice > 450000) AS "$.total:conditional-maximum" FROM o)
SELECT rule, checked, failed FROM (UNPIVOT f ON COLUMNS(* EXCLUDE checked) INTO NAME rule VALUE failed)""")
def schema_orders(t):
    """Every order with its lines as one document under a schema of references, arrays of objects and conditions."""
    line = F.struct(F.col("l_linenumber").alias("number"), F.col("l_quantity").alias("quantity"), F.col("l_returnflag").alias("flag"),
                    F.date_format("l_shipdate", "yyyy-MM-dd").alias("shipped"))
    lines = t.lineitem.groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.collect_list(line).alias("lines"))
    order = F.struct(
        F.col("o_orderkey").alias("key"), F.col("o_orderstatus").alias("status"), F.col("o_totalprice").alias("total"),
        F.date_format("o_orderdate", "yyyy-MM-dd").alias("date"),
        F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("priority"), "lines")
    docs = t.orders.join(lines, "o_orderkey", "left").select("o_orderkey", F.to_json(order).alias("doc"))
    # judging takes far longer than reading: a partition count that adaptive execution does not lower for small bytes
    docs = docs.repartition(shuffle_width(t.spark), F.xxhash64("o_orderkey"))
    return Y.schema_report(docs, "doc", ORDER_SCHEMA).drop("example")


#: A text with its lines and labels: alternatives, negation, rules on elements.
TEXT_SCHEMA = {
    "properties": {
        "lang": {"not": {"enum": ["de"]}}, "source": {"anyOf": [{"const": "src19"}, {"maxLength": 4}]},
        "n_chars": {"type": ["integer", "null"], "multipleOf": 2, "exclusiveMaximum": 3000},
        "lines": {"items": {"minLength": 1}, "maxItems": 10, "uniqueItems": True, "contains": {"minLength": 200}},
        "labels": {"oneOf": [{"required": ["toxic"], "properties": {"toxic": {"const": 1}}},
                             {"required": ["quality"], "properties": {"quality": {"const": 0}}}]}},
    "dependentRequired": {"lang": ["labels"]},
}


@query("schema_documents", """
WITH d AS (SELECT *, string_split(text, chr(10)) AS lines, l.doc_id IS NOT NULL AS told FROM documents LEFT JOIN labels l USING (doc_id))
SELECT doc_id, concat_ws(',', CASE WHEN lang IS NOT NULL AND NOT told THEN '$.labels:dependent' END,
    CASE WHEN told AND (coalesce(toxic = 1, false) = coalesce(quality = 0, false)) THEN '$.labels:oneOf' END,
    CASE WHEN lang = 'de' THEN '$.lang:not' END, CASE WHEN NOT list_bool_or([length(x) >= 200 FOR x IN lines]) THEN '$.lines:contains' END,
    CASE WHEN len(lines) > 10 THEN '$.lines:maxItems' END, CASE WHEN len(list_distinct(lines)) < len(lines) THEN '$.lines:uniqueItems' END,
    CASE WHEN list_bool_or([length(x) < 1 FOR x IN lines]) THEN '$.lines[]:minLength' END,
    CASE WHEN n_chars >= 3000 THEN '$.n_chars:exclusiveMaximum' END, CASE WHEN n_chars % 2 <> 0 THEN '$.n_chars:multipleOf' END,
    CASE WHEN source <> 'src19' AND length(source) > 4 THEN '$.source:anyOf' END) AS broken FROM d""")
def schema_documents(t):
    """The rules that each whole text breaks as a document of lines and labels."""
    doc = F.struct("lang", "source", "n_chars", F.split("text", "\n", -1).alias("lines"), F.when(F.col("told"), F.struct("quality", "toxic")).alias("labels"))
    docs = t.documents.join(t.labels.withColumn("told", F.lit(True)), "doc_id", "left").select("doc_id", F.to_json(doc).alias("doc"))
    return Y.with_broken_rules(docs, "doc", TEXT_SCHEMA).select("doc_id", F.array_join("broken", ",").alias("broken"))


@query("document_identity", """
SELECT event_id, sha256('{"k":' || CAST(json_extract(props, '$.k') AS VARCHAR) || '}') AS identity FROM events""")
def document_identity(t):
    return t.events.select("event_id", J.document_identity(F.col("props")).alias("identity"))


@query("enqueue_collisions", """
WITH i AS (SELECT user_id, event_id, json_extract(props, '$.k')::BIGINT // 50 AS k, row_number() OVER (PARTITION BY user_id ORDER BY event_id) AS n FROM events),
old AS (SELECT user_id, k FROM i WHERE n = 1 AND user_id % 3 > 0), new AS (SELECT user_id, min(k) AS lo, max(k) AS hi FROM i WHERE n > 1 AND n <= 3 OR n = 1 AND user_id % 3 = 0 GROUP BY 1)
SELECT CAST(user_id AS VARCHAR) AS work_id, CASE WHEN lo <> hi OR k <> lo THEN 'collision' WHEN k IS NULL THEN 'new' ELSE 'known' END AS outcome FROM new LEFT JOIN old USING (user_id)""")
def enqueue_collisions(t):
    """The first event of two thirds of the users is stored work; what follows arrives."""
    k = F.floor(F.get_json_object("props", "$.k").cast("bigint") / 50).cast("string")
    nth = F.row_number().over(W.partitionBy("user_id").orderBy("event_id"))
    items = t.events.withColumn("n", nth).where("n <= 3").select("n", "user_id", F.col("user_id").cast("string").alias("work_id"), F.concat(F.lit('{"k":'), k, F.lit("}")).alias("document"))
    stored = (F.col("n") == 1) & (F.col("user_id") % 3 > 0)
    arriving = items.where(~stored).select("work_id", "document")
    new, clash = K.enqueue(items.where(stored).select("work_id", "document"), arriving)
    told = new.select("work_id", F.lit("new").alias("outcome")).union(clash.select("work_id", F.lit("collision").alias("outcome")))
    return arriving.select("work_id").distinct().join(told, "work_id", "left").select("work_id", F.coalesce("outcome", F.lit("known")).alias("outcome"))


# events as a ledger: signups and clicks claim, views renew, purchases and errors finish; two workers
LEDGER_SQL = """
WITH RECURSIVE ev AS (SELECT event_id AS seq, user_id AS work_id, CASE WHEN event_type IN ('signup', 'click') THEN 'claim' WHEN event_type = 'view' THEN 'renew' ELSE 'finish' END AS kind,
  CASE event_type WHEN 'purchase' THEN CASE WHEN event_id % 7 = 0 THEN 'succeeded' ELSE 'retryable' END WHEN 'error' THEN CASE WHEN event_id % 11 = 0 THEN 'failed' ELSE 'retryable' END END AS status,
  'w' || (event_id % 2) AS worker, (epoch_us(ts) // 1000000)::DOUBLE AS tm, floor(value * 3600) AS lease,
  row_number() OVER (PARTITION BY user_id ORDER BY epoch_us(ts) // 1000000, event_id) AS k FROM events),
items AS (SELECT user_id AS work_id, (user_id % 20 + 1)::INTEGER AS max_attempts FROM (SELECT DISTINCT user_id FROM events)),
fold AS (
  SELECT work_id, max_attempts, 0::BIGINT AS k, 'pending' AS state, 0 AS attempts, NULL::VARCHAR AS worker, NULL::DOUBLE AS lease_end,
    NULL::DOUBLE AS tm, NULL::BIGINT AS seq, NULL::VARCHAR AS change, NULL::DOUBLE AS ended, 0 AS ended_attempt, '' AS ended_state FROM items
  UNION ALL
  SELECT work_id, max_attempts, k, CASE change WHEN 'claimed' THEN 'running' WHEN 'renewed' THEN 'running' WHEN 'succeeded' THEN 'completed' WHEN 'failed' THEN 'failed'
      WHEN 'retryable' THEN CASE WHEN attempts < max_attempts THEN 'pending' ELSE 'failed' END ELSE s END,
    attempts + (coalesce(change, '') = 'claimed')::INTEGER, CASE WHEN change = 'claimed' THEN doer WHEN change = 'renewed' OR (change IS NULL AND s = 'running') THEN worker END,
    CASE WHEN change IN ('claimed', 'renewed') THEN tm + lease WHEN change IS NULL AND s = 'running' THEN lease_end END,
    tm, seq, change, CASE WHEN gone THEN lease_end END, attempts, s
  FROM (SELECT *, CASE WHEN kind = 'claim' AND s = 'pending' AND attempts < max_attempts THEN 'claimed' WHEN kind = 'renew' AND s = 'running' AND worker = doer THEN 'renewed'
      WHEN kind = 'finish' AND s = 'running' AND worker = doer THEN status END AS change
    FROM (SELECT f.work_id, f.max_attempts, e.k, e.kind, e.status, e.worker AS doer, e.tm, e.lease, e.seq, f.attempts, f.worker, f.lease_end, f.state = 'running' AND f.lease_end <= e.tm AS gone,
        CASE WHEN f.state = 'running' AND f.lease_end <= e.tm THEN CASE WHEN f.attempts < f.max_attempts THEN 'pending' ELSE 'failed' END ELSE f.state END AS s
      FROM fold f JOIN ev e ON e.work_id = f.work_id AND e.k = f.k + 1))),
final AS (SELECT work_id, max_attempts, arg_max(state, k) AS state, arg_max(attempts, k) AS attempts, arg_max(lease_end, k) AS lease_end FROM (SELECT * REPLACE (coalesce(lease_end, 1e18) AS lease_end) FROM fold) GROUP BY 1, 2),
lapsed AS (SELECT *, state = 'running' AND lease_end <= {now} AS gone FROM final),
changes AS (SELECT work_id, attempts AS attempt, tm, seq, change, state, lease_end FROM fold WHERE change IS NOT NULL
  UNION ALL SELECT work_id, ended_attempt, ended, -1, 'lease_expired', ended_state, NULL FROM fold WHERE ended IS NOT NULL
  UNION ALL SELECT work_id, attempts, lease_end, -1, 'lease_expired', CASE WHEN attempts < max_attempts THEN 'pending' ELSE 'failed' END, NULL FROM lapsed WHERE gone),
states AS (SELECT work_id, max_attempts, attempts, CASE WHEN gone THEN CASE WHEN attempts < max_attempts THEN 'pending' ELSE 'failed' END ELSE state END AS state FROM lapsed)
"""
NOW = 1705500000.0


def ledger_events(events):
    """The events table as ledger events."""
    kind = F.when(F.col("event_type").isin("signup", "click"), "claim").when(F.col("event_type") == "view", "renew").otherwise("finish")
    status = F.when(F.col("event_type") == "purchase", F.when(F.col("event_id") % 7 == 0, "succeeded").otherwise("retryable")).when(
        F.col("event_type") == "error", F.when(F.col("event_id") % 11 == 0, "failed").otherwise("retryable"))
    ts = F.col("ts").cast("timestamp")
    return events.select(ts.alias("ts"), F.col("user_id").cast("string").alias("work_id"), F.col("event_id").alias("seq"), kind.alias("kind"), status.alias("status"),
        F.concat(F.lit("w"), F.col("event_id") % 2).alias("worker_id"), F.unix_seconds(ts).cast("double").alias("at"), F.floor(F.col("value") * 3600).cast("double").alias("lease_seconds"))


def ledger_items(events):
    return events.select(F.col("user_id").cast("string").alias("work_id"), (F.col("user_id") % 20 + 1).cast("int").alias("max_attempts")).distinct()


def _changes(t, now=NOW):
    return D.ledger_changes(ledger_events(t.events), ledger_items(t.events), now)


@query("attempt_table", LEDGER_SQL.format(now=NOW) + """
SELECT work_id::VARCHAR AS work_id, attempt, min(tm) FILTER (change = 'claimed') AS claimed_at, arg_max(lease_end, tm * 1e6 + seq) FILTER (change IN ('claimed', 'renewed')) AS lease_expires_at,
  max(tm) FILTER (change NOT IN ('claimed', 'renewed')) AS finished_at, coalesce(max(change) FILTER (change NOT IN ('claimed', 'renewed')), 'running') AS status FROM changes GROUP BY 1, 2""")
def attempt_table(t):
    return D.attempt_table(_changes(t)).drop("worker_id")


@query("lease_expiry", LEDGER_SQL.format(now=NOW) + "SELECT work_id::VARCHAR AS work_id, state, attempts, max_attempts FROM states")
def lease_expiry(t):
    return D.item_states(_changes(t), ledger_items(t.events)).select("work_id", "state", "attempts", "max_attempts")


@query("ledger_status", LEDGER_SQL.format(now=NOW) + """
SELECT s.state, count(work_id) AS items, CAST(coalesce(sum(attempts), 0) AS BIGINT) AS attempts FROM (SELECT unnest(['pending', 'running', 'completed', 'failed']) AS state) s LEFT JOIN states USING (state) GROUP BY 1""")
def ledger_status(t):
    return D.ledger_status(D.item_states(_changes(t), ledger_items(t.events)))


# the state of the middle of the history: later events are still to come, running items may be past their lease
NEXT_SQL = LEDGER_SQL.format(now=0).replace("FROM events),\nitems", f"FROM events WHERE epoch_us(ts) // 1000000 <= {NOW - 3600}),\nitems")


@query("next_work_item", NEXT_SQL + f"""
SELECT work_id::VARCHAR AS work_id, state, attempts FROM final JOIN (SELECT user_id AS work_id, min(epoch_us(ts)) AS created, max(epoch_us(ts)) % 3 AS priority FROM events GROUP BY 1) USING (work_id)
WHERE attempts < max_attempts AND (state = 'pending' OR (state = 'running' AND lease_end <= {NOW})) ORDER BY priority DESC, created, work_id::VARCHAR LIMIT 1""")
def next_work_item(t):
    """What a claim would take, items past their lease included."""
    past = D.ledger_changes(ledger_events(t.events).where(F.col("at") <= NOW - 3600), ledger_items(t.events))
    micros = F.unix_micros(F.col("ts").cast("timestamp"))
    made = t.events.groupBy(F.col("user_id").cast("string").alias("work_id")).agg(F.min(micros).alias("created_at"), (F.max(micros) % 3).alias("priority"))
    return S.next_work_item(D.item_states(past, ledger_items(t.events)).join(made, "work_id"), NOW).select("work_id", "state", "attempts")


@query("inheritance_audit", """
WITH d AS (SELECT doc_id, text, doc_id // 5 AS cluster, doc_id // 4 AS entry, CASE WHEN (doc_id // 5) % 10 = 0 THEN 'valid' WHEN (doc_id // 5) % 10 = 1 THEN 'test' ELSE 'train' END AS split FROM documents),
s AS (FROM d WHERE doc_id % 2 = 1), r AS (FROM d WHERE doc_id % 2 = 0),
a AS (SELECT s.entry, s.split AS ss, r.split AS rs FROM s JOIN r USING (cluster) UNION SELECT s.entry, s.split, r.split FROM s JOIN r USING (text))
SELECT 'split_differs_from_anchor' AS rule, count(*) AS failed FROM (SELECT DISTINCT entry FROM a WHERE ss <> rs)
UNION ALL SELECT 'anchors_in_two_splits', count(*) FROM (SELECT entry FROM a GROUP BY 1 HAVING count(DISTINCT rs) > 1)
UNION ALL SELECT 'entry_in_both_releases', count(*) FROM s WHERE entry IN (SELECT entry FROM r)""")
def inheritance_audit(t):
    d = _reference_docs(t).withColumn("entry", F.floor(F.col("doc_id") / 4))
    return A.inheritance_audit(d.where("doc_id % 2 = 1"), d.where("doc_id % 2 = 0"), sequence="text", entry="entry").select("rule", "failed")


@query("split_files_audit", """
WITH v AS (SELECT o_custkey AS c FROM orders WHERE o_orderkey % 3 = 0), t AS (SELECT o_custkey AS c FROM orders WHERE o_orderkey % 5 = 0), k AS (SELECT c_custkey AS c FROM customer WHERE c_acctbal > 0)
SELECT 'valid_test_overlap' AS rule, count(*) AS failed FROM (FROM v INTERSECT FROM t) UNION ALL SELECT 'unknown_valid_cluster', count(*) FROM v WHERE c NOT IN (FROM k)
UNION ALL SELECT 'unknown_test_cluster', count(*) FROM t WHERE c NOT IN (FROM k) UNION ALL SELECT 'duplicate_valid_cluster', count(*) FROM (SELECT c FROM v GROUP BY c HAVING count(*) > 1)
UNION ALL SELECT 'duplicate_test_cluster', count(*) FROM (SELECT c FROM t GROUP BY c HAVING count(*) > 1)""")
def split_files_audit(t):
    ids = lambda m: t.orders.where(F.col("o_orderkey") % m == 0).select(F.col("o_custkey").alias("cluster"))
    return A.split_files_audit(t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("cluster")), ids(3), ids(5)).select("rule", "failed")
