"""Queries over documents that need no model."""

from __future__ import annotations

from pyspark.sql import functions as F

from . import chat, decontamination, mixing, repair, secrets
from .queries import query

_WORDS = r"list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '')"

DECONTAMINATION_SQL = rf"""
WITH item AS (SELECT item_id::VARCHAR AS item, {_WORDS} AS ws FROM benchmark WHERE item_id IS NOT NULL),
gram AS (
  SELECT DISTINCT item, least(len(ws), 10) AS size, array_to_string(ws[i:i + 9], ' ') AS gram
  FROM item, LATERAL unnest(generate_series(1, greatest(len(ws) - 9, 1))) AS s(i) WHERE len(ws) > 0),
doc AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS ws FROM documents),
size AS (SELECT DISTINCT size FROM gram),
win AS (
  SELECT r, size, i, array_to_string(ws[i:i + size - 1], ' ') AS gram
  FROM doc, size, LATERAL unnest(generate_series(1, len(ws) - size + 1)) AS s(i)),
hit AS (SELECT r, i, gram.size, item FROM win JOIN gram ON gram.gram = win.gram AND gram.size = win.size),
word AS (SELECT DISTINCT r, unnest(generate_series(i, i + size - 1)) AS w FROM hit),
n AS (SELECT r, count(*) AS n_hit FROM word GROUP BY r),
it AS (SELECT r, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT r, item FROM hit) GROUP BY r)
SELECT doc_id, len(ws)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
  sha256(coalesce(items, '')) AS items_sha256, n_hit IS NOT NULL AS contaminated
FROM doc LEFT JOIN n USING (r) LEFT JOIN it USING (r)"""


@query("op2_decontaminate", DECONTAMINATION_SQL)
def op2_decontaminate(table):
    """Words of benchmark windows in every document."""
    found = decontamination.contamination(table("documents"), table("benchmark"))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def mixing_sql(docs: str = "documents", rounds: int = 8, powers=(0.5, 0.5, 0.0), share: float = 0.5) -> str:
    """The raking unrolled: one CTE per margin and round."""
    counts = ", ".join(f"length(s) - length(translate(s, '{g}', ''))" for g in mixing.INITIALS)
    ctes = [f"""marked AS (SELECT *, 't' || list_position(c, list_max(c)) AS topic FROM (SELECT *, [{counts}] AS c FROM (
  SELECT *, coalesce(source, '') AS src, coalesce(lang, '') AS lng, (coalesce(strlen(text), 0) + 3) // 4 AS tokens,
    array_to_string(list_transform(string_split(coalesce(text, ''), ' '), lambda w: w[1]), '') AS s FROM {docs})))""",
        "total AS (SELECT sum(tokens)::DOUBLE AS t FROM marked)",
        "c0 AS MATERIALIZED (SELECT src, lng, topic, sum(tokens)::DOUBLE AS tk, sum(tokens)::DOUBLE / (SELECT t FROM total) AS w FROM marked GROUP BY ALL HAVING sum(tokens) > 0)"]
    columns = ("src", "lng", "topic")
    for m, p in zip(columns, powers, strict=True):
        ctes.append(f"g_{m} AS MATERIALIZED (SELECT {m}, power(sum(tk), {p}) / sum(power(sum(tk), {p})) OVER () AS goal FROM c0 GROUP BY {m})")
    k = 0
    for _ in range(rounds):
        for m in columns:
            ctes.append(f"c{k + 1} AS MATERIALIZED (SELECT src, lng, topic, tk, w * goal / sum(w) OVER (PARTITION BY {m}) AS w FROM c{k} JOIN g_{m} USING ({m}))")
            k += 1
    return "WITH " + ",\n".join(ctes) + f""",
rated AS (SELECT doc_id, marked.topic, tokens, CASE WHEN tokens > 0 THEN w * {share} * (SELECT t FROM total) / tk ELSE 0 END AS rate
  FROM marked LEFT JOIN c{k} USING (src, lng, topic))
SELECT doc_id, tokens, topic, round(rate, 6) AS rate,
  (floor(rate) + CASE WHEN ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 8))::BIGINT / 4294967296.0 < rate - floor(rate) THEN 1 ELSE 0 END)::BIGINT AS copies
FROM rated"""


@query("op3_mixing", mixing_sql())
def op3_mixing(table):
    """Expected and drawn copies of every document under raked source, language and topic weights."""
    docs = table("documents")
    mixed = mixing.mix(docs, mixing.mixing_rates(docs))
    return mixed.select("doc_id", "tokens", "topic", F.round("rate", 6).alias("rate"), "copies")


CHAT_SQL = r"""
WITH t AS (
  SELECT DISTINCT conv_id, coalesce(turn, -1)::BIGINT AS turn, coalesce(role, '') AS role, coalesce(text, '') AS text
  FROM conversations WHERE conv_id IS NOT NULL),
n AS (SELECT *, (conv_id - (conv_id % 2 + 2) % 2) // 2 AS pair_id, (conv_id % 2 + 2) % 2 AS odd, row_number() OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS i,
  '<|' || role || '|>' || chr(10) AS head, text || '<|end|>' || chr(10) AS body FROM t),
pair AS (SELECT pair_id, max(CASE WHEN odd = 0 THEN conv_id END) AS chosen_id, max(CASE WHEN odd = 1 THEN conv_id END) AS rejected_id,
  coalesce(max(i) FILTER (odd = 0), 0) AS nc, coalesce(max(i) FILTER (odd = 1), 0) AS nr FROM n GROUP BY pair_id),
off AS (SELECT a.pair_id, min(a.i) - 1 AS k FROM n a JOIN n b ON a.pair_id = b.pair_id AND a.i = b.i AND a.odd = 0 AND b.odd = 1
  WHERE a.role <> b.role OR a.text <> b.text GROUP BY a.pair_id),
common AS (SELECT pair.*, coalesce(k, least(nc, nr)) AS n_common FROM pair LEFT JOIN off USING (pair_id))
SELECT pair_id, any_value(chosen_id) AS chosen_id, any_value(rejected_id) AS rejected_id, any_value(n_common)::BIGINT AS n_common,
  coalesce(string_agg(head || body, '' ORDER BY i) FILTER (odd = 0 AND i <= n_common), '') AS prompt,
  coalesce(string_agg(head || body, '' ORDER BY i) FILTER (odd = 0 AND i > n_common), '') AS chosen,
  coalesce(string_agg(head || body, '' ORDER BY i) FILTER (odd = 1 AND i > n_common), '') AS rejected,
  coalesce(string_agg(length(head) || ':0,' || length(body) || ':' || (role = 'assistant')::INT, ',' ORDER BY i) FILTER (odd = 0 AND i > n_common), '') AS chosen_mask,
  coalesce(string_agg(length(head) || ':0,' || length(body) || ':' || (role = 'assistant')::INT, ',' ORDER BY i) FILTER (odd = 1 AND i > n_common), '') AS rejected_mask
FROM common JOIN n USING (pair_id) GROUP BY pair_id"""


@query("op7_preference", CHAT_SQL)
def op7_preference(table):
    """Prompt, completions and masks of every pair of neighbouring conversations."""
    pairs = chat.neighbour_pairs(chat.conversations(table("conversations")))
    formatted = chat.format_pairs(pairs)
    return formatted.withColumns({c: chat.mask_text(F.col(c)) for c in ("chosen_mask", "rejected_mask")})


@query("op9_secrets")
def op9_secrets(table):
    """Secrets of every document; owner is the source, repository the source and language."""
    repo = F.concat_ws("/", F.coalesce("source", F.lit("")), F.coalesce("lang", F.lit("")))
    return secrets.summary(secrets.scan(table("documents"), owner="source", repo=repo))


@query("op13_conversation_repair")
def op13_conversation_repair(table):
    """Faults and the cheapest repair of every conversation, after a seeded damage."""
    turns = table("conversations")
    return repair.repair(turns, repair.damage(turns))
