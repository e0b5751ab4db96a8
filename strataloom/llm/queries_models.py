"""Queries that need a trained model, a tokenizer or hashed text."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import functions as F

from . import jaccard_join, line_dedup, pair_bitmaps, quality, suffix_merge, token_counts, topk, toxicity
from .queries import query


@query("op1_quality")
def op1_quality(table):
    """Votes, posterior and score of every document."""
    return quality.quality(table("documents"))


@query("op4_token_counts")
def op4_token_counts(table):
    """Tokens of every document."""
    return token_counts.token_counts(table("documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query("op5_toxicity")
def op5_toxicity(table):
    """Toxicity of every document, with its offending sentences."""
    docs = table("documents")
    scored = toxicity.score(docs, toxicity.train(docs, table("labels")))
    return scored.select("doc_id", toxicity.held_out(F.col("doc_id")).alias("held_out"), "score",
                         (F.col("score") >= 0.7).cast("int").alias("predicted"), "n_sentences", "offending")


@query("op10_jaccard_join")
def op10_jaccard_join(table):
    """Class and number of links of every document."""
    return jaccard_join.similar_classes(table("documents")).select("doc_id", "class_id", "n_links")


TOP_K_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)::BIGINT) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.r, q.vec_id AS query_id, d.vec_id, list_sum(list_transform(list_zip(q.v, d.v), lambda z: z[1] * z[2]))::BIGINT AS score
  FROM v q JOIN v d ON q.r <> d.r WHERE q.vec_id % 50 = 0)
SELECT query_id, rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY r ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s) WHERE rank <= 5"""


@query("op6_top_k", TOP_K_SQL)
def op6_top_k(table):
    """The five best inner products of every fiftieth vector."""
    vectors = table("embeddings").select("vec_id", topk.quantised(F.col("embedding")).alias("vector"))
    return topk.top_k(vectors, vectors.where("vec_id % 50 = 0"))


@query("op8_line_dedup")
def op8_line_dedup(table):
    """Every document with its later matching lines cut."""
    cut = line_dedup.dedup_lines(table("documents").select("doc_id", "text"), least_tokens=1)
    return cut.select("doc_id", "n_lines", "n_removed", "text")


REPEATS_SQL = """
WITH d AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, lower(hex(encode(coalesce(text, '')))) AS h FROM documents),
block AS (SELECT r, b, substr(h, 1000 * b + 1, 1198) AS h FROM d, LATERAL unnest(range(0, len(h) // 1000 + 1)) AS u(b)),
w AS MATERIALIZED (SELECT r, 500 * b + k AS i, substr(h, 2 * k + 1, 200) AS s FROM block, LATERAL unnest(range(0, least(500, len(h) // 2 - 99))) AS u(k)),
hit AS (SELECT r, i FROM w JOIN (SELECT s, min((r, i)) AS f FROM w GROUP BY s HAVING count(*) > 1) USING (s) WHERE (r, i) > f),
run AS (SELECT r, i, i - lag(i) OVER (PARTITION BY r ORDER BY i) <= 100 AS joins FROM hit),
numbered AS (SELECT r, i, sum(CASE WHEN joins THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY i) AS k FROM run),
span AS (SELECT r, k, min(i) AS a, max(i) + 100 AS b FROM numbered GROUP BY r, k),
part AS (SELECT r, lag(b, 1, 0) OVER (PARTITION BY r ORDER BY a) AS x, a AS y FROM span
  UNION ALL SELECT d.r, coalesce(max(b), 0), len(any_value(h)) // 2 FROM d LEFT JOIN span USING (r) GROUP BY d.r),
kept AS (SELECT d.r, string_agg(substr(h, (2 * x + 1)::BIGINT, (2 * (y - x))::BIGINT), '' ORDER BY x, y) AS kept FROM part JOIN d USING (r) GROUP BY d.r)
SELECT doc_id, (len(h) // 2)::BIGINT AS n_bytes, ((len(h) - len(kept)) // 2)::BIGINT AS n_removed,
  (SELECT count(*) FROM span WHERE span.r = d.r)::BIGINT AS n_spans, sha256(unhex(kept)) AS kept_sha256
FROM d JOIN kept USING (r)"""


@query("op11_suffix_dedup", REPEATS_SQL)
def op11_suffix_dedup(table):
    """Bytes of every document that are left without the strings of 100 bytes that occur earlier."""
    cut = suffix_merge.remove_repeats(table("documents").select("doc_id", "text"))
    n_bytes = F.octet_length(F.coalesce("text", F.lit(""))).cast("bigint")
    return cut.select("doc_id", n_bytes.alias("n_bytes"), (n_bytes - F.octet_length("kept")).alias("n_removed"),
                      F.size("spans").cast("bigint").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


@query("op12_token_alignment")
def op12_token_alignment(table):
    """Alignment of two tokenizers on every document, scored by corpus-wide counts of linked pairs."""
    return pair_bitmaps.align(table("documents").select("doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model"))
