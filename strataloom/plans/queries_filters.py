"""Queries over filters, joins, sequences and residue tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import text as X
from ..functions.align import identity
from ..operators import features as E, filters as L, residues as R, sampling as S, select as W
from ..operators.expect import set_difference
from ..sources import sinks
from .registry import query

CASCADE_SQL = """
WITH d AS (SELECT doc_id, CASE
  WHEN NOT (contains(upper(lang), 'EN') OR contains(upper(lang), 'FR')) THEN 'method'
  WHEN quality IS NULL THEN 'no_label'
  WHEN n_chars NOT BETWEEN 200 AND 5000 THEN 'length'
  WHEN quality <> 1 THEN 'quality' WHEN toxic = 1 THEN 'toxic' END AS reason
  FROM documents LEFT JOIN labels USING (doc_id))
"""


def _cascade(t):
    docs = t.documents.select("doc_id", "lang", "n_chars").join(t.labels, "doc_id", "left")
    return L.reason_cascade(docs, [
        ("method", ~L.method_allowed(F.col("lang"), ["EN", "FR"])), ("no_label", F.col("quality").isNull()),
        ("length", ~F.col("n_chars").between(200, 5000)), ("quality", F.col("quality") != 1), ("toxic", F.col("toxic") == 1)])


@query("reason_cascade", CASCADE_SQL + "SELECT doc_id, reason, CASE WHEN reason IS NULL THEN 'ok' ELSE 'skipped' END AS status FROM d")
def reason_cascade(t):
    return _cascade(t).select("doc_id", "reason", "status")


@query("outcome_histogram", CASCADE_SQL + "SELECT coalesce(reason, 'ok') AS outcome, count(*) AS n FROM d GROUP BY 1")
def outcome_histogram(t):
    return sinks.outcome_histogram(_cascade(t))


@query("build_manifest", CASCADE_SQL + """
SELECT CAST(sum(n) AS BIGINT) AS inputs, max(CASE WHEN o = 'ok' THEN n END) AS ok_rows, count(*) AS outcomes, 5000 AS filter_max_chars
FROM (SELECT coalesce(reason, 'ok') AS o, count(*) AS n FROM d GROUP BY 1)""")
def build_manifest(t):
    row = sinks.build_manifest(_cascade(t), {"max_chars": 5000})
    return row.select("inputs", F.col("outcomes")["ok"].alias("ok_rows"), F.size("outcomes").cast("bigint").alias("outcomes"), "filter_max_chars")


@query("date_window", """
SELECT o_orderkey FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-03-01' AND DATE '1997-02-28'""")
def date_window(t):
    return t.orders.where(L.date_in_range(F.col("o_orderdate").cast("date"), "1996-03-01", "1997-02-28")).select("o_orderkey")


@query("resolution_filter", """
SELECT s_suppkey, CASE WHEN s_acctbal > 0 THEN s_acctbal ELSE s_suppkey * 1.5 END AS resolution FROM supplier
WHERE CASE WHEN s_acctbal > 0 THEN s_acctbal ELSE s_suppkey * 1.5 END BETWEEN 1e-9 AND 5000""")
def resolution_filter(t):
    s = t.supplier.select("s_suppkey", L.usable_resolution(F.col("s_acctbal"), F.col("s_suppkey") * 1.5).alias("resolution"))
    return s.where("resolution <= 5000")


@query("null_tokens", """
SELECT doc_id, CASE WHEN tok IN ('', '.', '?') THEN NULL ELSE tok END AS token,
  TRY_CAST(CASE WHEN tok IN ('', '.', '?') THEN NULL ELSE tok END AS DOUBLE) AS number
FROM (SELECT doc_id, CASE doc_id % 5 WHEN 0 THEN '.' WHEN 1 THEN '?' WHEN 2 THEN '' ELSE trim(CAST(n_chars AS VARCHAR)) END AS tok FROM documents)""")
def null_tokens(t):
    k = F.col("doc_id") % 5
    raw = F.when(k == 0, " . ").when(k == 1, "?").when(k == 2, "  ").otherwise(F.concat(F.lit(" "), F.col("n_chars").cast("string")))
    d = t.documents.select("doc_id", raw.alias("raw"))
    return d.select("doc_id", X.clean_token(F.col("raw")).alias("token"), X.finite_double(X.clean_token(F.col("raw"))).alias("number"))


@query("training_filter", """
SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_discount <= 0.05 AND CAST(l_shipdate AS DATE) <= DATE '1998-06-30'""")
def training_filter(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_discount", F.col("l_shipdate").cast("date").alias("d"))
    return L.training_filter(rows, 0.05, "1998-06-30", "l_discount", "d").select("l_orderkey", "l_linenumber", "l_partkey")


@query("oversize_rules", """
WITH c AS (SELECT l_orderkey AS entry, count(*) AS context_chains, CAST(sum(l_quantity) AS BIGINT) AS context_length FROM lineitem GROUP BY 1)
SELECT CASE WHEN context_chains > 6 THEN 'too_many_chains' WHEN context_length > 150 THEN 'context_too_long' ELSE 'ok' END AS outcome, count(*) AS n
FROM c GROUP BY 1""")
def oversize_rules(t):
    chains = t.lineitem.select(F.col("l_orderkey").alias("entry"), F.col("l_quantity").cast("bigint").alias("length"))
    return sinks.outcome_histogram(L.reason_cascade(R.context_size(chains), L.oversize_rules(6, 150)))


@query("manifest_completeness", """
WITH m AS (SELECT doc_id, n_chars + CASE WHEN doc_id % 11 = 0 THEN 9000 ELSE 0 END AS expected FROM documents WHERE doc_id % 13 <> 0),
f AS (SELECT doc_id, length(text) AS actual FROM documents WHERE doc_id % 17 <> 0)
SELECT CASE WHEN actual IS NULL THEN 'missing' WHEN expected IS NULL THEN 'unexpected'
  WHEN actual > 0 AND expected > 0 AND abs(actual - expected) <= greatest(4096.0, expected * 0.002) THEN 'complete' ELSE 'size_mismatch' END AS state,
  count(*) AS n FROM m FULL JOIN f USING (doc_id) GROUP BY 1""")
def manifest_completeness(t):
    d = t.documents.select("doc_id", "n_chars", F.length("text").alias("length"))
    m = d.where("doc_id % 13 <> 0").select("doc_id", (F.col("n_chars") + F.when(F.col("doc_id") % 11 == 0, 9000).otherwise(0)).alias("size"))
    f = d.where("doc_id % 17 <> 0").select("doc_id", "length")
    return L.file_completeness(m, f, "doc_id").groupBy("state").agg(F.count("*").alias("n"))


@query("cluster_fallback_join", """
SELECT o_orderkey, CASE WHEN c_custkey IS NOT NULL THEN c_nationkey ELSE
  900000000 + ('0x' || substr(sha1(CAST(o_custkey AS VARCHAR)), 1, 12))::BIGINT % 99999999 END AS cluster
FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 3 <> 0) ON c_custkey = o_custkey""")
def cluster_fallback_join(t):
    rows = t.orders.select("o_orderkey", F.col("o_custkey").alias("k"), F.col("o_custkey").cast("string").alias("seq"))
    known = t.customer.where("c_custkey % 3 <> 0").select(F.col("c_custkey").alias("k"), F.col("c_nationkey").cast("bigint").alias("cluster"))
    return R.with_cluster(rows, known, ["k"], "seq").select("o_orderkey", "cluster")


@query("sequence_hashes", """
SELECT doc_id, lpad((('0x' || substr(sha1(text), 1, 12))::BIGINT % 1000000)::VARCHAR, 6, '0') AS hash, sha256(text) AS sequence_sha256 FROM documents""")
def sequence_hashes(t):
    return t.documents.select("doc_id", X.padded_hash(F.col("text")).alias("hash"), F.sha2("text", 256).alias("sequence_sha256"))


@query("size_strings", """
SELECT p_partkey, CAST(p_size::BIGINT * CASE p_partkey % 4 WHEN 0 THEN 1 WHEN 1 THEN 1024 WHEN 2 THEN 1048576 ELSE 1073741824 END AS BIGINT) AS bytes FROM part""")
def size_strings(t):
    unit = F.get(F.array(F.lit(""), F.lit("k"), F.lit("m"), F.lit("G")), (F.col("p_partkey") % 4).cast("int"))
    return t.part.select("p_partkey", X.size_bytes(F.concat(F.col("p_size").cast("string"), unit)).alias("bytes"))


@query("window_starts", """
SELECT l_orderkey, l_linenumber, l_partkey, greatest(0, least(l_partkey % 60 - s // 2, n - s)) AS start_at
FROM (SELECT *, CAST(l_quantity AS BIGINT) AS n, greatest(1, CAST(l_quantity AS BIGINT) // 2) AS s FROM lineitem)""")
def window_starts(t):
    n = F.col("l_quantity").cast("bigint")
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", X.window_start(
        n, F.greatest(F.lit(1).cast("bigint"), F.floor(n / 2)), F.col("l_partkey") % 60).alias("start_at"))


TAG_SQL = """
WITH d AS (SELECT doc_id, repeat('H', doc_id % 12) || substr(text, 1, length(text)) || repeat('H', doc_id % 11) AS s FROM documents),
c AS (SELECT doc_id, s,
  list_sum([CASE WHEN substr(s, k + 1, 6) = 'HHHHHH' THEN 6 + k ELSE 0 END FOR k IN range(5)]) AS f,
  list_sum([CASE WHEN length(s) >= 6 + k AND substr(s, length(s) - 5 - k, 6) = 'HHHHHH' THEN 6 + k ELSE 0 END FOR k IN range(5)]) AS b FROM d)
SELECT doc_id, CAST(f AS INTEGER) AS cut_front, CAST(b AS INTEGER) AS cut_back, sha256(substr(s, CAST(f AS BIGINT) + 1, CAST(greatest(length(s) - f - b, 0) AS BIGINT))) AS seq_sha256
FROM c WHERE length(s) - f - b >= 4"""


@query("tag_trim", TAG_SQL)
def tag_trim(t):
    tag = lambda m: F.repeat(F.lit("H"), (F.col("doc_id") % m).cast("int"))
    d = t.documents.select("doc_id", F.concat(tag(12), "text", tag(11)).alias("seq"))
    return S.trim_chain_tags(d).select("doc_id", "cut_front", "cut_back", F.sha2("seq", 256).alias("seq_sha256"))


@query("fasta_wrap", """
SELECT item_id, '>' || item_id || ' source_chain=item-' || item_id || ' cluster=' || (item_id // 5) || ' length=' || length(text) || chr(10) ||
  array_to_string([substr(text, o + 1, 80) FOR o IN range(0, length(text), 80)], chr(10)) AS value FROM benchmark""")
def fasta_wrap(t):
    b = t.benchmark.select("item_id", F.concat(F.lit("item-"), "item_id").alias("chain"), F.floor(F.col("item_id") / 5).alias("cluster"), "text")
    return sinks.fasta_lines(b, "item_id", "chain", "cluster", "text")


CDS = "translate(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'ACGTACGTACGTACGTACGTACGTAC')"
CODON_VALUES = ", ".join(f"('{c}', '{aa}')" for c, aa in X.CODONS.items())


@query("codon_translate", f"""
WITH m(codon, aa) AS (VALUES {CODON_VALUES}),
c AS (SELECT item_id, {CDS} AS s FROM benchmark),
k AS (SELECT item_id, length(s) AS n, unnest([i FOR i IN range(0, length(s) - length(s) % 3, 3)]) AS i, s FROM c),
a AS (SELECT item_id, n, string_agg(coalesce(m.aa, 'X'), '' ORDER BY i) AS p FROM k LEFT JOIN m ON m.codon = substr(s, i + 1, 3) GROUP BY ALL)
SELECT item_id, CASE WHEN n % 3 = 0 AND NOT contains(CASE WHEN right(p, 1) = '*' THEN left(p, length(p) - 1) ELSE p END, '*')
  THEN CASE WHEN right(p, 1) = '*' THEN left(p, length(p) - 1) ELSE p END END AS protein FROM a""")
def codon_translate(t):
    letters = F.upper(F.regexp_replace("text", "[^A-Za-z]", ""))
    cds = F.translate(letters, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "ACGTACGTACGTACGTACGTACGTAC")
    return t.benchmark.select("item_id", X.translate(cds).alias("protein"))


@query("residue_labels", """
SELECT item_id, list_sum([greatest(instr('ACDEFGHIKLMNPQRSTVWYX', c) - 1, 0) FOR c IN string_split(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '')])::BIGINT AS label_sum,
  len([c FOR c IN string_split(upper(regexp_replace(text, '[^A-Za-z]', '', 'g')), '') IF instr('ACDEFGHIKLMNPQRSTVWYX', c) > 0])::BIGINT AS known FROM benchmark""")
def residue_labels(t):
    labels = F.transform(F.split(F.upper(F.regexp_replace("text", "[^A-Za-z]", "")), ""), lambda c: X.residue_label(c))
    b = t.benchmark.select("item_id", F.filter(labels, lambda x: x.isNotNull()).alias("l"))
    return b.select("item_id", F.aggregate("l", F.lit(0).cast("bigint"), lambda a, x: a + x).alias("label_sum"), F.size("l").cast("bigint").alias("known"))


@query("labels_to_sequence", """
SELECT item_id, coalesce(string_agg(c, '' ORDER BY i) FILTER (instr('ACDEFGHIKLMNPQRSTVWYX', c) > 0 AND i % 3 <> 0), '') AS seq
FROM (SELECT item_id, i, substr(text, i, 1) AS c FROM (SELECT *, unnest(range(1, length(text) + 1)) AS i FROM benchmark)) GROUP BY item_id""")
def labels_to_sequence(t):
    letters = F.split("text", "")
    labels = F.transform(letters, lambda c: F.coalesce(X.residue_label(c), F.lit(0)))
    mask = F.transform(letters, lambda c, i: (X.residue_label(c).isNotNull() & ((i + 1) % 3 != 0)).cast("int"))
    b = t.benchmark.select("item_id", labels.alias("l"), mask.alias("m"))
    return b.select("item_id", X.labels_to_sequence(F.col("l"), F.col("m")).alias("seq"))


@query("pair_identity")
def pair_identity(t):
    """Turns of a conversation against its first turn: 1 for equal roles, else the aligned identity."""
    turns = t.conversations.select("conv_id", "turn", "role", "text")
    first = turns.groupBy("conv_id").agg(F.min("turn").alias("first"))
    marked = turns.join(first, "conv_id").select(
        F.col("conv_id").alias("entry"), F.col("turn").alias("chain"), (F.col("turn") == F.col("first")).alias("is_target"),
        F.col("role").alias("entity"), F.col("conv_id").alias("cluster"), F.col("text").alias("seq"))
    return R.target_identity(marked, "entry", "chain", "is_target", "entity", "cluster", "seq").withColumn("identity", F.round("identity", 9))


@query("homologous_chains", """
WITH p AS (SELECT a.conv_id AS entry, b.turn AS chain_b, CASE WHEN a.role = b.role THEN 1.0 ELSE 0.0 END AS identity
  FROM conversations a JOIN conversations b USING (conv_id) WHERE a.turn = 0)
SELECT entry, chain_b FROM p WHERE identity > 0.7""")
def homologous_chains(t):
    turns = t.conversations.select("conv_id", "turn", "role")
    target = turns.where("turn = 0").select("conv_id", F.col("role").alias("r"))
    edges = turns.join(target, "conv_id").select(
        F.col("conv_id").alias("entry"), F.col("turn").alias("chain_b"), F.when(F.col("role") == F.col("r"), 1.0).otherwise(0.0).alias("identity"))
    return S.homologous_chains(edges).select("entry", "chain_b")


@query("chain_remap", """
SELECT o_custkey, o_orderkey, substr('ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789', rn, 1) AS chain_id
FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders)""")
def chain_remap(t):
    rows = t.orders.select(F.col("o_custkey").alias("entry"), F.col("o_orderkey").alias("chain"))
    return R.remap_chains(rows).select(F.col("entry").alias("o_custkey"), F.col("chain").alias("o_orderkey"), "chain_id")


ATOM_SQL = """
WITH a AS (SELECT l_orderkey AS entry, l_suppkey % 3 AS chain, l_linenumber AS seq_id, l_partkey % 4 AS atom, l_quantity AS occ,
  row_number() OVER (ORDER BY l_orderkey, l_linenumber, l_partkey, l_suppkey, l_extendedprice) AS row, l_extendedprice AS x FROM lineitem)
"""


def _atoms(t):
    from ..operators.scale import row_numbers
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")
    rows = row_numbers(rows, ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_extendedprice"], "row")
    return rows.select(
        F.col("l_orderkey").alias("entry"), (F.col("l_suppkey") % 3).alias("chain"), F.col("l_linenumber").alias("seq_id"),
        (F.col("l_partkey") % 4).alias("atom"), F.col("l_quantity").alias("occ"), "row", F.col("l_extendedprice").alias("x"))


@query("best_atoms", ATOM_SQL + """
SELECT entry, chain, seq_id, atom, occ, x FROM (SELECT *, row_number() OVER (PARTITION BY entry, chain, seq_id, atom ORDER BY occ DESC, row) AS rn FROM a) WHERE rn = 1""")
def best_atoms(t):
    return R.best_atoms(_atoms(t), ["entry", "chain", "seq_id", "atom"]).select("entry", "chain", "seq_id", "atom", "occ", "x")


@query("majority_entity", ATOM_SQL + """
SELECT entry, chain, atom AS entity_id FROM (SELECT entry, chain, atom, row_number() OVER (PARTITION BY entry, chain ORDER BY count(*) DESC, min(row)) AS rn
FROM a GROUP BY entry, chain, atom) WHERE rn = 1""")
def majority_entity(t):
    votes = _atoms(t).select("entry", "chain", F.col("atom").alias("entity_id"), F.lit(1).alias("source"), "row")
    return R.majority_entity(votes)


LETTER = "substr('ACDEFGHIKLMNPQRSTVWYX', CAST(l_partkey % 21 AS BIGINT) + 1, 1)"


@query("chain_assembly", f"""
WITH r AS (SELECT l_orderkey AS entry, l_linenumber AS seq_id, max_by({LETTER}, l_partkey * 100000000 + l_extendedprice) AS aa,
  bool_or(l_quantity > 10) AS ok FROM lineitem GROUP BY 1, 2),
c AS (SELECT entry, count(*) AS length, string_agg(aa, '' ORDER BY seq_id) AS seq, count(*) FILTER (ok) AS resolved FROM r GROUP BY entry)
SELECT entry, seq, length, resolved, round(resolved / length, 9) AS coverage FROM c WHERE length BETWEEN 3 AND 7""")
def chain_assembly(t):
    """Orders as chains: line numbers are positions, part keys letters, quantity decides what was observed."""
    aa = F.substring(F.lit(X.ALPHABET), (F.col("l_partkey") % 21 + 1).cast("int"), F.lit(1))
    lines = t.lineitem.select(F.col("l_orderkey").alias("entry"), F.lit("A").alias("chain"), F.lit("1").alias("entity_id"),
        F.col("l_linenumber").alias("seq_id"), aa.alias("aa"), (F.col("l_partkey") * 100000000 + F.col("l_extendedprice")).alias("k"), "l_quantity")
    positions = lines.groupBy("entry", "chain", "entity_id", "seq_id").agg(F.max_by("aa", "k").alias("aa"))
    point = F.struct(F.lit(0.0).alias("x"), F.lit(0.0).alias("y"), F.lit(0.0).alias("z"))
    seen = lines.where("l_quantity > 10").select("entry", "chain", "seq_id").distinct()
    atoms = seen.select("entry", "chain", "seq_id", F.explode(F.array(*[F.lit(a) for a in R.ATOM_NAMES])).alias("atom"),
                        point.alias("xyz"), F.lit(1.0).alias("occ"), F.lit(0.0).alias("bfac"))
    chains = R.chain_table(R.residue_table(positions, atoms, 3, 7))
    return R.quality_gate(chains, 3, 7).select("entry", "seq", "length", "resolved", F.round("coverage", 9).alias("coverage"))


@query("residue_index", """
SELECT conv_id, turn, CAST(cn AS BIGINT) AS chain_no, CAST(coalesce(st, 0) AS BIGINT) AS start_at, CAST(100 * (cn - 1) + coalesce(st, 0) AS BIGINT) AS index_start FROM (
  SELECT conv_id, turn, row_number() OVER w AS cn, sum(length(text)) OVER (PARTITION BY conv_id ORDER BY turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING) AS st
  FROM conversations WINDOW w AS (PARTITION BY conv_id ORDER BY turn))""")
def residue_index(t):
    turns = t.conversations.select("conv_id", "turn", F.length("text").alias("length"))
    return S.residue_index(turns, ["conv_id"], "turn", "length").select(
        "conv_id", "turn", "chain_no", F.col("start").alias("start_at"), "index_start")


@query("continuity_masks", """
SELECT conv_id, turn, CASE WHEN turn - lag(turn) OVER w = 1 THEN 1 ELSE 0 END AS phi_mask,
  CASE WHEN lead(turn) OVER w - turn = 1 THEN 1 ELSE 0 END AS psi_mask, CASE WHEN lead(turn) OVER w - turn = 1 THEN 1 ELSE 0 END AS omega_mask
FROM conversations WHERE turn <> 2 WINDOW w AS (PARTITION BY conv_id ORDER BY turn)""")
def continuity_masks(t):
    rows = t.conversations.where("turn <> 2").select("conv_id", "turn")
    return E.continuity_masks(rows, ["conv_id"], "turn")


@query("promote_same_sequence", """
SELECT l_orderkey, l_linenumber, l_partkey, (l_quantity > 25 OR EXISTS (SELECT 1 FROM lineitem b WHERE b.l_orderkey = a.l_orderkey AND b.l_quantity > 25
  AND b.l_returnflag = a.l_returnflag)) AS masked FROM lineitem a""")
def promote_same_sequence(t):
    rows = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", F.col("l_returnflag").alias("seq"), (F.col("l_quantity") > 25).alias("masked"))
    return S.promote_same_sequence(rows, "l_orderkey", "seq", "masked").drop("seq")


@query("assemble_examples", """
SELECT conv_id AS example, sha256(string_agg(text, '' ORDER BY turn)) AS seq_sha256, count(*) FILTER (role = 'assistant') AS masked_chains,
  count(*) AS num_of_chains FROM conversations GROUP BY conv_id HAVING sum(length(text)) <= 2500""")
def assemble_examples(t):
    chains = t.conversations.select(F.col("conv_id").alias("example"), F.col("turn").alias("idx"), F.col("turn").cast("string").alias("letter"),
        F.col("text").alias("seq"), (F.col("role") == "assistant").alias("masked"))
    out = S.assemble_examples(chains, "example", "idx", max_length=2500)
    return out.select("example", F.sha2("seq", 256).alias("seq_sha256"), F.size("masked_list").cast("bigint").alias("masked_chains"),
                      F.col("num_of_chains").cast("bigint").alias("num_of_chains"))


@query("chain_display", """
SELECT l_orderkey, string_agg(l_returnflag, '/' ORDER BY l_linenumber, l_returnflag) AS display FROM lineitem GROUP BY l_orderkey""")
def chain_display(t):
    return E.chain_display(t.lineitem, "l_orderkey", "l_linenumber", "l_returnflag", tiebreak="l_returnflag")


@query("group_by_cluster", """
SELECT CASE WHEN o_orderkey % 10 = 0 THEN 'valid' ELSE 'train' END AS split, o_custkey AS cluster, count(*) AS records, min(o_orderkey) AS first_record
FROM orders GROUP BY 1, 2""")
def group_by_cluster(t):
    rows = t.orders.select(F.when(F.col("o_orderkey") % 10 == 0, "valid").otherwise("train").alias("split"), F.col("o_custkey").alias("cluster"), "o_orderkey")
    grouped = S.group_by_cluster(rows, "split", "cluster", ["o_orderkey"])
    return grouped.groupBy("split", "cluster").agg(
        F.max("member").alias("records"), F.min(F.when(F.col("member") == 1, F.col("o_orderkey"))).alias("first_record"))


@query("rigid_transform", """
SELECT l_orderkey, l_linenumber, l_partkey, -l_tax + 1.0 AS x, l_quantity + 2.0 AS y, l_discount + 3.0 AS z FROM lineitem""")
def rigid_transform(t):
    from ..functions.vector import rigid, vec
    turn, shift = F.expr("array(array(0D,-1D,0D), array(1D,0D,0D), array(0D,0D,1D))"), F.expr("array(1D,2D,3D)")
    moved = rigid(turn, shift, vec(F.col("l_quantity"), F.col("l_tax"), F.col("l_discount")))
    return t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", moved.alias("p")).select("l_orderkey", "l_linenumber", "l_partkey", "p.x", "p.y", "p.z")


@query("relative_offsets", """
SELECT least(greatest(CAST(l_partkey - l_suppkey AS BIGINT) + 32, 0), 64) AS offset_clipped, CASE WHEN l_returnflag = 'A' THEN least(greatest(CAST(l_partkey - l_suppkey AS BIGINT) + 32, 0), 64) ELSE 65 END AS offset_class, count(*) AS n
FROM lineitem GROUP BY 1, 2""")
def relative_offsets(t):
    from ..functions.vector import relative_offset
    off = F.col("l_partkey") - F.col("l_suppkey")
    return t.lineitem.select(relative_offset(off, F.lit(True)).alias("offset_clipped"), relative_offset(off, F.col("l_returnflag") == "A").alias("offset_class")).groupBy(
        "offset_clipped", "offset_class").agg(F.count("*").alias("n"))


@query("file_sets", """
SELECT o_custkey AS k, CASE WHEN in_l AND NOT in_r THEN 'left_only' ELSE 'right_only' END AS side FROM (
  SELECT k AS o_custkey, bool_or(s = 'l') AS in_l, bool_or(s = 'r') AS in_r FROM (
    SELECT DISTINCT o_custkey AS k, 'l' AS s FROM orders WHERE o_totalprice > 200000 UNION ALL SELECT c_custkey, 'r' FROM customer WHERE c_acctbal > 0) GROUP BY k) WHERE in_l <> in_r""")
def file_sets(t):
    return set_difference(t.orders.where("o_totalprice > 200000").select(F.col("o_custkey").alias("k")).distinct(), t.customer.where("c_acctbal > 0").select(F.col("c_custkey").alias("k")))
