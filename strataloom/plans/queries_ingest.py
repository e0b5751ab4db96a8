"""Queries over the ingest of structure files: orders rendered as file texts, parsed back and judged."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..operators import residues as R
from ..session import checkpointed, shuffle_width, stored
from ..sources import structure as T
from .curate import CurateConfig, choose_inputs, judge_contents
from .registry import query

RULES = CurateConfig(methods=("EM", "URGENT", "HIGH", "NOT SPEC"), first_date="1993-01-01", last_date="1998-03-31",
                     max_resolution=300_000, assembly_policy="all", max_raw_bytes=1500)
RESIDUES = ("ALA", "GLY", "SER", "LYS", "MSE")
ENTITIES = ("\nloop_\n_entity_poly.entity_id\n_entity_poly.type\n1 'polypeptide(L)'\n2 polyribonucleotide"
            "\nloop_\n_entity_poly_seq.entity_id\n_entity_poly_seq.num\n_entity_poly_seq.mon_id")
ATOMS = "\nloop_" + "".join(f"\n_atom_site.{name}" for name in T.CATEGORIES["atom_site"])


def _files(t) -> DataFrame:
    """(path, length, content): one file text per order, with four atoms a line.

    Orders share an entry with those of the same last four digits and are its assemblies. Some have another
    kind of name, an atom table cut short, an open text block or no date.
    """
    key = F.col("o_orderkey")
    whole = lambda c: F.round(F.col(c) * 100).cast("int").cast("string")
    atom = lambda name: F.concat_ws(
        " ", F.lit("ATOM"), F.lit(name), F.lit("ALA"), "l_linestatus", F.when(F.col("l_partkey") % 9 == 0, "2").otherwise("1"), F.col("l_linenumber").cast("string"),
        F.when(F.col("l_partkey") % 11 == 0, "B").otherwise("."), F.col("l_quantity").cast("int").cast("string"), whole("l_discount"), whole("l_tax"), whole("l_discount"),
        F.lit("9"), F.lit("1"))
    atoms = F.array_compact(F.array(atom("N"), atom("CA"), atom("C"), F.when(F.col("l_suppkey") % 3 != 0, atom("O"))))
    rows = t.lineitem.select(F.col("l_orderkey").alias("o_orderkey"), atoms.alias("a")).groupBy("o_orderkey").agg(F.array_sort(F.flatten(F.collect_list("a"))).alias("rows"))
    names = F.array(*[F.lit(r) for r in RESIDUES])
    sequence = F.array_join(F.transform(F.sequence(F.lit(1), F.lit(8)), lambda p: F.concat(
        F.lit("\n1 "), p.cast("string"), F.lit(" "), F.get(names, ((key + p) % 5).cast("int")))), "")
    text = F.concat(
        F.lit("data_x\n_exptl.method '"), "o_orderpriority", F.lit("'\n_pdbx_database_status.recvd_initial_deposition_date "),
        F.when(key % 10 == 3, "?").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd")), F.lit("\n_refine.ls_d_res_high "),
        F.floor("o_totalprice").cast("string"), F.lit(ENTITIES), sequence, F.lit(ATOMS),
        F.coalesce(F.array_join(F.transform("rows", lambda r: F.concat(F.lit("\n"), r)), ""), F.lit("")),
        F.when(key % 50 == 7, "\n1").when(key % 50 == 8, "\n;open").otherwise(""))
    pdb = F.lpad((key % 10000).cast("string"), 4, "0")
    path = F.when(key % 97 == 5, F.concat(F.lit("raw/"), key.cast("string"), F.lit(".cif"))).otherwise(
        F.concat(F.lit("raw/"), pdb, F.lit("-assembly"), F.floor(key / 10000).cast("string"), F.lit(".cif")))
    written = t.orders.join(rows, "o_orderkey", "left").select(path.alias("path"), text.cast("binary").alias("content"))
    return stored(written.select("path", F.octet_length("content").cast("bigint").alias("length"), "content"))


def _parsed(files: DataFrame, categories=tuple(T.CATEGORIES)) -> DataFrame:
    # parsing takes far longer than reading: a partition count that adaptive execution does not lower for small bytes
    wide = files.select("path", "content").repartition(shuffle_width(files.sparkSession), F.xxhash64("path"))
    return checkpointed(T.parse_contents(wide, categories=categories))


FILES_SQL = f"""
WITH a AS (SELECT l_orderkey AS key, l_linestatus AS chain, l_linenumber AS seq_id, l_partkey % 9 = 0 AS other, l_partkey % 11 = 0 AS alt, l_suppkey % 3 <> 0 AS whole,
    CAST(l_quantity AS INT) AS x, CAST(round(l_discount * 100) AS INT) AS y, concat_ws(' ', 'ATOM CA ALA', l_linestatus, CASE WHEN l_partkey % 9 = 0 THEN 2 ELSE 1 END, l_linenumber,
    CASE WHEN l_partkey % 11 = 0 THEN 'B' ELSE '.' END, CAST(l_quantity AS INT), CAST(round(l_discount * 100) AS INT), CAST(round(l_tax * 100) AS INT),
    CAST(round(l_discount * 100) AS INT), 9, 1) AS txt FROM lineitem),
s AS (SELECT key, count(*) AS n, sum(CASE WHEN whole THEN 4 ELSE 3 END * (strlen(txt) + 1) - CASE WHEN whole THEN 3 ELSE 2 END) AS size FROM a GROUP BY 1),
o AS (SELECT o_orderkey AS k, lpad(CAST(o_orderkey % 10000 AS VARCHAR), 4, '0') AS pdb, o_orderkey // 10000 AS asm, o_orderkey % 97 = 5 AS odd, o_orderkey % 50 IN (7, 8) AS broken,
    o_orderpriority AS method, CAST(o_orderdate AS DATE) AS day, o_orderkey % 10 = 3 AS dateless, floor(o_totalprice) AS price, n,
    strlen('data_x' || chr(10) || '_exptl.method ''' || o_orderpriority || '''' || chr(10) || '_pdbx_database_status.recvd_initial_deposition_date '
      || CASE WHEN o_orderkey % 10 = 3 THEN '?' ELSE '2000-00-00' END || chr(10) || '_refine.ls_d_res_high ' || CAST(CAST(floor(o_totalprice) AS BIGINT) AS VARCHAR))
    + {len(ENTITIES) + len(ATOMS) + 8 * len(chr(10) + "1 1 ALA")} + coalesce(size, 0) + CASE o_orderkey % 50 WHEN 7 THEN 2 WHEN 8 THEN 6 ELSE 0 END AS length
    FROM orders LEFT JOIN s ON key = o_orderkey)
"""


@query("ingest_outcomes", FILES_SQL + """
, j AS (SELECT *, CASE WHEN odd THEN 'raw/' || k || '.cif' ELSE 'raw/' || pdb || '-assembly' || asm || '.cif' END AS path,
    CASE WHEN length > 1500 THEN 'raw_file_size' WHEN odd THEN 'bad_file_name' WHEN k % 8 = 4 THEN 'method' WHEN broken THEN 'mmcif_parse_error'
      WHEN k % 8 <> 0 AND NOT regexp_matches(method, 'URGENT|HIGH|NOT SPEC') THEN 'method'
      WHEN dateless OR day NOT BETWEEN DATE '1993-01-01' AND DATE '1998-03-31' THEN 'date' WHEN price > 300000 THEN 'resolution' WHEN n IS NULL THEN 'no_atoms' END AS reason FROM o)
SELECT path, reason, CASE WHEN reason IS NULL THEN 'ok' WHEN reason = 'mmcif_parse_error' THEN 'failed' ELSE 'skipped' END AS status FROM j""")
def ingest_outcomes(t):
    """One outcome per file: rules on names, sizes and metadata first, then what the parsed texts say."""
    files = _files(t)
    known = t.orders.select((F.col("o_orderkey") % 10000).alias("k")).where("k % 4 = 0").distinct().select(
        F.lpad(F.col("k").cast("string"), 4, "0").alias("pdb_id"), F.lit(None).cast("date").alias("date"), F.lit(None).cast("double").alias("resolution"),
        F.when(F.col("k") % 8 == 0, "em").otherwise("lab").alias("method"))
    inputs, skipped = choose_inputs(files, known, RULES)
    judged, failed = judge_contents(inputs.drop("content"), _parsed(inputs, T.HEADER), RULES)
    return skipped.unionByName(failed).unionByName(judged.select("path", "status", "reason"))


@query("ingest_chains", FILES_SQL + """
, c AS (SELECT min(k) AS k FROM o WHERE NOT odd GROUP BY pdb),
g AS (SELECT k, pdb || 'a' || asm AS entry FROM o JOIN c USING (k) WHERE NOT broken),
b AS (SELECT entry, k, chain, seq_id, whole, x, row_number() OVER (PARTITION BY k, chain, seq_id ORDER BY y DESC, txt) AS r FROM a JOIN g ON key = k WHERE NOT other AND NOT alt),
q AS (SELECT entry, k, chain, seq_id, bool_or(whole) AS whole, max(x) FILTER (r = 1) AS x FROM b GROUP BY ALL)
SELECT entry, chain, '1' AS entity_id, array_to_string([(['A', 'G', 'S', 'K', 'M'])[(k + p) % 5 + 1] FOR p IN range(1, 9)], '') AS seq, 8 AS length,
    count(*) FILTER (whole) AS resolved, count(*) FILTER (whole) / 8 AS coverage, CAST(sum(x) AS DOUBLE) AS ca_x FROM q GROUP BY entry, k, chain""")
def ingest_chains(t):
    """Chains of the lowest assembly of each entry, from parsed texts: best atoms, sequences, coverage, coordinates."""
    files = _files(t)
    chosen = T.discover_assemblies(files.drop("content"), policy="first")
    parsed = _parsed(files.join(chosen.select("path"), "path", "left_semi"))
    named = checkpointed(chosen.select("path", F.col("entry_id").alias("entry")))
    table = lambda c: T.category_table(parsed, c).join(named, "path").drop("path")
    sequences = table("entity_poly_seq")
    entities = R.protein_entities(table("entity_poly"), sequences)
    atoms = checkpointed(R.best_atoms(R.filter_atoms(table("atom_site"), entities), ["entry", "chain", "seq_id", "atom"]))
    chains = R.majority_entity(atoms.select("entry", "chain", "entity_id", F.lit(1).alias("source"), "row"))
    positions = R.chain_positions(table("pdbx_poly_seq_scheme"), sequences, chains, entities)
    residues = checkpointed(R.residue_table(positions, atoms, 1, 100))
    seen = residues.groupBy("entry", "chain").agg(F.sum("ca.x").alias("ca_x"))
    return R.chain_table(residues).join(seen, ["entry", "chain"])
