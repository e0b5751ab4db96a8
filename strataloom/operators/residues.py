"""Atoms to residues to chains: filters, best atoms, sequences, coverage and similarity edges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from ..functions import text as X
from ..functions.align import identity
from ..functions.vector import vec
from ..session import shuffle_width
from .scale import row_numbers

ATOM_NAMES = ("N", "CA", "C", "O")


def protein_entities(entity_poly: DataFrame, entity_poly_seq: DataFrame, entry: str = "entry") -> DataFrame:
    """(entry, entity_id) of L-polypeptides; entries that declare none use every polymer entity."""
    declared = entity_poly.where(
        F.startswith(F.lower(F.coalesce(X.clean_token(F.col("type")), F.lit(""))), F.lit("polypeptide(l)"))
    ).select(entry, X.clean_token(F.col("entity_id")).alias("entity_id")).where("entity_id is not null").distinct()
    polymers = entity_poly_seq.select(entry, X.clean_token(F.col("entity_id")).alias("entity_id")).where("entity_id is not null").distinct()
    fallback = polymers.join(declared.select(entry).distinct(), entry, "left_anti")
    return declared.unionByName(fallback)


def filter_atoms(atoms: DataFrame, entities: DataFrame, entry: str = "entry") -> DataFrame:
    """Backbone atoms of model 1 that count, with typed coordinates.

    ATOM or HETATM; alternate location none, A or 1; numbered residue; finite coordinates; an
    entity of the protein list, or a known residue where the entry has no list. Unusable
    occupancy reads 1, unusable B factor 0.
    """
    token = lambda c, default=None: X.clean_token(F.col(c), default)
    typed = atoms.select(
        entry, F.col("row").alias("row"), F.upper(token("group_pdb", "ATOM")).alias("group_pdb"),
        token("pdbx_pdb_model_num", "1").alias("model"), F.upper(token("label_atom_id")).alias("atom"),
        token("label_alt_id", ".").alias("alt"), token("label_asym_id").alias("chain"),
        token("label_entity_id", "0").alias("entity_id"), X.sequence_number(F.col("label_seq_id")).alias("seq_id"),
        X.residue_letter(F.coalesce("label_comp_id", F.lit(""))).alias("aa"),
        *[X.finite_double(F.trim(c)).alias(a) for c, a in (("cartn_x", "x"), ("cartn_y", "y"), ("cartn_z", "z"))],
        F.coalesce(X.finite_double(token("occupancy")), F.lit(1.0)).alias("occ"),
        F.coalesce(X.finite_double(token("b_iso_or_equiv")), F.lit(0.0)).alias("bfac"))
    narrow = typed.where(
        F.col("group_pdb").isin("ATOM", "HETATM") & (F.col("model") == "1") & F.col("atom").isin(*ATOM_NAMES)
        & F.col("alt").isin(".", "?", "A", "1") & F.col("chain").isNotNull() & F.col("seq_id").isNotNull()
        & F.col("x").isNotNull() & F.col("y").isNotNull() & F.col("z").isNotNull())
    listed = entities.select(entry, "entity_id", F.lit(True).alias("__listed"))
    has_list = entities.select(entry).distinct().withColumn("__has", F.lit(True))
    marked = narrow.join(listed, [entry, "entity_id"], "left").join(has_list, entry, "left")
    return marked.where(
        F.col("__listed") | (F.col("__has").isNull() & (F.col("aa") != "X"))
    ).select(entry, "chain", "entity_id", "seq_id", "atom", "aa", "occ", "bfac", "row",
             vec(F.col("x"), F.col("y"), F.col("z")).alias("xyz"))


def best_atoms(atoms: DataFrame, keys: list[str], occupancy: str = "occ", row: str = "row") -> DataFrame:
    """One atom per key: highest occupancy, the earlier row on ties."""
    rest = [c for c in atoms.columns if c not in keys]
    best = atoms.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(F.col(occupancy), -F.col(row))).alias("__a"))
    return best.select(*keys, *[F.col(f"__a.{c}").alias(c) for c in rest])


def majority_entity(votes: DataFrame, entry: str = "entry") -> DataFrame:
    """(entry, chain, entity_id) with most votes; ties go to the entity seen first.

    ``votes``: entry, chain, entity_id, source (0 polymer scheme, 1 atoms), row.
    """
    counted = votes.groupBy(entry, "chain", "entity_id").agg(
        F.count("*").alias("n"), F.min(F.struct("source", "row")).alias("first"))
    return counted.groupBy(entry, "chain").agg(
        F.min_by("entity_id", F.struct(-F.col("n"), "first")).alias("entity_id"))


def chain_positions(scheme: DataFrame, entity_seq: DataFrame, chains: DataFrame, entities: DataFrame, entry: str = "entry") -> DataFrame:
    """(entry, chain, entity_id, seq_id, aa): polymer positions of each chain.

    The chain's own scheme counts; a chain without one takes the sequence of its entity. When a
    position is listed twice the later row wins.
    """
    own = scheme.select(
        entry, X.clean_token(F.col("asym_id")).alias("chain"), X.clean_token(F.col("entity_id")).alias("__entity"),
        X.sequence_number(F.col("seq_id")).alias("seq_id"), X.residue_letter(F.coalesce("mon_id", F.lit(""))).alias("aa"), "row",
    ).where("chain is not null and __entity is not null and seq_id is not null")
    own = own.join(entities.select(entry, F.col("entity_id").alias("__entity")), [entry, "__entity"], "left_semi")
    own = own.groupBy(entry, "chain", "seq_id").agg(F.max_by("aa", "row").alias("aa"))
    shared = entity_seq.select(
        entry, X.clean_token(F.col("entity_id")).alias("entity_id"), X.sequence_number(F.col("num")).alias("seq_id"),
        X.residue_letter(F.coalesce("mon_id", F.lit(""))).alias("aa"), "row",
    ).where("entity_id is not null and seq_id is not null").groupBy(entry, "entity_id", "seq_id").agg(F.max_by("aa", "row").alias("aa"))
    with_own = chains.join(own, [entry, "chain"])
    without = chains.join(own.select(entry, "chain").distinct(), [entry, "chain"], "left_anti").join(shared, [entry, "entity_id"])
    columns = [entry, "chain", "entity_id", "seq_id", "aa"]
    return with_own.select(columns).unionByName(without.select(columns))


def residue_table(positions: DataFrame, atoms: DataFrame, min_length: int, max_length: int, entry: str = "entry") -> DataFrame:
    """(entry, chain, entity_id, pos, seq_id, aa, n, ca, c, o): every polymer position, with NULL
    coordinates where nothing was observed.

    Chains outside the length bounds are dropped by a count before any chain is put together, so
    the arrays built here hold at most ``max_length`` residues.
    """
    sized = positions.groupBy(entry, "chain").agg(F.count("*").alias("__n")).where(
        F.col("__n").between(min_length, max_length)).select(entry, "chain")
    rows = positions.join(sized, [entry, "chain"], "left_semi").groupBy(entry, "chain", "entity_id").agg(
        F.array_sort(F.collect_list(F.struct("seq_id", "aa"))).alias("r"))
    placed = rows.select(entry, "chain", "entity_id", F.posexplode("r").alias("pos", "r")).select(
        entry, "chain", "entity_id", "pos", "r.seq_id", "r.aa")
    wide = atoms.groupBy(entry, "chain", "seq_id").agg(*[
        F.max(F.when(F.col("atom") == a, F.struct("xyz", "occ", "bfac"))).alias(a.lower()) for a in ATOM_NAMES])
    joined = placed.join(wide, [entry, "chain", "seq_id"], "left")
    return joined.select(
        entry, "chain", "entity_id", "pos", "seq_id", "aa",
        *[F.col(f"{a.lower()}.xyz").alias(a.lower()) for a in ATOM_NAMES],
        F.array(*[F.coalesce(F.col(f"{a.lower()}.occ"), F.lit(0.0)) for a in ATOM_NAMES]).alias("occ"),
        F.array(*[F.coalesce(F.col(f"{a.lower()}.bfac"), F.lit(0.0)) for a in ATOM_NAMES]).alias("bfac"))


def resolved() -> Column:
    """TRUE where all four backbone atoms were observed."""
    return F.col("n").isNotNull() & F.col("ca").isNotNull() & F.col("c").isNotNull() & F.col("o").isNotNull()


def chain_table(residues: DataFrame, entry: str = "entry", with_mask: bool = False) -> DataFrame:
    """(entry, chain, entity_id, seq, length, resolved, coverage[, resolved_mask]) per chain."""
    rows = F.array_sort(F.collect_list(F.struct("pos", "aa", resolved().alias("ok"))))
    grouped = residues.groupBy(entry, "chain", "entity_id").agg(
        rows.alias("r"), F.count("*").alias("length"), F.count_if(resolved()).alias("resolved"))
    columns = [
        entry, "chain", "entity_id", F.array_join(F.transform("r", lambda x: x["aa"]), "").alias("seq"), "length", "resolved",
        (F.col("resolved") / F.col("length")).alias("coverage")]
    if with_mask:
        columns.append(F.transform("r", lambda x: x["ok"]).alias("resolved_mask"))
    return grouped.select(*columns)


def quality_gate(chains: DataFrame, min_length: int, max_length: int, min_resolved: int = 0, min_coverage: float = 0.0) -> DataFrame:
    return chains.where(
        F.col("length").between(min_length, max_length) & (F.col("resolved") >= min_resolved) & (F.col("coverage") >= min_coverage))


def context_size(chains: DataFrame, entry: str = "entry") -> DataFrame:
    return chains.groupBy(entry).agg(F.count("*").alias("context_chains"), F.sum("length").alias("context_length"))


def remap_chains(chains: DataFrame, entry: str = "entry", out: str = "chain_id") -> DataFrame:
    """Letters for the sorted source ids of an entry: A-Z, a-z, 0-9; a 63rd chain is an error."""
    letters = F.array(*[F.lit(x) for x in X.CHAIN_LETTERS])
    return row_numbers(chains, ["chain"], "__at", [entry]).withColumn(
        out, F.coalesce(F.get(letters, (F.col("__at") - 1).cast("int")), F.raise_error(F.concat(
            F.lit("no chain letter is left in "), F.col(entry).cast("string"))).cast("string"))).drop("__at")


def with_cluster(rows: DataFrame, cluster_map: DataFrame, keys: list[str], sequence: str, out: str = "cluster") -> DataFrame:
    """Cluster from the map, or a synthetic id from the sequence hash where the map has none."""
    return rows.join(cluster_map, keys, "left").withColumn(
        out, F.coalesce(F.col(out), X.synthetic_cluster(F.col(sequence))))


def target_identity(chains: DataFrame, entry: str, id: str, is_target: str, entity: str, cluster: str, seq: str) -> DataFrame:
    """(entry, chain_a, chain_b, identity) between the target and each chain of its entry.

    1 for the same entity or sequence, the aligned identity inside one cluster, 0 otherwise. Only
    pairs with the target exist, and only those not settled by a comparison are aligned.
    """
    target = chains.where(F.col(is_target)).select(
        entry, F.col(id).alias("chain_a"), F.col(entity).alias("__e"), F.col(cluster).alias("__c"), F.col(seq).alias("__s"))
    pairs = chains.join(target, entry).withColumn("__known",
        F.when((F.col(entity) == F.col("__e")) | (F.col(seq) == F.col("__s")), F.lit(1.0))
        .when(F.col(cluster) != F.col("__c"), F.lit(0.0)))
    columns = [entry, "chain_a", F.col(id).alias("chain_b")]
    settled = pairs.where(F.col("__known").isNotNull()).select(*columns, F.col("__known").alias("identity"))
    # alignment cost is quadratic in length: spread the open pairs evenly, whatever their entry
    open_pairs = pairs.where(F.col("__known").isNull()).select(*columns, "__s", seq).repartition(
        max(shuffle_width(chains.sparkSession), chains.sparkSession.sparkContext.defaultParallelism), entry, "chain_b")
    return settled.unionByName(open_pairs.select(entry, "chain_a", "chain_b", identity(F.col("__s"), F.col(seq)).alias("identity")))
