"""Training examples: grouping, assemblies, roles, tags and length caps."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window as W, functions as F

from ..functions import text as X
from ..functions.vector import rigid
from .scale import row_numbers

MAX_CHAINS = 351


def group_by_cluster(rows: DataFrame, split: str, cluster: str, record: list[str], debug: bool = False, order: str | None = None) -> DataFrame:
    """(split, cluster, member, record columns): the records of each cluster, numbered from 1.

    One row per member, so that a cluster of any size stays spread over tasks. ``debug`` keeps the
    first 20 rows, holds nothing out and validates on the training clusters.
    """
    if debug:
        rows = rows.orderBy(order or record[0]).limit(20).withColumn(split, F.lit("train"))
        rows = rows.unionByName(rows.withColumn(split, F.lit("valid")))
    return row_numbers(rows.select(split, cluster, *record), record, "member", [split, cluster])


def expand_assemblies(wanted: DataFrame, assemblies: DataFrame, chains: DataFrame, seed: int) -> DataFrame:
    """(example, entry, chain, k, copy, rotation, shift): the chain copies of one assembly per example.

    ``wanted``: example, entry, chain. ``assemblies``: entry, asmb_id, k, asmb_chains (comma
    list), xforms (array of 4x4). One assembly that holds the chain is drawn by hash; an example
    whose chain is in none keeps its chain alone.
    """
    listed = assemblies.withColumn("__chains", F.split("asmb_chains", ","))
    holds = wanted.join(listed.select("entry", "asmb_id", F.explode("__chains").alias("chain")).distinct(), ["entry", "chain"])
    drawn = holds.groupBy("example").agg(
        F.min_by("asmb_id", F.struct(X.rank_hash(seed, F.col("example"), F.col("asmb_id")), "asmb_id")).alias("asmb_id"))
    picked = wanted.join(drawn, "example").join(listed, ["entry", "asmb_id"]).select(
        "example", "entry", "k", F.explode("__chains").alias("chain"), "xforms").distinct()
    known = picked.join(chains.select("entry", "chain"), ["entry", "chain"], "left_semi")
    copies = known.select("example", "entry", "chain", "k", F.posexplode("xforms").alias("copy", "m"))
    row = lambda i: F.slice(F.get("m", F.lit(i)), 1, 3)
    moved = copies.select(
        "example", "entry", "chain", "k", "copy", F.array(row(0), row(1), row(2)).alias("rotation"),
        F.array(*[F.get(F.get("m", F.lit(i)), F.lit(3)) for i in range(3)]).alias("shift"))
    alone = wanted.join(drawn.select("example"), "example", "left_anti").select(
        "example", "entry", "chain", F.lit(0).alias("k"), F.lit(0).alias("copy"),
        F.expr("array(array(1D,0D,0D), array(0D,1D,0D), array(0D,0D,1D))").alias("rotation"), F.expr("array(0D,0D,0D)").alias("shift"))
    return moved.unionByName(alone)


def transform_residues(residues: DataFrame, copies: DataFrame, atoms: tuple[str, ...] = ("n", "ca", "c", "o")) -> DataFrame:
    """Residues of every chain copy with ``u . x + r`` applied to their atoms."""
    joined = residues.join(copies, ["entry", "chain"])
    return joined.select(
        *[c for c in joined.columns if c not in (*atoms, "rotation", "shift")],
        *[F.when(F.col(a).isNotNull(), rigid(F.col("rotation"), F.col("shift"), F.col(a))).alias(a) for a in atoms])


def homologous_chains(edges: DataFrame, cutoff: float = 0.70, identity: str = "identity") -> DataFrame:
    """Chain pairs whose identity is strictly above the cutoff."""
    return edges.where(F.col(identity) > cutoff)


def chain_examples(copies: DataFrame, order: list[str]) -> DataFrame:
    """Adds ``idx``, the position of a chain copy in its example, and its chain name.

    An assembly has at most a few hundred copies; examples with more than 351 are left out.
    """
    counted = copies.groupBy("example").agg(F.count("*").alias("__n")).where(F.col("__n") <= MAX_CHAINS).select("example")
    kept = copies.join(counted, "example", "left_semi")
    idx = F.row_number().over(W.partitionBy("example").orderBy(*order)) - 1  # at most 351 copies
    letters = F.array(*[F.lit(x) for x in X.CHAIN_LETTERS[:52]])
    return kept.withColumn("idx", idx).withColumn(
        "letter", F.when(F.col("idx") < 52, F.get(letters, F.col("idx"))).otherwise((F.col("idx") - 52).cast("string")))


def trim_chain_tags(chains: DataFrame, seq: str = "seq", min_left: int = 4) -> DataFrame:
    """Cut tags off both ends; adds the cut lengths and drops chains left with fewer than ``min_left``."""
    front, back = X.trim_tags(F.col(seq))
    return chains.withColumn("cut_front", front).withColumn("cut_back", back).withColumn(
        seq, F.substr(seq, F.col("cut_front") + 1, F.greatest(F.length(seq) - F.col("cut_front") - F.col("cut_back"), F.lit(0)))
    ).where(F.length(seq) >= min_left)


def promote_same_sequence(chains: DataFrame, example: str, seq: str, masked: str) -> DataFrame:
    """Visible chains whose sequence a masked chain of the example has become masked as well."""
    hidden = chains.where(F.col(masked)).select(example, F.sha2(seq, 256).alias("__h"), F.lit(True).alias("__m")).distinct()
    joined = chains.withColumn("__h", F.sha2(seq, 256)).join(hidden, [example, "__h"], "left")
    return joined.withColumn(masked, F.col(masked) | F.coalesce("__m", F.lit(False))).drop("__h", "__m")


def assemble_examples(chains: DataFrame, example: str, order: str, max_length: int = 10_000, max_units: int | None = None) -> DataFrame:
    """One row per example: joined sequence, masked and visible chain names, chain count.

    Examples above ``max_length`` residues are left out; ``max_units`` keeps the first examples.
    """
    # the cap is applied to the sizes, before any example is put together
    fits = chains.groupBy(example).agg(F.sum(F.length("seq")).alias("__n")).where(F.col("__n") <= max_length).select(example)
    rows = F.array_sort(F.collect_list(F.struct(order, "letter", "seq", "masked")))
    out = chains.join(fits, example, "left_semi").groupBy(example).agg(rows.alias("r")).select(
        example,
        F.array_join(F.transform("r", lambda x: x["seq"]), "").alias("seq"),
        F.transform(F.filter("r", lambda x: x["masked"]), lambda x: x["letter"]).alias("masked_list"),
        F.transform(F.filter("r", lambda x: ~x["masked"]), lambda x: x["letter"]).alias("visible_list"),
        F.size("r").alias("num_of_chains"))
    return out.orderBy(example).limit(max_units) if max_units is not None else out


def loss_mask(residues: DataFrame, chains: DataFrame, keys: list[str]) -> DataFrame:
    """Residue rows with their label and 1 where the residue is to be predicted."""
    return residues.join(chains.select(*keys, "masked"), keys).withColumn(
        "label", X.residue_label(F.col("aa"))).withColumn("chain_mask", F.col("masked").cast("int")).drop("masked")


def example_summary(examples: DataFrame, id: str = "example") -> DataFrame:
    return examples.select(
        id, F.length("seq").alias("sequence_length"), "num_of_chains", F.size("masked_list").alias("masked_chains"),
        F.array(F.length("seq"), F.lit(4), F.lit(3)).alias("coordinate_shape"))


def residue_index(chains: DataFrame, structure: list[str], order: str, length: str, jump: int = 100) -> DataFrame:
    """Adds ``chain_no`` (from 1), ``start`` (residues before the chain) and ``index_start``.

    Residue p of a chain has index ``jump * (chain_no - 1) + start + p``, so chains are ``jump``
    apart. Runs as a distributed scan: a structure may have any number of chains.
    """
    from .scale import ordered_scan

    scanned = ordered_scan(
        chains.withColumn("__one", F.lit(1).cast("bigint")), [order],
        {"chain_no": ("sum", "__one"), "start": ("sum", length)}, structure, exclusive=["start"])
    return scanned.withColumn("index_start", F.lit(jump) * (F.col("chain_no") - 1) + F.col("start")).drop("__one")
