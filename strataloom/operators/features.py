"""Structure features: edges, backbone frames, continuity masks and position constraints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions import text as X
from ..functions import vector as V
from .pairs import knn_edges
from .scale import neighbour_values

MISSING_LOG_ODDS = 10000.0


def continuity_masks(residues: DataFrame, group: Sequence[str], idx: str) -> DataFrame:
    """phi, psi and omega masks: 1 where the neighbour's index differs by exactly 1."""
    near = neighbour_values(residues, group, idx, {"__before": (idx, -1), "__after": (idx, 1)})
    before = F.coalesce((F.col(idx) - F.col("__before") == 1).cast("int"), F.lit(0))
    after = F.coalesce((F.col("__after") - F.col(idx) == 1).cast("int"), F.lit(0))
    return near.withColumn("phi_mask", before).withColumn("psi_mask", after).withColumn("omega_mask", after).drop("__before", "__after")


def edge_features(residues: DataFrame, group: Sequence[str], idx: str, k: int, chain: str = "chain_no") -> DataFrame:
    """kNN edges over alpha carbons with 25 atom-pair distances, their bases and the relative offset.

    ``residues``: group, idx, chain, mask and n, ca, c, o structs; incomplete residues are masked.
    """
    atoms = residues.withColumn("cb", V.virtual_beta(F.col("n"), F.col("ca"), F.col("c")))
    points = atoms.withColumn("__v", F.array("ca.x", "ca.y", "ca.z"))
    edges = knn_edges(points.where("mask"), group, idx, "__v", k)
    side = lambda s, key: atoms.select(
        *group, F.col(idx).cast("bigint").alias(key), F.struct("n", "ca", "c", "o", "cb").alias(s), F.col(chain).alias(f"{s}_chain"))
    joined = edges.join(side("a", "i"), [*group, "i"]).join(side("b", "j"), [*group, "j"])
    offset = V.relative_offset(F.col("i") - F.col("j"), F.col("a_chain") == F.col("b_chain"))
    distances = V.edge_distances("a", "b")
    return joined.select(*group, "i", "j", "rank", "dist", offset.cast("int").alias("offset"), distances.alias("distances")).withColumn(
        "rbf", F.flatten(F.transform("distances", lambda d: V.rbf(d))))


def trace_frames(residues: DataFrame, group: Sequence[str], idx: str, ca: str = "ca") -> DataFrame:
    """Local frames and angles of an alpha-carbon trace.

    Steps outside 3.6-4.0 A count as breaks. Adds shifted neighbours, the three angle features
    and the frame rows (o, n, o x n); the first and the last two residues have none and get zeros.
    The bend at a residue lies between its own and the next step, the torsion between the planes
    before and after its own step; both enter as sines and cosines, straight from dot products.
    """
    origin = V.vec(F.lit(0.0), F.lit(0.0), F.lit(0.0))
    near = neighbour_values(residues, group, idx, {"__back": (ca, -1), "__next": (ca, 1), "__far": (ca, 2)})
    links = {"__in": ("__back", ca), "__out": (ca, "__next"), "__on": ("__next", "__far")}
    for name, (a, b) in links.items():
        chord = V.sub(F.col(b), F.col(a))
        bonded = (V.norm(chord) > 3.6) & (V.norm(chord) < 4.0)
        near = near.withColumn(name, F.when(F.col(a).isNotNull() & F.col(b).isNotNull(), F.when(bonded, V.unit(chord)).otherwise(origin)))
    normal = lambda a, b: V.unit(V.cross(F.col(a), F.col(b)))
    near = near.withColumns({"__plane": normal("__in", "__out"), "__after": normal("__out", "__on")})
    inner = lambda c: F.greatest(F.lit(1e-6 - 1), F.least(c, F.lit(1 - 1e-6)))
    bend = inner(-V.dot(F.col("__out"), F.col("__on")))
    turn = inner(V.dot(F.col("__plane"), F.col("__after")))
    side = F.signum(V.dot(F.col("__in"), F.col("__after")))
    rest = F.sqrt(1 - bend * bend)
    # without a side there is no torsion: its angle is zero
    angles = F.array(bend, rest * F.when(side == 0, 1.0).otherwise(turn), rest * side * F.sqrt(1 - turn * turn))
    first = V.unit(V.sub(F.col("__in"), F.col("__out")))
    frame = lambda x, y, z: F.struct(x.alias("r0"), y.alias("r1"), z.alias("r2"))
    inside = F.col("__in").isNotNull() & F.col("__on").isNotNull()
    return near.withColumns({
        "ca_before": F.coalesce("__back", origin), "ca_after": F.coalesce("__next", origin),
        "angles": F.when(inside, angles).otherwise(F.array(*[F.lit(0.0)] * 3)),
        "frame": F.when(inside, frame(first, F.col("__plane"), V.cross(first, F.col("__plane")))).otherwise(frame(origin, origin, origin)),
    }).drop("__back", "__next", "__far", *links, "__plane", "__after")


def frame_edges(frames: DataFrame, edges: DataFrame, group: Sequence[str], idx: str, ca: str = "ca") -> DataFrame:
    """Direction of the neighbour in the local frame (3) and the relative rotation as quaternion (4)."""
    side = lambda s, key: frames.select(*group, F.col(idx).cast("bigint").alias(key), F.struct(F.col("frame"), F.col(ca).alias("ca")).alias(s))
    joined = edges.join(side("a", "i"), [*group, "i"]).join(side("b", "j"), [*group, "j"])
    d = V.sub(F.col("b.ca"), F.col("a.ca"))
    rows = [F.col(f"a.frame.r{i}") for i in range(3)]
    local = V.unit(V.vec(*[V.dot(r, d) for r in rows]))
    # transpose(frame a) times frame b
    cell = lambda i, j: sum(F.col(f"a.frame.r{k}")["xyz"[i]] * F.col(f"b.frame.r{k}")["xyz"[j]] for k in range(3))
    relative = F.struct(*[V.vec(*[cell(i, j) for j in range(3)]).alias(f"r{i}") for i in range(3)])
    return joined.select(*group, "i", "j", "rank", local.alias("direction"), V.quaternion(relative).alias("rotation"))


#: Shifted-trace pairs (before 0, own 1, after 2) whose distances follow the own one.
TRACE_PAIRS = ((0, 0), (2, 2), (0, 1), (0, 2), (1, 0), (1, 2), (2, 0), (2, 1))


def trace_edge_distances(frames: DataFrame, edges: DataFrame, group: Sequence[str], idx: str, ca: str = "ca") -> DataFrame:
    """Distances between the own and shifted alpha carbons of both ends of an edge."""
    shifts = F.struct(F.col("ca_before").alias("s0"), F.col(ca).alias("s1"), F.col("ca_after").alias("s2"))
    side = lambda s, key: frames.select(*group, F.col(idx).cast("bigint").alias(key), shifts.alias(s))
    joined = edges.join(side("a", "i"), [*group, "i"]).join(side("b", "j"), [*group, "j"])
    far = [V.distance(F.col(f"a.s{p}"), F.col(f"b.s{q}"), 1e-6) for p, q in TRACE_PAIRS]
    return joined.select(*group, "i", "j", "rank", F.array(F.col("dist"), *far).alias("distances"))


# ---------------------------------------------------------------- constraints on positions

def position_constraints(
    residues: DataFrame, fixed: DataFrame | None = None, omitted: DataFrame | None = None,
    pssm: DataFrame | None = None, bias: DataFrame | None = None,
) -> DataFrame:
    """Constraint columns per residue (name, chain, pos from 1) with their defaults.

    ``fixed``: name, chain, positions. ``omitted``: name, chain, positions, letters. ``pssm``:
    name, chain, coef, bias, log_odds (per position). ``bias``: name, chain, values (per
    position). Defaults: designable 1, no omitted letters, coefficient 0, bias 0, log odds 10000.
    """
    keys = ["name", "chain", "pos"]
    zeros = F.array_repeat(F.lit(0.0), len(X.ALPHABET))
    out = residues
    if fixed is not None:
        flat = fixed.select("name", "chain", F.explode("positions").alias("pos")).distinct().withColumn("__fixed", F.lit(1))
        out = out.join(flat, keys, "left")
    else:
        out = out.withColumn("__fixed", F.lit(None).cast("int"))
    out = out.withColumn("designable", F.lit(1) - F.coalesce("__fixed", F.lit(0))).drop("__fixed")
    if omitted is not None:
        flat = omitted.select("name", "chain", F.explode("positions").alias("pos"), "letters").groupBy(*keys).agg(
            F.array_sort(F.array_distinct(F.flatten(F.collect_list(F.split("letters", ""))))).alias("omitted"))
        out = out.join(flat, keys, "left")
    else:
        out = out.withColumn("omitted", F.lit(None).cast("array<string>"))
    out = out.withColumn("omitted", F.coalesce("omitted", F.array().cast("array<string>")))
    if pssm is not None:
        zipped = pssm.select("name", "chain", F.posexplode(F.arrays_zip("coef", "bias", "log_odds")).alias("p", "z"))
        flat = zipped.select("name", "chain", (F.col("p") + 1).alias("pos"), F.col("z.coef").alias("pssm_coef"),
                             F.col("z.bias").alias("pssm_bias"), F.col("z.log_odds").alias("pssm_log_odds"))
        out = out.join(flat, keys, "left")
    else:
        out = out.withColumns({"pssm_coef": F.lit(None).cast("double"), "pssm_bias": F.lit(None).cast("array<double>"),
                               "pssm_log_odds": F.lit(None).cast("array<double>")})
    out = out.withColumns({
        "pssm_coef": F.coalesce("pssm_coef", F.lit(0.0)), "pssm_bias": F.coalesce("pssm_bias", zeros),
        "pssm_log_odds": F.coalesce("pssm_log_odds", F.array_repeat(F.lit(MISSING_LOG_ODDS), len(X.ALPHABET)))})
    if bias is not None:
        flat = bias.select("name", "chain", F.posexplode("values").alias("p", "residue_bias")).withColumn("pos", F.col("p") + 1).drop("p")
        out = out.join(flat, keys, "left")
    else:
        out = out.withColumn("residue_bias", F.lit(None).cast("array<double>"))
    return out.withColumn("residue_bias", F.coalesce("residue_bias", zeros))


def design_order(chains: DataFrame, structure: str = "name", chain: str = "chain", designed: str = "designed") -> DataFrame:
    """Position of each chain: designed chains first, each side sorted by name; adds ``start``."""
    from .sampling import residue_index

    ordered = chains.withColumn("__order", F.struct((~F.col(designed)).alias("a"), F.col(chain).alias("b")))
    return residue_index(ordered, [structure], "__order", "length").drop("__order")


def tied_positions(ties: DataFrame, chains: DataFrame) -> DataFrame:
    """(name, tie, positions, weights): 0-based global positions of each tie group.

    ``ties``: name, tie, chain, positions (from 1), weights (may be NULL, read 1). ``chains``:
    name, chain, start from ``design_order``.
    """
    flat = ties.select("name", "tie", "chain", F.posexplode(F.arrays_zip(
        "positions", F.coalesce("weights", F.array().cast("array<double>")).alias("weights"))).alias("at", "z"))
    placed = flat.join(chains.select("name", "chain", "start"), ["name", "chain"]).select(
        "name", "tie", "chain", "at", (F.col("start") + F.col("z.positions") - 1).alias("g"), F.coalesce("z.weights", F.lit(1.0)).alias("w"))
    rows = F.array_sort(F.collect_list(F.struct("chain", "at", "g", "w")))
    return placed.groupBy("name", "tie").agg(rows.alias("r")).select(
        "name", "tie", F.transform("r", lambda x: x["g"]).alias("positions"), F.transform("r", lambda x: x["w"]).alias("weights"))


def chain_display(chains: DataFrame, structure: str, chain: str, seq: str, tiebreak: str | None = None) -> DataFrame:
    """(structure, display): the sequences of a structure in chain-name order, joined by ``/``."""
    order = [chain] + ([tiebreak] if tiebreak else [])
    rows = F.array_sort(F.collect_list(F.struct(*[F.col(c).alias(f"k{i}") for i, c in enumerate(order)], F.col(seq).alias("s"))))
    return chains.groupBy(structure).agg(F.array_join(F.transform(rows, lambda r: r["s"]), "/").alias("display"))


def context_example(residues: DataFrame, chains: DataFrame, target: DataFrame) -> DataFrame:
    """Chains of a payload as a design context: target to be designed, the rest given.

    ``chains``: entry, chain, seq, length; ``target``: entry, chain, sequence. Adds role and the
    first broken rule: sequence, alphabet or residue count.
    """
    counted = residues.groupBy("entry", "chain").agg(
        F.count("*").alias("__n"), F.count_if(F.col("n").isNotNull() & F.col("ca").isNotNull() & F.col("c").isNotNull() & F.col("o").isNotNull()).alias("complete"))
    joined = chains.join(target.select("entry", F.col("chain").alias("__t"), F.col("sequence").alias("__s")), "entry").join(
        counted, ["entry", "chain"], "left")
    is_target = F.col("chain") == F.col("__t")
    problem = F.coalesce(
        F.when(is_target & (F.col("seq") != F.col("__s")), "target_sequence"),
        F.when(~F.col("seq").rlike(f"^[{X.CANONICAL}]+$"), "alphabet"),
        F.when(F.coalesce("__n", F.lit(0)) != F.length("seq"), "residue_count"))
    return joined.withColumn("role", F.when(is_target, "designed").otherwise("context")).withColumn("problem", problem).drop("__t", "__s", "__n")
