"""Files to residues to crops, neighbours and agreement metrics."""

import gzip
import math
import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from strataloom.functions import align
from strataloom.functions.align import sequence_identity
from strataloom.operators import audit, crop as K, features, filters as L, pairs as P, residues as R, sampling, select as S
from strataloom.operators.metrics import structure_metrics, superpose
from strataloom.sources import sinks, structure as X

CIF = """data_X
# a comment
_exptl.method 'X-RAY DIFFRACTION'
_refine.ls_d_res_high 2.0
_pdbx_database_status.recvd_initial_deposition_date 2022-01-05
_struct.title
;a text block
with two lines
;
_entity_poly.entity_id 1
_entity_poly.type 'polypeptide(L)'
loop_
_entity_poly_seq.entity_id
_entity_poly_seq.num
_entity_poly_seq.mon_id
1 1 ALA
1 2 GLY
1 3 SER
1 4 VAL
loop_
_pdbx_poly_seq_scheme.asym_id
_pdbx_poly_seq_scheme.entity_id
_pdbx_poly_seq_scheme.seq_id
_pdbx_poly_seq_scheme.mon_id
A 1 1 ALA
A 1 2 GLY
A 1 3 SER
A 1 4 VAL
loop_
_atom_site.group_PDB
_atom_site.label_atom_id
_atom_site.label_comp_id
_atom_site.label_asym_id
_atom_site.label_entity_id
_atom_site.label_seq_id
_atom_site.label_alt_id
_atom_site.Cartn_x
_atom_site.Cartn_y
_atom_site.Cartn_z
_atom_site.occupancy
_atom_site.B_iso_or_equiv
_atom_site.pdbx_PDB_model_num
"""
ATOMS = [("N", "ALA", 1), ("CA", "ALA", 1), ("C", "ALA", 1), ("O", "ALA", 1), ("CB", "ALA", 1),
         ("N", "SER", 3), ("CA", "SER", 3), ("C", "SER", 3), ("O", "SER", 3)]


def write_cif(folder):
    rows = "".join(f"ATOM {a} {r} A 1 {n} . {i}.0 0.5 1.0 1.00 9.0 1\n" for i, (a, r, n) in enumerate(ATOMS))
    # a second, worse alternative and another model must not count
    rows += "ATOM CA ALA A 1 1 A 99.0 0.5 1.0 0.40 9.0 1\nATOM CA ALA A 1 1 . 98.0 0.5 1.0 1.00 9.0 2\n"
    with gzip.open(folder / "1abc-assembly1.cif.gz", "wt") as f:
        f.write(CIF + rows)
    (folder / "2bad-assembly1.cif").write_text("data_X\nloop_\n_atom_site.a\n_atom_site.b\n1 2 3\n")


def tables(spark, folder):
    files = X.discover_assemblies(X.list_files(spark, str(folder)))
    parsed = X.read_mmcif(spark, files)
    named = X.with_file_ids(parsed).withColumnRenamed("entry_id", "entry")
    table = lambda c: X.with_file_ids(X.category_table(parsed, c)).withColumnRenamed("entry_id", "entry")
    return parsed, table, named


def test_mmcif_keeps_missing_coordinates(spark, tmp_path):
    write_cif(tmp_path)
    parsed, table, _ = tables(spark, tmp_path)
    entities = R.protein_entities(table("entity_poly"), table("entity_poly_seq"))
    atoms = R.best_atoms(R.filter_atoms(table("atom_site"), entities), ["entry", "chain", "seq_id", "atom"])
    votes = table("pdbx_poly_seq_scheme").select("entry", F.col("asym_id").alias("chain"), "entity_id", F.lit(0).alias("source"), "row").unionByName(
        atoms.select("entry", "chain", "entity_id", F.lit(1).alias("source"), "row"))
    chains = R.majority_entity(votes)
    positions = R.chain_positions(table("pdbx_poly_seq_scheme"), table("entity_poly_seq"), chains, entities)
    residues = R.residue_table(positions, atoms, 1, 100)
    row = R.chain_table(residues, with_mask=True).first()
    assert (row["entry"], row["seq"], row["resolved"], row["coverage"]) == ("1abca1", "AGSV", 2, 0.5)
    assert list(row["resolved_mask"]) == [True, False, True, False]
    first = residues.where("pos = 0").first()
    assert first["ca"]["x"] == 1.0
    head = X.header_fields(parsed).first()
    assert (head["method"], head["date"], head["resolution"]) == ("X-RAY DIFFRACTION", "2022-01-05", 2.0)
    failed = X.parse_failures(parsed).collect()
    assert len(failed) == 1 and failed[0]["reason"] == "mmcif_parse_error"
    # without a scheme the entity's sequence serves
    none = table("pdbx_poly_seq_scheme").where("false")
    fallback = R.chain_positions(none, table("entity_poly_seq"), chains, entities)
    assert fallback.count() == 4


def test_one_outcome_per_file_and_no_rows_of_failed_files(spark, tmp_path):
    write_cif(tmp_path)
    atoms = "".join(f"ATOM CA ALA A 1 {n} . 1.0 0.5 1.0 1.00 9.0 1\n" for n in range(20))
    late = CIF + atoms + "data_second\n_exptl.method\n;never closed\n"
    (tmp_path / "3lat-assembly1.cif").write_text(late)
    (tmp_path / "4non-assembly1.cif").write_text("data_X\n_cell.length_a 1.0\n")
    (tmp_path / "5sid-assembly1.cif").write_text(CIF + "ATOM CB ALA A 1 1 . 1.0 0.5 1.0 1.00 9.0 1\n")
    (tmp_path / "6big-assembly1.cif").write_text("x" * 100_000)
    files = X.discover_assemblies(X.list_files(spark, str(tmp_path)))
    kept, skipped = X.size_bounded(files, 50_000)
    spark.conf.set("spark.sql.sources.binaryFile.maxLength", 60_000)
    try:
        # the file that was not chosen would fail the job if it were opened
        rows = X.read_mmcif(spark, kept, chunk=2).collect()
    finally:
        spark.conf.unset("spark.sql.sources.binaryFile.maxLength")
    by_file = {}
    for r in rows:
        by_file.setdefault(r["path"].rsplit("/", 1)[-1][:4], []).append(r["category"])
    assert skipped.count() == 1 and set(by_file) == {"1abc", "2bad", "3lat", "4non", "5sid"}
    assert by_file["2bad"] == by_file["3lat"] == ["error"] and by_file["4non"] == ["parsed"]
    assert all(c.count("parsed") == 1 for f, c in by_file.items() if f not in ("2bad", "3lat"))
    heads = {r["path"].rsplit("/", 1)[-1][:4]: r["atom_rows"] for r in X.header_fields(X.read_mmcif(spark, kept)).collect()}
    # atoms beside the backbone count as atom rows
    assert heads["4non"] == 0 and heads["5sid"] == 1 and heads["1abc"] > 8


def test_file_discovery(spark, tmp_path):
    for n in ("5naf-assembly4", "5naf-assembly10", "5naf-assembly2", "5naf-assembly1", "1abc-assembly2"):
        (tmp_path / f"{n}.cif.gz").write_bytes(b"x" * 10)
    (tmp_path / "notes.cif").write_bytes(b"x" * 50)
    files = X.list_files(spark, str(tmp_path))
    first = X.discover_assemblies(files, policy="first").collect()
    assert sorted(r["path"].rsplit("/", 1)[1] for r in first) == ["1abc-assembly2.cif.gz", "5naf-assembly1.cif.gz"]
    assert X.discover_assemblies(files, assembly_id="2").count() == 2
    kept, skipped = X.size_bounded(X.with_file_ids(files), 20)
    assert kept.count() == 5 and [r["reason"] for r in skipped.collect()] == ["raw_file_size"]
    assert X.with_file_ids(files).where("pdb_id is null").count() == 1
    assert X.discover_assemblies(files, limit=2).count() == 2


def test_metadata_rules_come_before_content(spark):
    rows = spark.createDataFrame([("1ABC", "2020-01-01", "X-RAY DIFFRACTION", 2.0), ("2ABC", "2022-01-01", "SOLUTION NMR", 2.0),
                                  ("3ABC", "2022-01-01", "X-RAY DIFFRACTION", 4.0), ("4ABC", None, None, None)],
                                 "pdb_id string, date string, method string, resolution double").withColumn("date", F.col("date").cast("date"))
    out = L.reason_cascade(rows, L.metadata_rules(["X-RAY", "ELECTRON"], "2021-08-03", None, 3.5))
    assert [r["reason"] for r in out.orderBy("pdb_id").collect()] == ["date", "method", "resolution", None]
    late = out.withColumns({"header_method": F.lit(None).cast("string"), "header_date": F.lit("2022-02-02"), "header_resolution": F.lit(2.0), "atom_rows": F.lit(0)})
    assert late.where("pdb_id = '4ABC'").select(L.first_reason(L.content_rules([], "2021-08-03", None, 3.5))).first()[0] == "no_atoms"


def test_target_choice(spark):
    rows = spark.createDataFrame([("e", "B", 8, 0.8), ("e", "A", 8, 0.8), ("e", "C", 7, 1.0)], "entry string, chain string, resolved int, coverage double")
    assert S.target_member(rows, ["entry"], ["resolved", "coverage"], "chain").first()["chain"] == "A"


def crop_case(spark, chains, points, budget, min_len, **gates):
    """chains: {name: length}; points: {name: {pos: x}} on a line."""
    pts = spark.createDataFrame([("e", c, i, [float(x), 0.0, 0.0]) for c, p in points.items() for i, x in p.items()],
                                "entry string, chain string, pos int, xyz array<double>")
    rows = spark.createDataFrame([("e", c, n, len(points[c]), len(points[c]) / n, [i in points[c] for i in range(n)]) for c, n in chains.items()],
                                 "entry string, chain string, length int, resolved int, coverage double, resolved_mask array<boolean>")
    target = S.target_member(rows.select("entry", "chain", "resolved", "coverage"), ["entry"], ["resolved", "coverage"], "chain").select("entry", "chain")
    near = P.nearest_pairs(pts, ["entry"], "chain", "pos", "xyz", target, tile_rows=16)
    joined = rows.join(target.select("entry", F.col("chain").alias("t")), "entry").withColumn("is_target", F.col("chain") == F.col("t")).join(near, ["entry", "chain"], "left")
    ranked = S.spatial_rank(joined.where("not is_target"), ["entry"], "distance", "chain").unionByName(joined.where("is_target"), allowMissingColumns=True)
    out = []
    for block in (1, 100):
        crops, skipped = K.budget_crop(ranked.withColumn("center", F.col("context_index")), budget, 62, min_len, block=block, **gates)
        out.append(({r["chain"]: (r["start"], r["end"], r["kind"]) for r in crops.collect()}, [r["reason"] for r in skipped.collect()]))
    assert out[0] == out[1]
    return out[0]


def test_crop_window(spark):
    points = {"A": {i: 0 for i in range(100)}, "B": {i: abs(i - 40) + 1 for i in range(80)}, "C": {i: 100 for i in range(70)}}
    crops, _ = crop_case(spark, {"A": 100, "B": 80, "C": 70}, points, 150, 30)
    assert crops == {"A": (0, 100, "full_target"), "B": (15, 65, "context_window")}


def test_crop_target_too_long(spark):
    crops, skipped = crop_case(spark, {"A": 101}, {"A": {i: i for i in range(101)}}, 100, 30)
    assert crops == {} and skipped == ["target_too_long_for_complete_crop"]


def test_crop_skips_a_sparse_window_at_no_cost(spark):
    points = {"A": {i: 0 for i in range(70)}, "B": {**{i: 100 for i in range(30)}, 80: 1}, "C": {i: 10 for i in range(30)}}
    crops, _ = crop_case(spark, {"A": 70, "B": 100, "C": 30}, points, 100, 30, min_resolved=30, min_coverage=0.5)
    assert crops == {"A": (0, 70, "full_target"), "C": (0, 30, "full_context")}


def test_crop_groups_entries_once(spark):
    lines = [(e, k, (7 * e + 5 * k) % 11 + 5, None if k == 3 else float((3 * k + e) % 4)) for e in range(6) for k in range(1, 2 + 2 * e)]
    rows = spark.createDataFrame(lines, "entry int, line int, length bigint, price double")
    plain = K.rank_chains(rows, ["line"], "length", "price")
    scanned = K.rank_chains(rows, ["line"], "length", "price", group_rows=3)
    found = {tuple(r) for r in plain.collect()}
    assert found == {tuple(r) for r in scanned.select(plain.columns).collect()} and len(found) == len(lines)
    for e in range(6):
        mine = [r for r in lines if r[0] == e]
        target = min(mine, key=lambda r: (-r[2], r[1]))
        context = sorted((r for r in mine if r is not target), key=lambda r: (float("inf") if r[3] is None else r[3], r[1]))
        assert {(r["chain"], r["is_target"], r["spatial_rank"]) for r in plain.where(F.col("entry") == e).collect()} == {
            (target[1], True, None)} | {(r[1], False, i + 1) for i, r in enumerate(context)}
    crops, _ = K.budget_crop(plain.withColumn("center", F.floor(F.col("length") / 3)), 25, 4, 5)
    # the target, its chains and the walk meet in one shuffle at most
    assert crops._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") <= 1
    assert {r["entry"] for r in crops.where("kind = 'full_target'").collect()} == set(range(6))


def test_alignment_identity():
    assert sequence_identity("ACDE", "ACXDE") == 0.8
    assert sequence_identity("", "A") == 0.0 and sequence_identity("AB", "AB") == 1.0


def plain_matches(a, b):
    """The whole table, cell by cell: (score in tenths, matches) ending in a pair, a gap in b, a gap in a."""
    low = (-10**9, 0)
    best, down, side = {}, {}, {}
    for i in range(len(a) + 1):
        for j in range(len(b) + 1):
            add = lambda cell, score, n=0: (cell[0] + score, cell[1] + n)
            down[i, j] = max(add(best[i - 1, j], -10), add(down[i - 1, j], -1)) if i else low
            side[i, j] = max(add(best[i, j - 1], -10), add(side[i, j - 1], -1)) if j else low
            same = bool(i and j and a[i - 1] == b[j - 1])
            pair = add(best[i - 1, j - 1], 10 * same, same) if i and j else low if i or j else (0, 0)
            best[i, j] = max(pair, down[i, j], side[i, j])
    return best[len(a), len(b)][1]


def test_pairs_are_aligned_side_by_side(monkeypatch):
    random = np.random.default_rng(5)
    word = lambda letters: "".join(random.choice(list(letters), random.integers(1, 30)))
    pairs = [(word(letters), word(letters)) for letters in ("ab", "ACDEFGHIKLMNPQRSTVWY", "é😀a") for _ in range(100)]
    batches, whole = [], align._matches
    monkeypatch.setattr(align, "_matches", lambda some: batches.append(len(some)) or whole(some))
    assert align.aligned_matches(pairs).tolist() == [plain_matches(a, b) for a, b in pairs]
    assert sum(batches) == 300 and len(batches) == 1  # one pass a diagonal for all of them
    # beyond 32 bits, and a batch of very different lengths
    long = "".join(random.choice(list("abc"), 9000))
    assert align.aligned_matches([(long, long[:100] + long[150:]), ("a", "ba"), (long[:50], long)]).tolist() == [8950, 1, 50]


def test_identity_only_where_it_is_open(spark):
    rows = [("e", "A", True, "1", 7, "ACDE"), ("e", "B", False, "2", 7, "ACXDE"), ("e", "C", False, "1", 8, "GGG"), ("e", "D", False, "3", 9, "ACDF")]
    df = spark.createDataFrame(rows, "entry string, id string, t boolean, entity string, cluster int, seq string")
    got = {r["chain_b"]: r["identity"] for r in R.target_identity(df, "entry", "id", "t", "entity", "cluster", "seq").collect()}
    assert got == {"A": 1.0, "B": 0.8, "C": 1.0, "D": 0.0}
    edges = R.target_identity(df, "entry", "id", "t", "entity", "cluster", "seq")
    assert {r["chain_b"] for r in sampling.homologous_chains(edges, 0.8).collect()} == {"A", "C"}


def brute_knn(points, k, eps=1e-6):
    out = {}
    for g, rows in points.groupby("g"):
        v, ids = np.stack(rows["v"]), rows["id"].to_numpy()
        for i, row in zip(ids, v):
            d = np.sqrt(((v - row) ** 2).sum(1) + eps)
            order = sorted(zip(d.round(9), ids))[:k]
            out[(g, i)] = [j for _, j in order]
    return out


def test_neighbours_across_tiles(spark):
    rng = np.random.default_rng(0)
    rows = [(g, i, rng.normal(size=3).round(3).tolist()) for g, n in (("a", 90), ("b", 25), ("c", 3)) for i in range(n)]
    rows += [("a", 1000 + i, rows[0][2]) for i in range(12)]  # exact copies
    points = pd.DataFrame(rows, columns=["g", "id", "v"])
    df = spark.createDataFrame(rows, "g string, id bigint, v array<double>")
    edges = P.knn_edges(df, ["g"], "id", "v", 5, tile_rows=8, cell=0.5).toPandas().sort_values("rank")
    got = {k: d["j"].tolist() for k, d in edges.groupby(["g", "i"])}
    assert got == brute_knn(points, 5)


def test_masked_rows_fill_short_lists(spark):
    rows = [("a", i, [x, 0.0, 0.0], i < 2) for i, x in enumerate([0.0, 1.0, 9.0, 9.0])]
    df = spark.createDataFrame(rows, "g string, id bigint, v array<double>, m boolean")
    got = {(r["i"], r["rank"]): (r["j"], round(r["dist"], 3)) for r in P.knn_edges(df, ["g"], "id", "v", 3, mask="m").collect()}
    assert got == {(0, 1): (0, 0.001), (0, 2): (1, 1.0), (0, 3): (2, 1.0), (1, 1): (1, 0.001), (1, 2): (0, 1.0), (1, 3): (2, 1.0)}


def test_nearest_pair_ties_take_the_lowest_indices(spark):
    rows = [("e", "T", i, [float(i % 2), 0.0, 0.0]) for i in range(6)] + [("e", "C", i, [3.0 - i % 2, 0.0, 0.0]) for i in range(6)]
    df = spark.createDataFrame(rows, "entry string, chain string, pos int, xyz array<double>")
    targets = spark.createDataFrame([("e", "T")], "entry string, chain string")
    got = P.nearest_pairs(df, ["entry"], "chain", "pos", "xyz", targets, tile_rows=2).first()
    assert (got["distance"], got["target_index"], got["context_index"]) == (1.0, 1, 1)


def motion(points, angle=0.7, shift=(5.0, -3.0, 2.0)):
    c, s = math.cos(angle), math.sin(angle)
    return [(c * x - s * y + shift[0], s * x + c * y + shift[1], z + shift[2]) for x, y, z in points]


def test_rigid_motion_leaves_agreement_perfect(spark):
    native = [(3.8 * i, math.sin(i), math.cos(i)) for i in range(20)]
    rows = [("r", i, dict(zip("xyz", a)), dict(zip("xyz", b)), i < 18) for i, (a, b) in enumerate(zip(native, motion(native)))]
    point = "struct<x:double,y:double,z:double>"
    df = spark.createDataFrame(rows, f"record string, pos int, native {point}, model {point}, mask boolean")
    got = structure_metrics(df, ["record"], "pos", "native", "model", "mask").first()
    assert got["ca_lddt"] == 1.0 and got["ca_rmsd"] < 1e-4
    assert abs(got["tm_resolved"] - 1) < 1e-6 and abs(got["tm_full"] - 0.9) < 1e-6


def test_superposition_equals_singular_values(spark):
    """Random, flat, straight and single-point records against the textbook fit; fewer than three points have none."""
    rng = np.random.default_rng(5)
    records = {"any": rng.normal(size=(40, 3)) * 7, "flat": rng.normal(size=(20, 3)) * [5, 5, 0], "line": rng.normal(size=(12, 1)) * [[1.0, 2.0, -1.0]],
               "spot": np.ones((4, 3)), "pair": rng.normal(size=(2, 3)), "far": rng.normal(size=(30, 3)) + 1000, "mirror": rng.normal(size=(25, 3))}
    rows, expected = [], {}
    for name, a in records.items():
        turn = np.linalg.qr(rng.normal(size=(3, 3)))[0]
        turn *= np.sign(np.linalg.det(turn)) * (-1 if name == "mirror" else 1)
        b = a @ turn.T + rng.normal(size=3) + (rng.normal(size=a.shape) * 0.3 if name in ("any", "far") else 0)
        rows += [(name, k, dict(zip("xyz", p)), dict(zip("xyz", q)), True) for k, (p, q) in enumerate(zip(a.tolist(), b.tolist()))]
        x, y = a - a.mean(0), b - b.mean(0)
        u, s, vt = np.linalg.svd(y.T @ x)
        s[-1] *= np.sign(np.linalg.det(u @ vt)) if np.linalg.det(u @ vt) else 1
        expected[name] = np.sqrt(max((x ** 2).sum() + (y ** 2).sum() - 2 * s.sum(), 0) / len(a))
    point = "struct<x:double,y:double,z:double>"
    df = spark.createDataFrame(rows, f"record string, pos int, native {point}, model {point}, mask boolean")
    fits = {r["record"]: r for r in superpose(df, ["record"], "native", "model", F.col("mask")).collect()}
    assert set(fits) == set(records) - {"pair"}
    for name, fit in fits.items():
        r, a = np.array(fit["rotation"]), records[name]
        b = np.array([[q[3][c] for c in "xyz"] for q in rows if q[0] == name])
        assert np.allclose(r @ r.T, np.eye(3), atol=1e-9) and np.linalg.det(r) > 0
        moved = b @ r.T + np.array(fit["shift"])
        assert abs(fit["rmsd"] - expected[name]) < 1e-4 and abs(np.sqrt(((moved - a) ** 2).sum(1).mean()) - expected[name]) < 1e-4


def test_superposition_does_not_mirror(spark):
    rng = random.Random(1)
    native = [tuple(rng.gauss(0, 5) for _ in range(3)) for _ in range(30)]
    rows = [("r", i, dict(zip("xyz", a)), dict(zip("xyz", (-a[0], a[1], a[2]))), True) for i, a in enumerate(native)]
    point = "struct<x:double,y:double,z:double>"
    df = spark.createDataFrame(rows, f"record string, pos int, native {point}, model {point}, mask boolean")
    assert structure_metrics(df, ["record"], "pos", "native", "model", "mask").first()["ca_rmsd"] > 1.0


def pdb_line(kind, serial, atom, res, chain, number, x, ins=" "):
    return f"{kind:<6}{serial:>5} {atom:^4} {res:>3} {chain}{number:>4}{ins}   {x:8.3f}{0.0:8.3f}{1.0:8.3f}{1.0:6.2f}{50.0:6.2f}"


def test_pdb_text_reader(spark, tmp_path):
    lines = [pdb_line("ATOM", 1, "CA", "ALA", "A", 1, 1.0), pdb_line("ATOM", 2, "CA", "ALA", "A", 1, 9.0),
             pdb_line("HETATM", 3, "CA", "MSE", "A", 3, 3.0), pdb_line("ATOM", 4, "CA", "GLY", "A", 3, 4.0, "A"),
             pdb_line("HETATM", 5, "CA", "LIG", "A", 7, 3.0), pdb_line("ATOM", 6, "CA", "SER", "B", 5, 3.0)]
    (tmp_path / "x.pdb").write_text("HEADER\n" + "\n".join(lines) + "\nEND\n")
    structures, residues = X.read_pdb(spark, str(tmp_path / "x.pdb"), ca_only=True)
    row = structures.first()
    assert (row["name"], row["seq"], list(row["chains"]), row["num_of_chains"]) == ("x", "A-MGS", ["A", "B"], 2)
    assert residues.where("chain = 'A' and pos = 0").first()["ca"]["x"] == 1.0
    assert residues.where("chain = 'A' and pos = 1").first()["ca"] is None
    assert X.read_pdb(spark, str(tmp_path / "x.pdb"), chains=["B"], ca_only=True)[0].first()["seq"] == "S"


def test_prediction_contract(spark, tmp_path):
    body = "\n".join(pdb_line("ATOM", i, "CA", r, "A", i, float(i)) for i, r in enumerate(["ALA", "GLY", "SER"], 1))
    (tmp_path / "good.pdb").write_text("MODEL        1\n" + body + "\nENDMDL\nMODEL        2\n" + body + "\nENDMDL\n")
    (tmp_path / "bad.pdb").write_text(body + "\n")
    from strataloom.sources.lines import numbered_lines
    lines = numbered_lines(spark, str(tmp_path / "*.pdb"))
    expected = lines.select("file").distinct().withColumn("sequence", F.when(F.col("file").contains("good"), "AGS").otherwise("SGA"))
    points, status = X.prediction_ca(lines, expected)
    got = {r["file"].rsplit("/", 1)[1]: (r["status"], r["reason"]) for r in status.collect()}
    assert got == {"good.pdb": ("ok", None), "bad.pdb": ("failed", "sequence")}
    assert [r["pos"] for r in points.orderBy("pos").collect()] == [0, 1, 2]


def test_native_alpha_carbons(spark):
    p = lambda ok: {"x": 1.0, "y": 2.0, "z": 3.0} if ok else None
    rows = [("e", "A", i, p(i != 2), p(i != 3), p(True), p(True)) for i in range(5)]
    point = "struct<x:double,y:double,z:double>"
    residues = spark.createDataFrame(rows, f"entry string, chain string, pos int, n {point}, ca {point}, c {point}, o {point}")
    chains = spark.createDataFrame([("e", "A", "AAAAA"), ("e", "B", "A")], "entry string, chain string, sequence string")
    points, status = X.native_ca(residues, chains)
    got = {r["chain"]: r for r in status.collect()}
    assert points.count() == 4 and got["B"]["reason"] == "missing_chain"
    assert (got["A"]["native_ca_coverage"], got["A"]["native_complete_backbone_coverage"]) == (0.8, 0.6)


def test_assembly_expansion(spark):
    eye = np.eye(4).tolist()
    moved = [[0.0, -1.0, 0.0, 5.0], [1.0, 0.0, 0.0, 0.0], [0.0, 0.0, 1.0, 0.0], [0.0, 0.0, 0.0, 1.0]]
    asm = spark.createDataFrame([("e", "1", 0, "A,B", [eye, moved])], "entry string, asmb_id string, k int, asmb_chains string, xforms array<array<array<double>>>")
    chains = spark.createDataFrame([("e", "A"), ("e", "B"), ("f", "Z")], "entry string, chain string")
    wanted = spark.createDataFrame([("x1", "e", "A"), ("x2", "f", "Z")], "example string, entry string, chain string")
    copies = sampling.expand_assemblies(wanted, asm, chains, seed=1)
    assert copies.where("example = 'x1'").count() == 4 and copies.where("example = 'x2'").count() == 1
    res = spark.createDataFrame([("e", "A", 0, (1.0, 2.0, 3.0))], "entry string, chain string, pos int, ca struct<x:double,y:double,z:double>")
    xs = sorted(r["ca"]["x"] for r in sampling.transform_residues(res, copies, ("ca",)).collect())
    assert xs == [1.0, 3.0]
    assert sampling.chain_examples(copies, ["k", "chain", "copy"]).where("example = 'x1'").select("letter").distinct().count() == 4


def test_tiles_reach_python_a_few_at_once(spark, monkeypatch):
    pack, seen = P._pack, spark.sparkContext.accumulator(0)

    def counted(k, eps):
        def each(batches):
            for pdf in batches:
                seen.add(1)
                yield from pack(k, eps)([pdf])
        return each

    monkeypatch.setattr(P, "_pack", counted)
    monkeypatch.setattr(P, "BATCH_BYTES", "64k", raising=False)
    points = spark.range(40_000).select(F.lit(1).alias("g"), "id", F.array(F.col("id") * 1.0, F.lit(0.0), F.lit(0.0)).alias("v"))
    tiles = P.make_tiles(points, ["g"], "id", "v", tile_rows=256)
    assert tiles.agg(F.sum("n")).first()[0] == 40_000
    # 157 tiles of about 10 kB
    assert seen.value >= 20


def test_edge_features_and_frames(spark):
    rng = np.random.default_rng(2)
    ca = np.cumsum(rng.normal(size=(12, 3)) * 0.2 + [3.75, 0, 0], axis=0)
    s = lambda v: dict(zip("xyz", map(float, v)))
    rows = [("g", i, 1, True, s(c + [0, 1, 0]), s(c), s(c + [1, 0, 0]), s(c + [1, 1, 0])) for i, c in enumerate(ca)]
    point = "struct<x:double,y:double,z:double>"
    df = spark.createDataFrame(rows, f"g string, idx int, chain_no int, mask boolean, n {point}, ca {point}, c {point}, o {point}")
    edges = features.edge_features(df, ["g"], "idx", 4)
    row = edges.where("i = 3 and rank = 2").first()
    assert len(row["distances"]) == 25 and len(row["rbf"]) == 400
    assert abs(row["distances"][0] - np.linalg.norm(ca[3] - ca[row["j"]])) < 1e-3 and row["offset"] == 3 - row["j"] + 32
    frames = features.trace_frames(df, ["g"], "idx")
    flat = frames.where("idx = 0").first()
    assert list(flat["angles"]) == [0.0, 0.0, 0.0] and flat["ca_before"]["x"] == 0.0
    knn = edges.select("g", "i", "j", "rank", "dist")
    q = features.frame_edges(frames, knn, ["g"], "idx").where("i = 5").collect()
    assert all(abs(sum(x * x for x in r["rotation"]) - 1) < 1e-9 for r in q)
    own = next(r for r in q if r["j"] == 5)
    assert np.allclose(own["rotation"], [0, 0, 0, 1], atol=1e-6)
    assert len(features.trace_edge_distances(frames, knn, ["g"], "idx").first()["distances"]) == 9


def test_position_constraints_and_ties(spark):
    res = spark.createDataFrame([("s", c, p) for c in "AB" for p in (1, 2)], "name string, chain string, pos int")
    fixed = spark.createDataFrame([("s", "A", [2])], "name string, chain string, positions array<int>")
    omit = spark.createDataFrame([("s", "B", [1, 2], "CW")], "name string, chain string, positions array<int>, letters string")
    got = {(r["chain"], r["pos"]): r for r in features.position_constraints(res, fixed, omit).collect()}
    assert got[("A", 2)]["designable"] == 0 and got[("A", 1)]["designable"] == 1
    assert list(got[("B", 1)]["omitted"]) == ["C", "W"] and got[("A", 1)]["pssm_log_odds"][0] == 10000.0
    chains = spark.createDataFrame([("s", "A", 2, False), ("s", "B", 2, True)], "name string, chain string, length int, designed boolean")
    order = features.design_order(chains)
    starts = {r["chain"]: r["start"] for r in order.collect()}
    assert starts == {"B": 0, "A": 2}
    ties = spark.createDataFrame([("s", 0, "A", [1], None), ("s", 0, "B", [2], [0.5])], "name string, tie int, chain string, positions array<int>, weights array<double>")
    tied = features.tied_positions(ties, order).first()
    assert list(tied["positions"]) == [2, 1] and list(tied["weights"]) == [1.0, 0.5]


def test_payload_and_crop_audits(spark):
    point = "struct<x:double,y:double,z:double>"
    p = {"x": 0.0, "y": 0.0, "z": 0.0}
    rows = [("e", c, i, p, p, p, p, [1.0] * 4, [0.0] * 4) for c, n in (("A", 4), ("B", 3)) for i in range(n)]
    residues = spark.createDataFrame(rows, f"entry string, chain string, pos int, n {point}, ca {point}, c {point}, o {point}, occ array<double>, bfac array<double>")
    chains = spark.createDataFrame([("e", "A", "ACDE", 4, 4, 1.0), ("e", "B", "AC1", 3, 3, 0.5)], "entry string, chain string, seq string, length int, resolved int, coverage double")
    targets = spark.createDataFrame([("e", "A")], "entry string, chain string")
    edges = spark.createDataFrame([("e", "A", "A", 1.0), ("e", "A", "B", 1.5)], "entry string, chain_a string, chain_b string, identity double")
    report = {r["rule"]: r["failed"] for r in audit.payload_audit(chains, residues, targets, edges, min_length=1, max_length=10).collect()}
    assert report["alphabet"] == 1 and report["coverage"] == 1 and report["identity_range"] == 1
    assert report["resolved_count"] == 0 and report["target_choice"] == 0
    crops = spark.createDataFrame(
        [("e", "A", "full_target", 0, 0.0, 4, 4, 1.0, 0, 4, 4, 4, 1.0, None, None, 4), ("e", "B", "full_context", 1, 0.0, 3, 3, 1.0, 0, 3, 3, 3, 1.0, 0, 0, 4),
         ("e", "C", "context_window", 2, 0.5, 9, 9, 1.0, 3, 6, 3, 3, 1.0, 0, 7, 4)],
        "entry string, chain string, kind string, spatial_rank int, distance double, source_length int, source_resolved int, source_coverage double, start int, end int, "
        "length int, resolved int, coverage double, target_index int, source_index int, target_length int")
    totals = spark.createDataFrame([("e", 16, 3, 10, 3, 0)], "entry string, original_context_length int, original_context_chains int, retained_context_length int, retained_context_chains int, dropped_context_chains int")
    report = {r["rule"]: r["failed"] for r in audit.crop_audit(crops, totals, residues.select("entry", "chain", "pos", "ca"), targets, 12, 62).collect()}
    assert report["nearest_inside"] == 1 and report["distance_recomputed"] == 1 and report["rank_order"] == 0 and report["within_budget"] == 0


def test_sinks(spark, tmp_path):
    rows = spark.createDataFrame([("b", 2, "r1"), ("a", 1, "r2"), ("a", 3, "r3")], "k string, v int, id string")
    sinks.write_split_files(spark.createDataFrame([(3, "valid"), (1, "valid"), (2, "train")], "cluster int, split string"), str(tmp_path / "s"))
    assert [r["value"] for r in spark.read.text(str(tmp_path / "s/valid_clusters")).collect()] == ["1", "3"]
    plan = spark.createDataFrame([("r1", 0), ("r2", 1), ("r3", 1)], "id string, shard int")
    sinks.write_shards(rows, plan, "id", str(tmp_path / "sh"))
    assert spark.read.parquet(str(tmp_path / "sh")).where("shard = 1").count() == 2
    outcomes = spark.createDataFrame([("x", "ok", None), ("y", "skipped", "date")], "path string, status string, reason string")
    sinks.write_outcomes(outcomes, str(tmp_path / "o"))
    assert spark.read.parquet(str(tmp_path / "o")).where("status = 'skipped'").count() == 1
    line = sinks.report_rows(rows.withColumn("x", F.lit(None).cast("double")), {"id": "text", "x": "float"}, [F.col("v")], 1).first()["line"]
    assert line == "id=r2 x=NA"
    idx = sinks.record_index(spark.createDataFrame([("c1", "e", 5), ("c0", "e", 4)], "chain_id string, entry_id string, cluster int")).first()
    assert list(idx["chains"]) == ["c0", "c1"] and list(idx["clusters"]) == [4, 5]
    sinks.write_targets(rows.withColumnRenamed("id", "CHAINID"), str(tmp_path / "t"))
    sinks.write_index(rows, str(tmp_path / "i"), ["id"])
    sinks.write_fasta(rows, str(tmp_path / "f"), "id", "k", "v", "k")
    assert spark.read.text(str(tmp_path / "f")).count() == 6


def test_cif_lines_of_values_and_blank_lines():
    """Bare value lines, blank lines between names and a quoted value; loops that are not wanted are counted and checked."""
    from strataloom.sources import structure as T

    text = "data_x\nloop_\n_exptl.entry\n\n_exptl.method\nA 'X RAY' \n\nB EM\nloop_\n_atom_site.label_atom_id\nN\nCA\n\nO\n#\n_refine.ls_d_res_high\n2.5\n"
    rows = [(category, values and [v for v in values if v]) for _, category, _, values, _ in T._needed_rows("a.cif", text.encode(), set(T.HEADER))]
    assert rows == [("exptl", ["X RAY"]), ("exptl", ["EM"]), ("refine", ["2.5"]), ("parsed", ["3"])]
    assert [v for _, c, _, v, _ in T._needed_rows("a.cif", text.encode(), set(T.CATEGORIES)) if c == "atom_site"] == [[None, n] + [None] * 11 for n in ("N", "CA", "O")]
    with pytest.raises(ValueError):
        T._needed_rows("a.cif", b"loop_\n_atom_site.a\n_atom_site.b\n1\n", set(T.HEADER))


def test_small_files_leave_the_parser_together():
    import pyarrow as pa
    from strataloom.sources import structure as T

    files = pa.RecordBatch.from_pydict({"path": [f"{k}.cif" for k in range(500)], "content": [b"data_x\n_exptl.method EM\n"] * 499 + [b";open"]})
    out = list(T._parse_files(50_000, T.HEADER)([files]))
    assert [len(b) for b in out] == [2 * 499 + 1] and out[0].to_pylist()[-1]["category"] == "error"


def test_tile_searches_by_screening_are_exact():
    """Ties, copies, points far from the origin and points that are not finite: the answers of the whole distance matrix."""
    rng = np.random.default_rng(3)
    for shift, axes in ((0.0, 3), (1e6, 3), (0.0, 64), (1e200, 2), (np.nan, 2)):
        a, b = (np.round(rng.normal(size=(n, axes)), 1) + shift for n in (40, 60))
        b[7], ids = b[3], np.arange(60) * 3
        with np.errstate(all="ignore"):
            whole = P._distances(a, b, 1e-6)
            rows, dist, found = P._best_k(a, b, ids, 5, 1e-6)
            order = [sorted(range(60), key=lambda j: (whole[i, j], j))[:5] for i in range(40)]
            least = P._least(a, b)
        if not np.isnan(shift):
            assert rows.tolist() == [i for i in range(40) for _ in range(5)] and found.tolist() == [ids[j] for o in order for j in o]
            assert dist.tolist() == [whole[i, j] for i, o in enumerate(order) for j in o]
            plain = P._distances(a, b) if np.isfinite(whole).all() else whole
            assert least[1:] == divmod(int(np.argmin(plain)), 60) and least[0] == plain.min()


def test_tile_pairs_are_dealt_over_tasks(spark):
    """Many pairs of one group: a task has a share of them, and a contact that is mutual is looked at once."""
    close = spark.range(0, 60 * P.TASK_PAIRS).select(F.lit(1).alias("g"), F.col("id").alias("ta"), F.col("id").alias("tb"))
    pairs, tasks = P._spread(close)
    assert pairs.count() == 60 * P.TASK_PAIRS and tasks == 60
