"""The curation and benchmark dataflows end to end on generated files."""

from pyspark.sql import functions as F

from strataloom import cli
from strataloom.plans import curate as P, suite

THREE = dict(A="ALA", C="CYS", D="ASP", E="GLU", F="PHE", G="GLY")
SEQS = {"1aaa": ["ACDEFG", "ACDEFA"], "2aaa": ["ACDEFG"], "3aaa": ["GFEDCA", "GGGGGG", "AAAAAA"], "4aaa": ["CCDDEE"]}


def cif(seqs):
    chains = "ABC"[:len(seqs)]
    loop = lambda cat, items, rows: "loop_\n" + "".join(f"_{cat}.{i}\n" for i in items.split()) + "\n".join(rows) + "\n"
    poly = loop("entity_poly", "entity_id type", [f"{k + 1} 'polypeptide(L)'" for k in range(len(seqs))])
    seq = loop("entity_poly_seq", "entity_id num mon_id", [f"{k + 1} {i + 1} {THREE[a]}" for k, s in enumerate(seqs) for i, a in enumerate(s)])
    scheme = loop("pdbx_poly_seq_scheme", "asym_id entity_id seq_id mon_id", [f"{chains[k]} {k + 1} {i + 1} {THREE[a]}" for k, s in enumerate(seqs) for i, a in enumerate(s)])
    atoms = loop("atom_site", "group_PDB label_atom_id label_comp_id label_asym_id label_entity_id label_seq_id label_alt_id Cartn_x Cartn_y Cartn_z occupancy B_iso_or_equiv pdbx_PDB_model_num",
                 [f"ATOM {n} {THREE[a]} {chains[k]} {k + 1} {i + 1} . {3.8 * i} {10.0 * k} {j}.0 1.0 5.0 1" for k, s in enumerate(seqs) for i, a in enumerate(s) for j, n in enumerate(("N", "CA", "C", "O"))])
    return "data_X\n_exptl.method 'X-RAY DIFFRACTION'\n_refine.ls_d_res_high 2.0\n_pdbx_database_status.recvd_initial_deposition_date 2022-05-05\n" + poly + seq + scheme + atoms


def inputs(spark, folder):
    for name, seqs in SEQS.items():
        (folder / f"{name}-assembly1.cif").write_text(cif(seqs))
    (folder / "5aaa-assembly1.cif").write_text("data_X\nloop_\n_atom_site.a\n_atom_site.b\n1 2 3\n")
    meta = spark.createDataFrame([("4AAA", "2001-01-01", 2.0, "X-RAY DIFFRACTION")], "pdb_id string, date string, resolution double, method string").withColumn("date", F.col("date").cast("date"))
    clusters = spark.createDataFrame([("1AAA", "1", 5), ("2AAA", "1", 9)], "pdb_id string, entity_id string, cluster bigint")
    return meta, clusters


def test_curate_publish_validate(spark, tmp_path):
    raw = tmp_path / "raw"
    raw.mkdir()
    meta, clusters = inputs(spark, raw)
    cfg = P.CurateConfig(methods=("X-RAY",), first_date="2021-08-03", min_length=4, max_chains=2)
    release = P.curate(spark, str(raw), meta, clusters, cfg)
    outcome = {r["path"].rsplit("/", 1)[1][:4]: (r["status"], r["reason"]) for r in release.outcomes.collect()}
    assert outcome == {"1aaa": ("ok", None), "2aaa": ("ok", None), "3aaa": ("deferred", "too_many_chains"), "4aaa": ("skipped", "date"), "5aaa": ("failed", "mmcif_parse_error")}
    targets = {r["entry_id"]: r for r in release.targets.collect()}
    assert targets["1aaaa1"]["cluster"] == 5 and targets["2aaaa1"]["cluster"] == 5 and targets["1aaaa1"]["sequence"] == "ACDEFG"
    assert {(r["chain_b"]): r["identity"] for r in release.edges.where("entry = '1aaaa1'").collect()} == {"A": 1.0, "B": 0.0}
    out = str(tmp_path / "out")
    P.publish(release, out)
    report = P.validate(spark, out, cfg)
    assert report.where("failed > 0").count() == 0
    assert cli.read_dataset(spark, out).count() == 2 and cli.read_dataset(spark, out, "list").where("problem is null").count() == 2


def test_curate_with_crops(spark, tmp_path):
    meta, clusters = inputs(spark, tmp_path)
    cfg = P.CurateConfig(methods=("X-RAY",), first_date="2021-08-03", min_length=4, max_chains=2, max_context=12, crop=True, require_oversized=True, min_crop_length=3)
    release = P.curate(spark, str(tmp_path), meta, clusters, cfg)
    outcome = {r["path"].rsplit("/", 1)[1][:4]: r["reason"] for r in release.outcomes.collect()}
    assert outcome["3aaa"] is None and outcome["1aaa"] == "not_oversized"
    crops = {r["chain"]: (r["kind"], r["start"], r["end"]) for r in release.crops.collect()}
    assert crops == {"A": ("full_target", 0, 6), "B": ("full_context", 0, 6)}
    assert release.chains.where("entry = '3aaaa1'").count() == 2


def test_suite(spark, tmp_path):
    letters = "ACDEFGHIKLMNPQRSTVWY"
    rows = [(f"c{i}", i, "".join(letters[(i + k) % 20] for k in range(n))) for i, n in enumerate((60, 120, 250, 350, 450, 550, 650, 750))]
    targets = spark.createDataFrame(rows + [("t", 99, "ACDE" * 30), ("x", 3, "ACXD" * 20)], "chain_id string, cluster bigint, sequence string")
    splits = spark.createDataFrame([(i, "valid") for i in range(8)] + [(99, "test")], "cluster bigint, split string")
    made = suite.make_suite(targets, splits, 50, 800, 4, 4, 42)
    records = made["records"].collect()
    assert len({r["length_bin"] for r in records}) == 4 and 99 not in {r["cluster"] for r in records}
    funnel = made["funnel"].first().asDict()
    assert funnel == {"rows": 10, "valid_split_rows": 9, "length_eligible_rows": 9, "canonical_rows": 8, "unique_rows": 8}
    folder = str(tmp_path / "s")
    suite.publish_suite(made, folder)
    assert suite.verify_suite(spark, folder, 4, 50, 800).where("failed > 0").count() == 0
    a, b = (suite.suite_identity(made["records"], {"seed": s}) for s in (1, 2))
    assert a != b and a == suite.suite_identity(made["records"], {"seed": 1})
