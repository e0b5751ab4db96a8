"""Readers, splits, gates, contracts and expectations on small fixtures."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from strataloom.functions import canonical as J, text as X
from strataloom.operators import audit as A, clusters as C, contracts as K, expect as E, gates as G, ledger as D, metrics as M, sampling, select as S
from strataloom.sources import sinks, tables as T
from strataloom.sources.lines import numbered_lines


def one(spark, column):
    return spark.range(1).select(column).first()[0]


def test_lines_keep_their_numbers_across_splits(spark, tmp_path):
    (tmp_path / "a.txt").write_text("".join(f"line {i}\n" for i in range(1, 2001)))
    spark.conf.set("spark.sql.files.maxPartitionBytes", "2048")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    try:
        rows = numbered_lines(spark, str(tmp_path / "a.txt")).collect()
    finally:
        spark.conf.unset("spark.sql.files.maxPartitionBytes")
        spark.conf.unset("spark.sql.files.openCostInBytes")
    assert len(rows) == 2000 and all(r["value"] == f"line {r['line']}" for r in rows)


def test_fasta(spark, tmp_path):
    (tmp_path / "x.fa").write_text(">one first\nACD\nEFG\n>two\nAC-D\n")
    got = [(r["header"], r["sequence"]) for r in T.read_fasta(spark, str(tmp_path / "x.fa"), omit="-").orderBy("position").collect()]
    assert got == [("one first", "ACDEFG"), ("two", "ACD")]
    assert T.read_fasta(spark, str(tmp_path / "x.fa"), limit=1).count() == 1


def test_target_list(spark, tmp_path):
    (tmp_path / "list.csv").write_text(
        "CHAINID,DEPOSITION,RESOLUTION,HASH,CLUSTER,SEQUENCE\n1abca1_A,2022-01-01,2.00,000012,7,ACDE\n"
        "1abda1_B,2022-01-01,,000013,x,ACDE\n1abea1_B,2022-01-01,-1,000013,3,ACDE\n1abfa1_C,2022-01-01,,000013,3,\n")
    rows = {r["entry_id"]: r for r in T.typed_targets(T.read_targets(spark, str(tmp_path / "list.csv"))).collect()}
    assert rows["1abca1"]["problem"] is None and rows["1abca1"]["hash"] == "000012" and rows["1abca1"]["chain"] == "A"
    assert [rows[k]["problem"] for k in ("1abda1", "1abea1", "1abfa1")] == ["invalid_cluster", "invalid_resolution", "empty_sequence"]


def test_cluster_map_and_metadata(spark, tmp_path):
    (tmp_path / "c.txt").write_text("1ABC_1 2abc_2\n\n1ABC_1 AF_X_3\n")
    got = {(r["pdb_id"], r["entity_id"]): r["cluster"] for r in T.read_cluster_map(spark, str(tmp_path / "c.txt")).collect()}
    assert got == {("1ABC", "1"): 3, ("2ABC", "2"): 1, ("AF_X", "3"): 3}
    row = lambda i, d, r: "\t".join([i, "HEAD", d, "x", "x", "x", r, "X-RAY DIFFRACTION"])
    (tmp_path / "m.idx").write_text("IDCODE\tx\n------\n" + row("1abc", "07/04/76", "2.0") + "\n" + row("2abc", "01/05/22", "NOT") + "\nshort\tline\n")
    meta = {r["pdb_id"]: r for r in T.read_entry_metadata(spark, str(tmp_path / "m.idx")).collect()}
    assert str(meta["1ABC"]["date"]) == "1976-07-04" and str(meta["2ABC"]["date"]) == "2022-01-05" and meta["2ABC"]["resolution"] is None


def test_split_files_and_jsonl(spark, tmp_path):
    (tmp_path / "v.txt").write_text("3\n\n5\n3\nx\n-1\n")
    check = T.check_cluster_ids(T.read_cluster_ids(spark, str(tmp_path / "v.txt"))).first()
    assert (check["entries"], check["invalid"], check["negative"], check["duplicated"], check["ok"]) == (5, 1, 1, 1, False)
    (tmp_path / "x.jsonl").write_text('{"a": 1, "b": "x"}\n[1]\n{"a": oops}\n{"a": 2}\n')
    rows, bad = T.read_jsonl(spark, str(tmp_path / "x.jsonl"), "a bigint, b string")
    assert [r["a"] for r in rows.orderBy("line").collect()] == [1, 2] and sorted(r["line"] for r in bad.collect()) == [2, 3]


def test_strict_json(spark, tmp_path):
    for n, text in (("a", '{"a": 1, "a": 2}'), ("b", '{"a": NaN}'), ("c", "[1]"), ("d", '{"a": {"b": 1}}')):
        (tmp_path / f"{n}.json").write_text(text)
    got = {r["file"].rsplit("/", 1)[1][0]: r["problem"] for r in T.read_documents(spark, str(tmp_path / "*.json")).collect()}
    assert got["a"] == "duplicate key" and "NaN" in got["b"] and got["c"] and got["d"] is None


def test_constraints_last_line_or_merged(spark, tmp_path):
    (tmp_path / "f.jsonl").write_text('{"s1": {"A": [1]}, "s2": {"A": []}}\n{"s1": {"A": [2]}}\n')
    last = T.read_constraints(spark, str(tmp_path / "f.jsonl"), "map<string,array<int>>").collect()
    assert [(r["name"], r["value"]) for r in last] == [("s1", {"A": [2]})]
    assert T.read_constraints(spark, str(tmp_path / "f.jsonl"), "map<string,array<int>>", merge=True).count() == 2


def test_structures_deferred_evaluations_manifest(spark, tmp_path):
    rows = spark.createDataFrame([(1, "ACD-"), (2, "AC1"), (3, "A" * 200), (4, "AC")], "line int, seq string")
    kept, counters = T.filter_structures(rows, "line", truncate=1)
    assert [r["line"] for r in kept.collect()] == [1] and counters.first().asDict() == {"read": 4, "bad_chars": 1, "too_long": 1, "accepted": 2}
    deferred = spark.createDataFrame([("p1", "too_many_chains"), ("p1", "context_too_long"), ("p2", "context_too_long"), ("p3", "date")], "path string, reason string")
    rows, report = T.read_deferred(deferred, spark.createDataFrame([("p1",)], "path string"))
    got = {r["check"]: r["n"] for r in report.collect()}
    assert rows.count() == 3 and got == {"reason:too_many_chains": 1, "reason:context_too_long": 2, "duplicate_path": 1, "missing_file": 1}
    (tmp_path / "crops--base.json").write_text('{"nll": 1.5}')
    ev = T.read_evaluations(spark, str(tmp_path / "*.json"), "nll double").first()
    assert (ev["dataset"], ev["label"], ev["nll"]) == ("crops", "base", 1.5)
    man = T.manifest_from_ids(spark.createDataFrame([("1ABC",), ("2xyz",)], "pdb_id string"), "https://example.org/", limit=1).first()
    assert man["relpath"] == "ab/1abc-assembly1.cif.gz" and man["url"] == "https://example.org/ab/1abc-assembly1.cif.gz"
    payload = spark.createDataFrame([("e1", "e1_A", 1), ("e2", "e2_B", 2)], "entry_id string, chain_id string, v int")
    assert T.chain_lookup(payload, spark.createDataFrame([("e2_B",)], "chain_id string")).first()["v"] == 2


def test_text_functions(spark):
    assert one(spark, X.stable_hash(F.lit("ACDE"), 1000)) == int(hashlib.sha1(b"ACDE").hexdigest()[:12], 16) % 1000
    assert one(spark, X.rank_hash(42, F.lit("c"), F.lit("h"))) == hashlib.sha256(b"42\0c\0h").hexdigest()
    assert one(spark, X.trimmed(F.lit("ACDEFGHIKLMNPQRS" + "H" * 7))) == "ACDEFGHIKLMNPQRS"[:-6]
    assert one(spark, X.translate(F.lit("GCTTGTGATGAA"))) == "ACDE"
    assert one(spark, X.translate(F.lit("GCTTAA"))) == "A" and one(spark, X.translate(F.lit("TAAGCT"))) is None
    assert one(spark, X.translate(F.lit("GCTNNN"))) == "AX" and one(spark, X.translate(F.lit("GCTA"))) is None
    assert one(spark, X.size_bytes(F.lit("1.5g"))) == 3 << 29 and one(spark, X.size_bytes(F.lit("huge"))) is None
    assert one(spark, X.sequence_number(F.lit("12.0"))) == 12 and one(spark, X.sequence_number(F.lit("nan"))) is None
    assert one(spark, X.window_start(F.lit(80), F.lit(50), F.lit(40))) == 15
    assert one(spark, X.is_identifier(F.lit("ok-1.a"))) and not one(spark, X.is_identifier(F.lit("No")))
    assert one(spark, X.residue_name(F.lit("A"))) == "ALA" and one(spark, X.residue_letter(F.lit("mse"))) == "M"
    assert one(spark, X.utc_timestamp(F.lit("2024-01-01T00:00:00Z"))) is not None and one(spark, X.utc_timestamp(F.lit("2024-01-01"))) is None
    assert one(spark, X.wrap(F.lit("A" * 85))) == "A" * 80 + "\n" + "A" * 5


def test_canonical_identity(spark):
    doc = {"b": 1e-05, "a": "é", "work_id": "x", "created_at_utc": "t"}
    want = hashlib.sha256(json.dumps({"a": "é", "b": 1e-05}, sort_keys=True, separators=(",", ":")).encode()).hexdigest()
    assert one(spark, J.document_identity(F.lit(json.dumps(doc)), J.WORK_DROPPED)) == want
    assert one(spark, J.work_id(F.lit(json.dumps(doc)), F.lit("fold"))) == "fold-" + want[:24]


def rows(spark, values):
    return spark.createDataFrame(values, "id string, cluster bigint, seq string")


def test_inheritance_keeps_reference_splits(spark):
    ref = spark.createDataFrame([("r1", 10, "AAAA", "train"), ("r2", 20, "BBBB", "valid"), ("r3", 30, "CCCC", "test")], "id string, cluster bigint, seq string, split string")
    out = C.inherit_splits(rows(spark, [("a", 99, "BBBB"), ("b", 40, "DDDD"), ("c", 30, "EEEE")]), ref, "id", "seq", "cluster")
    assert {r["id"]: (r["cluster"], r["split"]) for r in out["kept"].collect()} == {"a": (20, "valid"), "b": (40, "train"), "c": (30, "test")}
    stats = out["stats"].first()
    assert stats["content_leaks"] == 0 and stats["rows_quarantined"] == 0


def test_inheritance_quarantines_conflicts(spark):
    ref = spark.createDataFrame([("r1", 10, "AAAA", "train"), ("r2", 20, "BBBB", "valid")], "id string, cluster bigint, seq string, split string")
    out = C.inherit_splits(rows(spark, [("a", 10, "BBBB"), ("b", 10, "CCCC"), ("c", 30, "DDDD")]), ref, "id", "seq", "cluster")
    assert [r["id"] for r in out["kept"].collect()] == ["c"]
    assert {r["id"]: list(r["reference_splits"]) for r in out["quarantined"].collect()} == {"a": ["train", "valid"], "b": ["train", "valid"]}
    bad = spark.createDataFrame([("r1", 10, "AAAA", "train"), ("r2", 10, "BBBB", "valid")], "id string, cluster bigint, seq string, split string")
    with pytest.raises(ValueError):
        C.inherit_splits(rows(spark, [("c", 30, "DDDD")]), bad, "id", "seq", "cluster")


def test_index_rewrite(spark):
    chains = spark.createDataFrame([("1abca1_A", "1abca1", 10), ("2abca1_A", "2abca1", 20)], "chain_id string, entry_id string, cluster bigint")
    records = spark.createDataFrame([("1abca1", ["1abca1_A"], [10]), ("2abca1", ["2abca1_A"], [20])], "entry_id string, chains array<string>, clusters array<bigint>")
    kept = spark.createDataFrame([("2abca1_A", 30)], "chain_id string, cluster bigint")
    c, r = C.rewrite_index(chains, records, kept)
    assert [(x["chain_id"], x["cluster"]) for x in c.collect()] == [("2abca1_A", 30)]
    assert [(x["entry_id"], list(x["clusters"])) for x in r.collect()] == [("2abca1", [30])]


def test_splits_and_evaluation_order(spark):
    df = spark.createDataFrame([(i,) for i in range(200)], "c bigint")
    got = {r["split"]: r["n"] for r in C.assign_splits(df, "c", 0.01, 0.05, 1).groupBy("split").agg(F.count("*").alias("n")).collect()}
    assert got == {"valid": 2, "test": 10, "train": 188}
    assert {r["split"] for r in C.assign_splits(df.where("c < 2"), "c", 0.5, 0.5, 1).collect()} == {"train"}
    recs = spark.createDataFrame([(20, "2bbb_B"), (20, "2aaa_A"), (10, "1ccc_C")], "cluster int, id string")
    assert [r["id"] for r in S.evaluation_order(recs, "cluster", ["id"]).orderBy("position").collect()] == ["1ccc_C", "2aaa_A", "2bbb_B"]
    grouped = sampling.group_by_cluster(recs.withColumn("split", F.lit("test")), "split", "cluster", ["id"], debug=True)
    assert {r["split"] for r in grouped.collect()} == {"train", "valid"}


def test_pilot_roles(spark):
    rows = [("low-lddt", 0.2, 0.9, 1.0, 100), ("low-tm", 0.8, 0.1, 0.99, 120), ("gappy", 0.7, 0.05, 0.5, 90), ("longest", 0.9, 0.9, 1.0, 700), ("best", 0.99, 0.9, 1.0, 50)]
    df = spark.createDataFrame(rows, "record_id string, lddt double, tm double, coverage double, length int")
    picks = S.role_picks(df, "record_id", [("a", [F.col("lddt")], None), ("b", [F.col("tm")], F.col("coverage") >= 0.95), ("c", [-F.col("length")], None), ("d", [-F.col("lddt")], None)])
    assert [r["record_id"] for r in picks.orderBy("role_order").collect()] == ["low-lddt", "low-tm", "longest", "best"]
    with pytest.raises(ValueError):
        S.role_picks(df.where("coverage < 0.9"), "record_id", [("b", [F.col("tm")], F.col("coverage") >= 0.95)])


def test_gates(spark):
    ev = [("crops", "base", 1.77), ("v1", "base", 1.54), ("crops", "good", 1.75), ("v1", "good", 1.539), ("crops", "worse", 1.70), ("v1", "worse", 1.542)]
    df = spark.createDataFrame(ev, "dataset string, label string, nll double")
    gated = G.gate(df, "base", "crops", "v1", 0.001)
    assert {r["label"]: r["passed"] for r in gated.collect()} == {"good": True, "worse": False}
    assert G.select_candidate(gated, "crops").first()["label"] == "good"
    cols = "main_records int, guard_records int, summary_sha256 string, checkpoint_sha256 string, main_baseline_nll double, main_selected_nll double, main_recorded_delta double, guard_baseline_nll double, guard_selected_nll double, guard_recorded_delta double"
    row = (19, 426, "h", "h", 1.5, 1.25, -0.25, 1.5, 1.5, 0.0)
    rules = G.promotion_rules({"main_records": 19, "guard_records": 426} and {"main": 19, "guard": 426})
    ok = E.expect(spark.createDataFrame([row], cols), rules)
    assert ok.where("failed > 0").count() == 0
    bad = E.expect(spark.createDataFrame([row[:4] + (1.5, 1.51, 0.01, 1.5, 1.502, 0.002)], cols), rules)
    assert {r["rule"] for r in bad.where("failed > 0").collect()} >= {"main_improves", "guard_holds"}
    with pytest.raises(E.ExpectationFailed):
        E.enforce(bad)


def test_fingerprint_of_short_and_long_lists(spark):
    ids = [f"id{i}" for i in range(50)]
    df = spark.createDataFrame([("short", i, v) for i, v in enumerate(ids[:4])] + [("long", i, v) for i, v in enumerate(ids)], "g string, o int, id string")
    got = {r["g"]: (r["n_ids"], r["ids_sha256"]) for r in M.fingerprint(df, ["g"], ["o"], "id").collect()}
    sha = lambda parts: hashlib.sha256("\n".join(parts).encode()).hexdigest()
    assert got == {"short": (4, sha(ids[:4])), "long": (50, sha(ids))}


def test_callable_metric_records_failures(spark):
    df = spark.createDataFrame([("a", 1.0), ("a", 3.0), ("b", 0.0)], "r string, v double")
    got = {r["r"]: r for r in M.evaluate_records(df, "r", lambda p: {"m": float(1 / (p["v"].min() or [][0]))}, "m double").collect()}
    assert got["a"]["status"] == "succeeded" and got["b"]["status"] == "failed" and got["b"]["m"] is None


def target(spark, regions, linkers, orders=(["d1", "d2"],), direct=False):
    domains = spark.createDataFrame([("t", "d1", "A" * 20), ("t", "d2", "C" * 20)], "doc_id string, domain_id string, sequence string")
    reg = spark.createDataFrame([("t", f"r{i}", *r) for i, r in enumerate(regions)], "doc_id string, region_id string, domain_id string, owner_id string, start int, end int, kind string")
    ords = spark.createDataFrame([("t", i, list(o)) for i, o in enumerate(orders)], "doc_id string, order_id int, domain_order array<string>")
    lin = spark.createDataFrame([("t", *x) for x in linkers], "doc_id string, linker_id string, left string, right string, min_length int, max_length int, allowed_sequences array<string>")
    dire = spark.createDataFrame([("t", direct, 100)], "doc_id string, allow_direct boolean, maximum_total_length int")
    return {(r["subject"], r["problem"]) for r in K.target_problems(domains, reg, ords, lin, dire).collect()}


def test_target_rules(spark):
    good = [("d1", "d1", 1, 5, "immutable"), ("d1", None, 6, 10, "mutable")]
    assert target(spark, good, [("l1", "d1", "d2", 2, 4, ["GGG"])]) == set()
    assert target(spark, [("d1", "d1", 1, 6, "immutable"), ("d1", None, 6, 10, "mutable")], [("l1", "d1", "d2", 2, 4, None)]) == {("r1", "mutable_overlaps_protected")}
    assert target(spark, good, []) == {("d1-d2", "uncovered_pair")}
    assert target(spark, [("d1", "d1", 9, 30, "fixed")], [("l1", "d1", "d2", 5, 4, None), ("l2", "d2", "d1", 1, 2, ["GGGG"])]) == {
        ("r0", "past_end"), ("l1", "min_above_max"), ("l2", "never_adjacent"), ("l2", "sequence_length")}
    assert ("0", "not_a_permutation") in target(spark, good, [], orders=(["d1"],), direct=True)
    assert ("0", "minimum_above_maximum") in target(spark, good, [("l1", "d1", "d2", 80, 90, None)])


def test_candidate_and_result_rules(spark):
    sha = hashlib.sha256(b"ACDE").hexdigest()
    schema = ("protein_sequence string, cds_sequence string, translation_check string, translated_protein_sha256 string, check_translation string, "
              "check_immutable string, check_length string, check_safety string, decision string, scores map<string,double>")
    good = ("ACDE", "GCTTGTGATGAA", "passed", sha, "passed", "passed", "passed", "passed", "retained", {"a": 1.0})
    failed = lambda row: {r["rule"] for r in E.expect(spark.createDataFrame([row], schema), K.candidate_rules()).where("failed > 0").collect()}
    assert failed(good) == set()
    assert failed(("ACDF", *good[1:])) == {"translation_equal", "protein_hash"}
    assert failed((*good[:9], {"a": float("nan")})) == {"finite_scores"}
    assert failed(("ACDE", None, None, None, "passed", *good[5:])) == {"not_run_without_transcript"}
    art = spark.createDataFrame([("w", 1, "work/w/attempt-1/a", 3, "h"), ("w", 1, "work/w/attempt-2/a", 3, "h"), ("w", 1, "../x", 3, "h"), ("w", 1, "artifacts/b", 4, "h")],
                                "work_id string, attempt int, path string, bytes int, sha256 string")
    files = spark.createDataFrame([("work/w/attempt-1/a", 3, "h"), ("artifacts/b", 3, "h")], "path string, bytes int, sha256 string")
    assert [r["problem"] for r in K.artifact_problems(art, files).orderBy("path").collect()] == ["not_relative", "bytes", None, "other_attempt"]


def test_schema_rules_and_open_documents(spark):
    schema = {"required": ["id", "status"], "additionalProperties": False, "properties": {
        "id": {"type": "string", "pattern": "^[a-z]+$"}, "status": {"enum": ["ok", "failed"]}, "n": {"type": "integer", "minimum": 1},
        "tags": {"type": "array", "uniqueItems": True}, "error": {"type": "object", "required": ["type"]}},
        "allOf": [{"if": {"properties": {"status": {"enum": ["failed"]}}}, "then": {"required": ["error"]}}]}
    docs = ['{"id": "a", "status": "ok", "n": 2, "tags": ["x"]}', '{"id": "A", "status": "failed", "n": 0, "tags": ["x", "x"], "z": 1}', '{"status": "no", "n": 1.5, "error": {}}']
    df = spark.createDataFrame([(i, d) for i, d in enumerate(docs)], "i int, doc string")
    broken = {r["rule"]: r["failed"] for r in K.schema_report(df, "doc", schema, "i").where("failed > 0").collect()}
    assert broken == {"$.id:required": 1, "$:extra": 1, "$.id:pattern": 1, "$.status:enum": 1, "$.n:type": 1, "$.n:minimum": 1, "$.tags:uniqueItems": 1,
                      "$.error.type:required": 1, "$.error:conditional": 1}
    assert K.unknown_fields(df, "doc", ["id", "status"]).where("i = 1").first()["extra"]["z"] == "1"


def test_suite_job_and_source_audits(spark):
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    recs = [("record-0001", "c1", 1, "ACD", sha("ACD"), 3, "a"), ("record-0002", "c2", 1, "ACDEF", sha("bad"), 5, "b")]
    df = spark.createDataFrame(recs, "record_id string, chain_id string, cluster int, sequence string, sequence_sha256 string, length int, length_bin string")
    bins = spark.createDataFrame([("a", 1, 4, 1, 1), ("b", 5, 8, 1, 2)], "label string, min_length int, max_length int, eligible int, selected int")
    broken = {r["rule"] for r in A.suite_audit(df, bins, 2, 1, 8).where("failed > 0").collect()}
    assert broken == {"sequence_sha256", "unique_cluster", "bin_count", "bin_eligible"}
    jobs = spark.createDataFrame([(0, "r1", "k1", "ACD", 3, sha("ACD"), "m", "1", "x"), (1, "r2", "k2", "AC1", 3, sha("AC1"), "m", "2", None)],
                                 "position int, record_id string, record_key string, sequence string, length int, sequence_sha256 string, model_id string, model_revision string, lineage string")
    sel = spark.createDataFrame([(0, "k2", sha("AC1")), (1, "k1", sha("ACD"))], "position int, record_key string, sequence_sha256 string")
    broken = {r["rule"]: r["failed"] for r in K.job_audit(jobs, sel, "m", "1").where("failed > 0").collect()}
    assert broken == {"model": 1, "lineage": 1, "alphabet": 1, "selection_position": 2}
    man = spark.createDataFrame([("f", "ok", 0, 0, 5, 5)], "format string, validation_status string, content_leaks int, entry_leaks int, records int, validated int")
    files = spark.createDataFrame([("a", "1"), ("b", "2")], "name string, sha256 string")
    assert A.source_gate(man, files, files.where("name = 'a'"), "f").where("failed > 0").count() == 0
    assert A.source_gate(man, files, spark.createDataFrame([("a", "9")], "name string, sha256 string"), "f").where("failed > 0").count() == 1
    gen = spark.createDataFrame([("ACDE", 4, 3, 1, 1, 2 / 3, 0.5), ("ACDE", 4, 3, 1, 4, 0.5, 0.5)], "sequence string, length int, designable int, fixed int, mutations int, recovery double, score double")
    assert {r["rule"]: r["failed"] for r in E.expect(gen, A.generated_rules()).where("failed > 0").collect()} == {"mutations_range": 1, "recovery": 1}


def test_result_validity_completeness_and_companion(spark):
    cols = "id string, evaluation_identity string, result_identity string, derived_identity string, sequence_sha256 string, expected_sequence_sha256 string, status string, m double"
    res = spark.createDataFrame([("a", "e", "r", "r", "s", "s", "succeeded", 1.0), ("b", "e", "r", "x", "s", "s", "succeeded", 1.0),
                                 ("c", "e", "r", "r", "s", "s", "succeeded", float("nan")), ("d", "e", "r", "r", "s", "s", "failed", None)], cols)
    work = spark.createDataFrame([(x,) for x in "abcd"], "id string")
    valid = A.result_valid("e", ["m"])
    assert sorted(r["id"] for r in A.pending(work, res, ["id"], valid=valid).collect()) == ["b", "c"]
    assert sorted(r["id"] for r in A.pending(work, res, ["id"], True, valid).collect()) == ["b", "c", "d"]
    report = {r["rule"]: r["failed"] for r in A.completeness(work, res.where("id in ('a', 'd')"), "id").collect()}
    assert report == {"missing_result": 3, "unexpected_result": 0, "duplicate_result": 0}
    recs = sinks.fasta_lines(spark.createDataFrame([("r1", "c", 1, "ACD")], "r string, c string, k int, s string"), "r", "c", "k", "s")
    lines = recs.select(F.posexplode(F.split("value", "\n")).alias("p", "value")).select((F.col("p") + 1).alias("line"), "value")
    assert A.fasta_matches(recs, lines, "r").count() == 0
    assert A.fasta_matches(recs, lines.withColumn("value", F.replace("value", F.lit("ACD"), F.lit("ACE"))), "r").count() == 1


def test_ledger_batch(spark):
    schema = "work_id string, kind string, worker_id string, at double, seq bigint, lease_seconds double, status string"
    rows = [("w", "claim", "a", 0.0, 1, 10.0, None), ("w", "claim", "b", 5.0, 2, 10.0, None),      # a live lease: nothing
            ("w", "renew", "b", 6.0, 3, 99.0, None), ("w", "renew", "a", 8.0, 4, 4.0, None),       # only the holder renews
            ("w", "claim", "b", 12.0, 5, 10.0, None),                                             # the lease has passed at 12
            ("w", "finish", "a", 13.0, 6, None, "succeeded"), ("w", "finish", "b", 14.0, 7, None, "retryable"),
            ("w", "claim", "c", 15.0, 8, 10.0, None),                                             # both attempts are used up
            ("v", "claim", "a", 1.0, 9, 10.0, None), ("v", "finish", "a", 2.0, 10, None, "succeeded"), ("v", "claim", "a", 3.0, 11, 10.0, None),
            ("u", "claim", "a", 1.0, 12, 0.0, None), ("x", "claim", "a", 1.0, 13, 10.0, None), (None, "claim", "a", 1.0, 14, 10.0, None)]
    events = spark.createDataFrame(rows, schema)
    items = spark.createDataFrame([("w", 2), ("v", 3), ("u", 1), ("t", 1)], "work_id string, max_attempts int")
    changes = D.ledger_changes(events, items)
    told = [(r["attempt"], r["at"], r["change"], r["state"]) for r in changes.where("work_id = 'w'").orderBy("attempt", "at", "seq").collect()]
    assert told == [(1, 0.0, "claimed", "running"), (1, 8.0, "renewed", "running"), (1, 12.0, "lease_expired", "pending"),
                    (2, 12.0, "claimed", "running"), (2, 14.0, "retryable", "failed")]
    table = {(r["work_id"], r["attempt"]): (r["worker_id"], r["lease_expires_at"], r["finished_at"], r["status"]) for r in D.attempt_table(changes).collect()}
    assert table == {("w", 1): ("a", 12.0, 12.0, "lease_expired"), ("w", 2): ("b", 22.0, 14.0, "retryable"), ("v", 1): ("a", 11.0, 2.0, "succeeded"), ("u", 1): ("a", 1.0, None, "running")}
    states = lambda now: {r["work_id"]: (r["state"], r["attempts"]) for r in D.item_states(D.ledger_changes(events, items, now), items).collect()}
    assert states(None) == {"w": ("failed", 2), "v": ("completed", 1), "u": ("running", 1), "t": ("pending", 0)}
    assert states(1.0)["u"] == ("failed", 1)
    late = D.item_states(D.ledger_changes(events, items, 40.0), items)
    assert {r["state"]: r["items"] for r in D.ledger_status(late).collect()} == {"pending": 1, "running": 0, "completed": 1, "failed": 2}
    assert D.ledger_changes(events.limit(0), items.limit(0), 1.0).count() == 0
    # what a claim at 1.0 would take: a lease that has passed counts, an item without attempts left does not
    made = D.item_states(D.ledger_changes(events.where("at < 1 or work_id = 'u'"), items), items).withColumns({"priority": F.lit(1), "created_at": F.lit(0)})
    assert [r["work_id"] for r in S.next_work_item(made, 10.0).collect()] == ["t"]
    assert [r["work_id"] for r in S.next_work_item(made.where("work_id <> 't'"), 10.0).collect()] == ["v"]
    assert [r["work_id"] for r in S.next_work_item(made.where("work_id = 'w'"), 9.0).collect()] == []
    assert [r["work_id"] for r in S.next_work_item(made.where("work_id = 'w'"), 10.0).collect()] == ["w"]
