"""Readers of structure files: listings, mmCIF, PDB text, predicted and native coordinates."""

from __future__ import annotations

import gzip
import re
from collections.abc import Collection, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window as W, functions as F

from ..functions import text as X
from ..functions.vector import finite, vec
from .lines import numbered_lines

#: File name pattern of an assembly file.
FILE_NAME = r"(?:^|/)([0-9A-Za-z]{4})-assembly([^./]+)\.cif(?:\.gz)?$"
BACKBONE = ("N", "CA", "C", "O")
#: The columns read from each file category, in table order.
CATEGORIES = {
    "atom_site": (
        "group_PDB", "label_atom_id", "label_comp_id", "label_asym_id", "label_entity_id", "label_seq_id",
        "label_alt_id", "Cartn_x", "Cartn_y", "Cartn_z", "occupancy", "B_iso_or_equiv", "pdbx_PDB_model_num",
    ),
    "entity_poly": ("entity_id", "type"),
    "entity_poly_seq": ("entity_id", "num", "mon_id"),
    "pdbx_poly_seq_scheme": ("asym_id", "entity_id", "seq_id", "mon_id"),
    "exptl": ("method",),
    "pdbx_database_status": ("recvd_initial_deposition_date",),
    "database_PDB_rev": ("date_original", "date"),
    "refine": ("ls_d_res_high",),
    "em_3d_reconstruction": ("resolution",),
    "reflns": ("d_resolution_high",),
}


def list_files(spark: SparkSession, root: str, pattern: str = "*.cif*") -> DataFrame:
    """(path, length, modified) of the files below ``root``; file contents are not read."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", pattern)
        .load(root).select("path", "length", F.col("modificationTime").alias("modified")))


def with_file_ids(files: DataFrame, path: str = "path") -> DataFrame:
    """Adds pdb_id, assembly_id and entry_id; all NULL where the name does not fit."""
    named = F.col(path).rlike(FILE_NAME)
    pdb = F.when(named, F.lower(F.regexp_extract(path, FILE_NAME, 1)))
    assembly = F.when(named, F.lower(F.regexp_replace(F.regexp_extract(path, FILE_NAME, 2), "[^A-Za-z0-9]", "")))
    return files.withColumn("pdb_id", pdb).withColumn("assembly_id", assembly).withColumn(
        "entry_id", F.concat("pdb_id", F.lit("a"), "assembly_id"))


def discover_assemblies(
    files: DataFrame, assembly_id: str = "all", policy: str = "all", limit: int = 0, path: str = "path",
) -> DataFrame:
    """Files to read, ``.cif.gz`` before ``.cif``, by path.

    ``assembly_id`` keeps one assembly; policy ``first`` keeps the lowest assembly per entry in
    natural order; a positive ``limit`` keeps that many.
    """
    from ..operators.select import least_row

    named = with_file_ids(files, path)
    name = F.element_at(F.split(path, "/"), -1)
    if assembly_id != "all":
        named = named.where(name.rlike(rf"-assembly{re.escape(assembly_id)}\.cif(\.gz)?$"))
    elif policy == "first":
        # one file per entry has no order of kinds left: entries come by id
        named = least_row(named.where("pdb_id is not null"), ["pdb_id"], [X.natural_key(F.col("assembly_id")), name])
        return named.orderBy("pdb_id").limit(limit) if limit > 0 else named
    elif policy != "all":
        raise ValueError(f"unsupported assembly policy: {policy}")
    if limit > 0:
        return named.orderBy(F.when(F.col(path).endswith(".gz"), 0).otherwise(1), path).limit(limit)
    return named


def size_bounded(files: DataFrame, max_bytes: int) -> tuple[DataFrame, DataFrame]:
    """(kept, skipped outcome rows); 0 turns the bound off. Works on the listing alone."""
    if max_bytes <= 0:
        return files, files.where(F.lit(False)).select("path", F.lit("skipped").alias("status"), F.lit("raw_file_size").alias("reason"))
    over = files.where(F.col("length") > max_bytes)
    return files.where(F.col("length") <= max_bytes), over.select(
        "path", F.lit("skipped").alias("status"), F.lit("raw_file_size").alias("reason"))


# ---------------------------------------------------------------- mmCIF

_TOKEN = re.compile(r"""'(.*?)'(?=\s|$)|"(.*?)"(?=\s|$)|(\#.*)|(\S+)""")


def _cif_runs(text: str):
    """(run of tokens, whether they are bare values) by line of a CIF text, tokens other than bare values as (token, quoted).

    A line without quotes, comments and underscores holds values only. Text blocks between semicolons are one token.
    """
    block = None
    for line in text.splitlines():
        if block is not None:
            if line.startswith(";"):
                yield [("\n".join(block), True)], False
                block = None
            else:
                block.append(line)
        elif line.startswith(";"):
            block = [line[1:]]
        elif "_" not in line and "'" not in line and '"' not in line and "#" not in line:
            yield line.split(), True
        else:
            run = []
            for single, double, comment, bare in _TOKEN.findall(line):
                if comment:
                    break
                run.append((bare, False) if bare else (single or double, True))
            yield run, False
    if block is not None:
        raise ValueError("unterminated text block")


def _cif_rows(text: str, wanted: Collection[str]):
    """(category, row number, {item: value}) of every single item group and loop row; of a loop that is not
    wanted (category, number of its rows, None)."""
    singles: dict[str, dict] = {}
    names: list[str] = []
    values: list[str] = []
    mode, pending = "items", None

    def rows():
        category = names[0][1:].split(".")[0]
        if len(values) % len(names):
            raise ValueError(f"loop of {category} is cut short")
        if category not in wanted:
            yield category, len(values) // len(names), None
            return
        items = [n.split(".", 1)[-1] for n in names]
        for at in range(0, len(values), len(names)):
            yield category, at // len(names), dict(zip(items, values[at:at + len(names)]))

    for run, bare in _cif_runs(text):
        if bare and run and mode != "items":
            mode = "values"
            values += run
            continue
        for token, quoted in (((token, False) for token in run) if bare else run):
            word = "" if quoted else token.lower()
            if word == "loop_" or word.startswith("data_"):
                if names and values:
                    yield from rows()
                names, values, pending = [], [], None
                mode = "names" if word == "loop_" else "items"
            elif not quoted and token.startswith("_"):
                if mode == "values":
                    yield from rows()
                    names, values, mode = [], [], "items"
                if mode == "names":
                    names.append(token)
                else:
                    pending = token
            elif mode in ("names", "values"):
                mode = "values"
                values.append(token)
            elif pending:
                category, item = (pending[1:].split(".", 1) + [""])[:2]
                singles.setdefault(category, {})[item] = token
                pending = None
    if names and values:
        yield from rows()
    for category, row in singles.items():
        yield category, 0, row


def _needed_rows(path: str, content: bytes, wanted: Collection[str]) -> list[tuple]:
    """All needed rows of a file, and one ``parsed`` row that holds the number of its atom rows."""
    raw = gzip.decompress(content) if path.endswith(".gz") else bytes(content)
    out, atoms = [], 0
    for category, row, items in _cif_rows(raw.decode("utf-8", errors="replace"), wanted):
        if category == "atom_site":
            atoms += row if items is None else 1
        if items is None or category not in wanted:
            continue
        values = [items.get(c) for c in CATEGORIES[category]]
        if category == "atom_site" and (values[1] or "").strip().upper() not in BACKBONE:
            continue
        out.append((path, category, row, values, None))
    return [*out, (path, "parsed", 0, [str(atoms)], None)]


_PARSED = pa.schema([("path", pa.string()), ("category", pa.string()), ("row", pa.int64()), ("values", pa.list_(pa.string())), ("error", pa.string())])


def _parse_files(chunk: int, wanted: Collection[str]):
    def batch(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), _PARSED)], schema=_PARSED)

    def parse(batches):
        out = []
        for files in batches:
            for path, content in zip(files["path"].to_pylist(), files["content"]):
                # rows leave only when the whole file has parsed, so a failed file leaves none
                try:
                    out += _needed_rows(path, content.as_py(), wanted)
                except Exception as error:
                    out.append((path, "error", 0, None, f"{type(error).__name__}: {error}"))
                # the rows of small files leave together
                while len(out) >= chunk:
                    yield batch(out[:chunk])
                    del out[:chunk]
        if out:
            yield batch(out)
    return parse


#: Columns of parsed files.
PARSED = "path string, category string, row bigint, values array<string>, error string"
#: The categories that hold header fields.
HEADER = ("exptl", "pdbx_database_status", "database_PDB_rev", "refine", "em_3d_reconstruction", "reflns")


def parse_contents(files: DataFrame, chunk: int = 50_000, categories: Collection[str] = tuple(CATEGORIES)) -> DataFrame:
    """The needed rows of files whose ``content`` (bytes, gzip where the ``path`` ends in .gz) is a column; see ``read_mmcif``.

    Files are parsed whole, and the rows of ``categories`` come out.
    """
    return files.select("path", "content").mapInArrow(_parse_files(chunk, frozenset(categories)), PARSED)


def read_mmcif(spark: SparkSession, paths: DataFrame | Sequence[str], chunk: int = 50_000) -> DataFrame:
    """(path, category, row, values, error): the needed rows of every file.

    ``paths`` is a list of files, or a DataFrame with ``path``. Only those files are opened: their
    names go to the reader, whose own file index holds them on the driver in any case. Of the
    atoms only backbone ones leave the parser. A file that parses gives one ``parsed`` row with
    its number of atom rows, a file that cannot be parsed one ``error`` row and nothing else.
    """
    names = [r["path"] for r in paths.select("path").toLocalIterator()] if isinstance(paths, DataFrame) else list(paths)
    if not names:
        return spark.createDataFrame([], PARSED)
    literal = [re.sub(r"([\\\[\]{}*?])", r"\\\1", name) for name in names]
    return parse_contents(spark.read.format("binaryFile").load(literal), chunk)


def category_table(parsed: DataFrame, category: str) -> DataFrame:
    """One file category as a table: path, row and its columns, lower-cased."""
    columns = CATEGORIES[category]
    return parsed.where(F.col("category") == category).select(
        "path", "row", *[F.get("values", F.lit(i)).alias(c.lower()) for i, c in enumerate(columns)])


def header_fields(parsed: DataFrame) -> DataFrame:
    """(path, method, date, resolution, atom_rows): first usable value of each header field."""
    def first(category: str, column: str, convert) -> Column:
        at = CATEGORIES[category].index(column)
        value = convert(F.get("values", F.lit(at)))
        usable = (F.col("category") == category) & value.isNotNull()
        return F.min_by(F.when(usable, value), F.when(usable, F.col("row")))

    text, number = (lambda c: X.clean_token(c)), (lambda c: X.finite_double(X.clean_token(c)))
    return parsed.where("category <> 'error'").groupBy("path").agg(
        first("exptl", "method", text).alias("method"),
        F.coalesce(first("pdbx_database_status", "recvd_initial_deposition_date", text),
                   first("database_PDB_rev", "date_original", text), first("database_PDB_rev", "date", text)).alias("date"),
        F.coalesce(first("refine", "ls_d_res_high", number), first("em_3d_reconstruction", "resolution", number),
                   first("reflns", "d_resolution_high", number)).alias("resolution"),
        F.max(F.when(F.col("category") == "parsed", F.get("values", F.lit(0)).cast("bigint"))).alias("atom_rows"))


def parse_failures(parsed: DataFrame) -> DataFrame:
    return parsed.where("category = 'error'").select(
        "path", F.lit("failed").alias("status"), F.lit("mmcif_parse_error").alias("reason"), "error")


# ---------------------------------------------------------------- PDB text

def pdb_atoms(lines: DataFrame) -> DataFrame:
    """Fixed-width atom lines as columns; MSE heteroatoms read as MET atoms.

    ``residue`` is the number minus one and ``insertion`` its trailing letter. The first line of
    an atom of a residue wins.
    """
    v = F.rtrim("value")
    mse = (F.substring(v, 1, 6) == "HETATM") & (F.substring(v, 18, 3) == "MSE")
    v = F.when(mse, F.replace(F.replace(v, F.lit("HETATM"), F.lit("ATOM  ")), F.lit("MSE"), F.lit("MET"))).otherwise(v)
    number = F.trim(F.substring(v, 23, 5))
    atoms = lines.withColumn("__v", v).where(F.substring("__v", 1, 4) == "ATOM")
    v = F.col("__v")
    number = F.trim(F.substring(v, 23, 5))
    lettered = number.rlike("[A-Za-z]$")
    digits = F.when(lettered, F.regexp_replace(number, "[A-Za-z]$", "")).otherwise(number)
    part = lambda at, width: F.trim(F.substring(v, at, width)).try_cast("double")
    return atoms.select(
        "file", "line", F.substring(v, 22, 1).alias("chain"), F.trim(F.substring(v, 13, 4)).alias("atom"),
        F.substring(v, 18, 3).alias("name"), (digits.try_cast("int") - 1).alias("residue"),
        F.when(lettered, F.right(number, F.lit(1))).otherwise("").alias("insertion"),
        vec(part(31, 8), part(39, 8), part(47, 8)).alias("xyz"))


def pdb_residues(atoms: DataFrame, atom_names: Sequence[str] = BACKBONE) -> DataFrame:
    """One row per residue, gaps between the least and greatest number included as ``-``.

    Residues are ordered by number and insertion letter; ``pos`` counts from 0.
    """
    one = atoms.groupBy("file", "chain", "residue", "insertion", "atom").agg(
        F.min_by("xyz", "line").alias("xyz"), F.min("line").alias("line"), F.min_by("name", "line").alias("name"))
    residues = one.groupBy("file", "chain", "residue", "insertion").agg(
        F.min_by("name", "line").alias("name"),
        *[F.max(F.when(F.col("atom") == a, F.col("xyz"))).alias(a.lower()) for a in atom_names])
    letters = residues.withColumn("aa", F.coalesce(
        F.try_element_at(X.literal_map((k, v) for k, v in X.THREE_TO_ONE.items() if k != "MSE"), F.col("name")), F.lit("-")))
    spans = residues.groupBy("file", "chain").agg(F.min("residue").alias("a"), F.max("residue").alias("b"))
    grid = spans.select("file", "chain", F.explode(F.sequence("a", "b")).alias("residue"))
    filled = grid.join(letters, ["file", "chain", "residue"], "left").withColumn(
        "aa", F.coalesce("aa", F.lit("-"))).withColumn("insertion", F.coalesce("insertion", F.lit("")))
    # residue numbers have four columns, which bounds a chain
    at = F.row_number().over(W.partitionBy("file", "chain").orderBy("residue", "insertion")) - 1
    return filled.withColumn("pos", at).drop("name")


def pdb_chains(residues: DataFrame) -> DataFrame:
    """(file, chain, seq, length) of every chain."""
    return residues.groupBy("file", "chain").agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("pos", "aa"))), lambda r: r["aa"]), "").alias("seq"),
        F.count("*").alias("length"))


def chain_alphabet() -> list[str]:
    """Chain names in reading order: A-Z, a-z, then 0 to 299."""
    return list(X.CHAIN_LETTERS[:52]) + [str(i) for i in range(300)]


def read_pdb(spark: SparkSession, path: str, chains: Sequence[str] | None = None, ca_only: bool = False) -> tuple[DataFrame, DataFrame]:
    """(structures, residues): per file its chains in alphabet order and their joined sequence."""
    residues = pdb_residues(pdb_atoms(numbered_lines(spark, path)), ("CA",) if ca_only else BACKBONE)
    names = list(chains or chain_alphabet())
    order = F.array_position(F.array(*[F.lit(n) for n in names]), F.col("chain"))
    per_chain = pdb_chains(residues).withColumn("__order", order).where(F.col("__order") > 0)
    rows = F.array_sort(F.collect_list(F.struct("__order", "chain", "seq")))
    structures = per_chain.groupBy("file").agg(rows.alias("rows")).select(
        F.regexp_extract("file", r"([^/]*?)\.[^./]*$", 1).alias("name"), "file",
        F.array_join(F.transform("rows", lambda r: r["seq"]), "").alias("seq"),
        F.transform("rows", lambda r: r["chain"]).alias("chains"), F.size("rows").alias("num_of_chains"))
    return structures, residues.join(per_chain.select("file", "chain"), ["file", "chain"], "left_semi")


def prediction_ca(lines: DataFrame, expected: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Predicted alpha carbons with their contract; returns (points, status).

    ``expected`` holds (file, sequence). Model 1, non-hetero CA atoms of one chain, numbered
    1..L without insertion letters, with the expected sequence and finite coordinates; a file
    that breaks a rule is ``failed`` with the first rule it breaks.
    """
    model = numbered_models(lines)
    points = pdb_atoms(model.where("model = 1")).where("atom = 'CA'").withColumn("number", F.col("residue") + 1)
    raw = model.where("model = 1").select("file", "line", F.substring("value", 1, 6).alias("record"))
    points = points.join(raw.where("record = 'ATOM  '").select("file", "line"), ["file", "line"], "left_semi")
    summary = points.groupBy("file").agg(
        F.count("*").alias("n"), F.count_distinct("chain").alias("n_chains"),
        F.count_distinct("number").alias("n_numbers"), F.min("number").alias("low"), F.max("number").alias("high"),
        F.count_if(F.col("insertion") != "").alias("inserted"), F.count_if(~finite(F.col("xyz"))).alias("broken"),
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("number", X.residue_letter(F.col("name")).alias("aa")))),
                                 lambda r: r["aa"]), "").alias("sequence"))
    joined = expected.withColumnRenamed("sequence", "expected").join(summary, "file", "left")
    length = F.length("expected")
    reason = F.coalesce(
        F.when(F.col("n").isNull() | (F.col("n") != length), "ca_count"),
        F.when(F.col("n_chains") != 1, "single_chain"),
        F.when(F.col("inserted") > 0, "insertion_code"),
        F.when((F.col("n_numbers") != length) | (F.col("low") != 1) | (F.col("high") != length), "residue_numbers"),
        F.when(F.col("sequence") != F.col("expected"), "sequence"),
        F.when(F.col("broken") > 0, "non_finite"))
    status = joined.select("file", F.when(reason.isNull(), "ok").otherwise("failed").alias("status"), reason.alias("reason"))
    ok = points.join(status.where("status = 'ok'").select("file"), "file", "left_semi")
    return ok.select("file", (F.col("number") - 1).alias("pos"), "xyz"), status


def numbered_models(lines: DataFrame) -> DataFrame:
    """Lines with their model number: text before the first MODEL line is model 1."""
    from ..operators.scale import ordered_scan

    mark = F.substring("value", 1, 6) == "MODEL "
    scanned = ordered_scan(lines.withColumn("__m", mark.cast("bigint")), ["line"], {"__nth": ("sum", "__m")}, ["file"])
    numbers = scanned.where("__m = 1").select("file", "__nth", F.trim(F.substring("value", 7, 10)).try_cast("int").alias("model"))
    return scanned.join(numbers, ["file", "__nth"], "left").select("file", "line", "value", F.coalesce("model", F.lit(1)).alias("model"))


def native_ca(residues: DataFrame, chains: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Native alpha carbons of chosen chains; returns (points, coverage per chain).

    ``residues``: entry, chain, pos, n, ca, c, o structs; ``chains``: entry, chain, sequence.
    Chains with fewer than three resolved alpha carbons, or whose length is not that of the
    sequence, are ``failed``.
    """
    mine = residues.join(chains.select("entry", "chain"), ["entry", "chain"], "left_semi")
    whole = finite(F.col("n")) & finite(F.col("ca")) & finite(F.col("c")) & finite(F.col("o"))
    summary = mine.groupBy("entry", "chain").agg(
        F.count("*").alias("length"), F.count_if(finite(F.col("ca"))).alias("resolved_ca"),
        F.avg(finite(F.col("ca")).cast("int")).alias("native_ca_coverage"),
        F.avg(whole.cast("int")).alias("native_complete_backbone_coverage"))
    checked = chains.join(summary, ["entry", "chain"], "left")
    reason = F.coalesce(
        F.when(F.col("length").isNull(), "missing_chain"),
        F.when(F.col("length") != F.length("sequence"), "length"),
        F.when(F.col("resolved_ca") < 3, "too_few_resolved"))
    status = checked.withColumn("reason", reason).withColumn("status", F.when(reason.isNull(), "ok").otherwise("failed"))
    points = mine.where(finite(F.col("ca"))).select("entry", "chain", "pos", F.col("ca").alias("xyz"))
    return points, status
