"""Readers of list, cluster, metadata, split, constraint, metric and manifest files."""

from __future__ import annotations

import json

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from ..functions import text as X
from .lines import last_per, numbered_lines

#: The columns of a target list, in file order.
TARGET_COLUMNS = ("CHAINID", "DEPOSITION", "RESOLUTION", "HASH", "CLUSTER", "SEQUENCE")
TARGET_SCHEMA = ", ".join(f"{c} STRING" for c in TARGET_COLUMNS)
#: Reasons for which an input is put off to the cropping job.
DEFERRED_REASONS = ("too_many_chains", "context_too_long")


def read_fasta(spark: SparkSession, path: str, limit: int = -1, omit: str = "") -> DataFrame:
    """(position, header, sequence) of FASTA records, lines joined, ``omit`` characters dropped."""
    lines = numbered_lines(spark, path)
    from ..operators.scale import ordered_scan
    marked = lines.withColumn("__head", F.startswith("value", F.lit(">")).cast("bigint"))
    numbered = ordered_scan(marked, ["line"], {"position": ("sum", "__head")}, ["file"]).where("position > 0")
    body = F.rtrim("value")
    if omit:
        body = F.translate(body, omit, "")
    # lines of one record only: a record is one output value
    rows = F.array_sort(F.collect_list(F.when(F.col("__head") == 0, F.struct("line", body.alias("t")))))
    records = numbered.groupBy("file", "position").agg(
        F.max(F.when(F.col("__head") == 1, F.substr(F.rtrim("value"), F.lit(2)))).alias("header"),
        F.array_join(F.transform(rows, lambda r: r["t"]), "").alias("sequence"))
    return records.where(F.col("position") <= limit) if limit >= 0 else records


def read_targets(spark: SparkSession, path: str) -> DataFrame:
    """Target list as text columns, header required."""
    return spark.read.schema(TARGET_SCHEMA).option("enforceSchema", False).csv(path, header=True)


def typed_targets(rows: DataFrame) -> DataFrame:
    """Typed target list with ``problem`` naming the first rule a row breaks.

    Cluster is an integer, resolution is empty or finite and positive, the other columns are not
    blank. The chain id splits at its last underscore into entry and chain.
    """
    value = {c: F.trim(c) for c in TARGET_COLUMNS}
    cluster = value["CLUSTER"].try_cast("bigint")
    resolution = X.finite_double(value["RESOLUTION"])
    blank = lambda c: F.coalesce(value[c] == "", F.lit(True))
    problem = F.coalesce(
        *[F.when(blank(c), f"empty_{c.lower()}") for c in ("CLUSTER", "SEQUENCE", "CHAINID", "HASH", "DEPOSITION")],
        F.when(cluster.isNull(), "invalid_cluster"),
        F.when((value["RESOLUTION"] != "") & (resolution.isNull() | (resolution <= 0)), "invalid_resolution"))
    split_at = r"^(.*)_([^_]*)$"
    return rows.select(
        value["CHAINID"].alias("chain_id"), F.regexp_extract(value["CHAINID"], split_at, 1).alias("entry_id"),
        F.regexp_extract(value["CHAINID"], split_at, 2).alias("chain"),
        value["DEPOSITION"].try_cast("date").alias("deposition"), resolution.alias("resolution"),
        value["HASH"].alias("hash"), cluster.alias("cluster"), F.upper(value["SEQUENCE"]).alias("sequence"),
        problem.alias("problem"))


def read_cluster_map(spark: SparkSession, path: str) -> DataFrame:
    """(pdb_id, entity_id, cluster): one cluster per line, its id the line number; later lines win."""
    tokens = numbered_lines(spark, path).select(
        F.col("line").alias("cluster"), F.explode(F.split(F.trim("value"), r"\s+")).alias("t")).where(F.col("t").contains("_"))
    pairs = tokens.select(
        F.upper(F.regexp_extract("t", "^(.*)_([^_]*)$", 1)).alias("pdb_id"),
        F.regexp_extract("t", "^(.*)_([^_]*)$", 2).alias("entity_id"), "cluster")
    return pairs.groupBy("pdb_id", "entity_id").agg(F.max("cluster").alias("cluster"))


def read_entry_metadata(spark: SparkSession, path: str) -> DataFrame:
    """(pdb_id, date, resolution, method, header) from a tab-separated index; later lines win."""
    lines = numbered_lines(spark, path).where(
        ~F.startswith("value", F.lit("IDCODE")) & ~F.startswith("value", F.lit("-")))
    f = F.split("value", "\t")
    rows = lines.where(F.size(f) >= 8).select(
        "line", F.upper(F.trim(f[0])).alias("pdb_id"), X.pivoted_date(f[2]).alias("date"),
        X.finite_double(F.trim(f[6])).alias("resolution"), F.trim(f[7]).alias("method"), F.trim(f[1]).alias("header"))
    return last_per(rows, ["pdb_id"]).drop("line")


def read_cluster_ids(spark: SparkSession, path: str) -> DataFrame:
    """(line, value, cluster) of the non-blank lines of a split file; cluster NULL when not an integer."""
    lines = numbered_lines(spark, path).select("line", F.trim("value").alias("value")).where("value <> ''")
    return lines.withColumn("cluster", F.col("value").try_cast("bigint"))


def check_cluster_ids(ids: DataFrame) -> DataFrame:
    """One row: entries, invalid, negative and duplicated ids; ``ok`` when there is none and some entry."""
    n = ids.agg(
        F.count("*").alias("entries"), F.count_if(F.col("cluster").isNull()).alias("invalid"),
        F.count_if(F.col("cluster") < 0).alias("negative"),
        (F.count("cluster") - F.count_distinct("cluster")).alias("duplicated"))
    return n.withColumn("ok", F.expr("entries > 0 and invalid = 0 and negative = 0 and duplicated = 0"))


def read_jsonl(spark: SparkSession, path: str, schema: str) -> tuple[DataFrame, DataFrame]:
    """(rows, bad lines with their number): lines that are not objects of the schema are bad."""
    typed = T._parse_datatype_string(schema)
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    parsed = lines.withColumn("__doc", F.from_json(
        "value", T.StructType([*typed.fields, T.StructField("__bad", T.StringType())]),
        {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"}))
    bad = F.col("__doc").isNull() | F.col("__doc.__bad").isNotNull() | ~F.startswith(F.ltrim("value"), F.lit("{"))
    return (parsed.where(~bad).select("line", *[F.col(f"__doc.`{f.name}`").alias(f.name) for f in typed.fields]),
            parsed.where(bad).select("file", "line", "value"))


@F.pandas_udf(T.StringType())
def json_problem(docs: pd.Series) -> pd.Series:
    """Why a text is no strict JSON object (duplicate key, NaN or Infinity, not an object), or NULL."""
    def unique(pairs):
        if len({k for k, _ in pairs}) < len(pairs):
            raise ValueError("duplicate key")
        return dict(pairs)

    def constant(name):
        raise ValueError(f"constant {name}")

    def check(text):
        try:
            value = json.loads(text, object_pairs_hook=unique, parse_constant=constant)
        except (ValueError, TypeError) as error:
            return str(error)
        return None if isinstance(value, dict) else "root is not an object"

    return docs.map(check)


def read_documents(spark: SparkSession, path: str) -> DataFrame:
    """(file, text, problem) of JSON documents, one per file, checked strictly."""
    docs = spark.read.text(path, wholetext=True).select(F.col("_metadata.file_path").alias("file"), F.col("value").alias("text"))
    return docs.withColumn("problem", json_problem("text"))


def read_deferred(deferred: DataFrame, files: DataFrame, limit: int = 0) -> tuple[DataFrame, DataFrame]:
    """Inputs put off to the cropping job, with guards; returns (rows, guard report).

    Only the two size reasons count. The report holds the count per reason, duplicated paths and
    paths that are not in ``files``.
    """
    rows = deferred.where(F.col("reason").isin(*DEFERRED_REASONS))
    if limit > 0:
        rows = rows.orderBy("line").limit(limit) if "line" in rows.columns else rows.orderBy("path").limit(limit)
    reasons = rows.groupBy(F.concat(F.lit("reason:"), "reason").alias("check")).agg(F.count("*").alias("n"))
    twice = rows.groupBy("path").agg(F.count("*").alias("c")).where("c > 1").agg(
        F.lit("duplicate_path").alias("check"), F.count("*").alias("n"))
    gone = rows.join(files.select("path"), "path", "left_anti").agg(F.lit("missing_file").alias("check"), F.count("*").alias("n"))
    return rows, reasons.unionByName(twice).unionByName(gone)


def filter_structures(
    rows: DataFrame, order: str, seq: str = "seq", max_length: int = 100, truncate: int | None = None,
    alphabet: str = X.ALPHABET + "-",
) -> tuple[DataFrame, DataFrame]:
    """Structures with known letters and at most ``max_length`` residues; returns (kept, counters).

    ``truncate`` keeps the first n accepted rows in ``order``.
    """
    letters = "[" + alphabet.replace("-", "") + (r"\-" if "-" in alphabet else "") + "]*"
    known = F.col(seq).rlike(f"^{letters}$")
    fits = F.length(seq) <= max_length
    counters = rows.agg(
        F.count("*").alias("read"), F.count_if(~known).alias("bad_chars"), F.count_if(known & ~fits).alias("too_long"),
        F.count_if(known & fits).alias("accepted"))
    kept = rows.where(known & fits)
    return (kept.orderBy(order).limit(truncate) if truncate is not None else kept), counters


def read_constraints(spark: SparkSession, path: str, schema: str, merge: bool = False) -> DataFrame:
    """(name, value) pairs of a constraint file whose lines are maps from structure name to ``schema``.

    The last line is the whole constraint, except with ``merge``, where names add up over the
    lines and later lines win.
    """
    lines = numbered_lines(spark, path).where(F.trim("value") != "")
    maps = lines.select("line", F.from_json("value", f"map<string,{schema}>").alias("m"))
    if not merge:
        maps = maps.agg(F.max_by("m", "line").alias("m"), F.max("line").alias("line"))
    return last_per(maps.select("line", F.explode("m").alias("name", "value")), ["name"]).drop("line")


def read_evaluations(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Evaluation JSONs named ``dataset--label.json``, with dataset and label as columns."""
    rows = spark.read.schema(schema).option("multiLine", True).json(path).withColumn("__f", F.col("_metadata.file_name"))
    parts = F.split(F.regexp_replace("__f", r"\.json$", ""), "--")
    return rows.withColumn("dataset", F.get(parts, F.lit(0))).withColumn("label", F.get(parts, F.lit(1))).drop("__f")


def read_epoch_metrics(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema("epoch INT, step BIGINT, train_loss DOUBLE, valid_loss DOUBLE, train_accuracy DOUBLE, "
                             "valid_accuracy DOUBLE, train_perplexity DOUBLE, valid_perplexity DOUBLE").json(path)


def read_throughput(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.schema(schema).option("sep", "\t").csv(path, header=True)


def chain_lookup(payloads: DataFrame, wanted: DataFrame, chain: str = "chain_id", entry: str = "entry_id") -> DataFrame:
    """Payload rows of chosen chains.

    The entry part of the chain id is compared as well, so that a payload table sorted by entry
    is pruned by its row-group statistics and by dynamic filters.
    """
    keys = wanted.select(chain).distinct().withColumn(entry, F.regexp_extract(chain, "^(.*)_([^_]*)$", 1))
    return payloads.join(keys, [entry, chain], "left_semi")


def download_manifest(entries: DataFrame, base_url: str, assembly_id: str = "all", limit: int = 0) -> DataFrame:
    """Manifest rows by relative path: of one assembly, or all of them; a positive limit keeps the first."""
    rows = entries
    if assembly_id != "all":
        rows = rows.where(F.col("relpath").rlike(rf"-assembly{assembly_id}\.cif\.gz$"))
    rows = rows.withColumn("url", F.concat(F.lit(base_url.rstrip("/") + "/"), "relpath"))
    return rows.orderBy("relpath").limit(limit) if limit > 0 else rows


def manifest_from_ids(ids: DataFrame, base_url: str, assembly_id: str = "1", limit: int = 0) -> DataFrame:
    """Manifest rows for a list of entry ids, filed by the two middle letters; sizes unknown."""
    pdb = F.lower(F.trim("pdb_id"))
    rows = ids.where(F.trim("pdb_id") != "").select(
        F.concat(F.substring(pdb, 2, 2), F.lit("/"), pdb, F.lit(f"-assembly{assembly_id}.cif.gz")).alias("relpath"),
        F.lit(None).cast("bigint").alias("size"), F.lit(None).cast("timestamp").alias("modified")).distinct()
    return download_manifest(rows, base_url, "all", limit)
