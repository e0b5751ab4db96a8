"""Command line over the dataflows, for spark-submit."""

from __future__ import annotations

import argparse
import json

from pyspark.sql import DataFrame, SparkSession, functions as F

from .operators import ledger
from .operators.expect import enforce
from .plans import curate as P, suite
from .session import build_session
from .sources import sinks, tables as T

#: Published data set formats by name.
READERS = {
    "parquet": lambda spark, folder: spark.read.parquet(f"{folder}/targets"),
    "list": lambda spark, folder: T.typed_targets(T.read_targets(spark, f"{folder}/list")),
}


def read_dataset(spark: SparkSession, folder: str, fmt: str = "auto") -> DataFrame:
    """Target rows of a data set; ``auto`` takes the first format whose folder exists."""
    if fmt != "auto":
        return READERS[fmt](spark, folder)
    from .streaming.incremental import _exists

    for name, part in (("parquet", "targets"), ("list", "list")):
        if _exists(spark, f"{folder}/{part}"):
            return READERS[name](spark, folder)
    raise FileNotFoundError(f"no known data set format in {folder}")


def parser() -> argparse.ArgumentParser:
    root = argparse.ArgumentParser(prog="strataloom")
    sub = root.add_subparsers(dest="command", required=True)

    def command(name: str, *args: str, **options: type):
        p = sub.add_parser(name)
        for a in args:
            p.add_argument(a)
        for o, kind in options.items():
            p.add_argument(f"--{o.replace('_', '-')}", type=kind, required=False)
        return p

    command("curate", "raw", "metadata", "clusters", "out", config=str)
    command("validate", "folder", config=str)
    command("make-suite", "dataset", "out", low=int, high=int, bins=int, count=int, seed=int)
    command("verify-suite", "folder", low=int, high=int, count=int)
    command("ledger-status", "events", "items", now=float)
    command("ledger-export", "items", "attempts", "out")
    command("query", "name", "folder", "out")
    return root


def _report(df: DataFrame) -> None:
    for row in df.select(F.to_json(F.struct("*"))).toLocalIterator():
        print(row[0])


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(f"strataloom {args.command}")
    cfg = P.CurateConfig(**json.loads(args.config)) if getattr(args, "config", None) else P.CurateConfig()
    if args.command == "curate":
        release = P.curate(spark, args.raw, T.read_entry_metadata(spark, args.metadata), T.read_cluster_map(spark, args.clusters), cfg)
        P.publish(release, args.out)
    elif args.command == "validate":
        _report(enforce(P.validate(spark, args.folder, cfg)))
    elif args.command == "make-suite":
        targets = read_dataset(spark, args.dataset)
        ids = T.read_cluster_ids(spark, f"{args.dataset}/valid_clusters").select("cluster", F.lit("valid").alias("split"))
        suite.publish_suite(suite.make_suite(targets, ids, args.low, args.high, args.bins, args.count, args.seed or 0), args.out)
    elif args.command == "verify-suite":
        _report(enforce(suite.verify_suite(spark, args.folder, args.count, args.low, args.high)))
    elif args.command == "ledger-status":
        attempts = ledger.attempt_table(ledger.number_attempts(spark.read.parquet(args.events), ["at", "seq"]))
        if args.now is not None:
            attempts = ledger.expire_leases(attempts, args.now)
        _report(ledger.ledger_status(ledger.item_states(attempts, spark.read.parquet(args.items))))
    elif args.command == "ledger-export":
        sinks.export_ledger(spark.read.parquet(args.items), spark.read.parquet(args.attempts), args.out)
    else:
        from .plans import load_queries
        from .plans.registry import QUERIES

        load_queries()
        QUERIES[args.name](spark, args.folder).write.mode("overwrite").parquet(args.out)


if __name__ == "__main__":
    main()
