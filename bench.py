"""Times the headline queries; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "cluster_union", "split_leak_audit", "inherit_splits", "reason_cascade", "target_member", "spatial_rank",
    "greedy_unique", "stratified_pick", "token_batches", "shard_plan", "budget_crop", "epoch_sample", "nearest_pair",
    "knn_graph", "best_atoms", "chain_assembly", "tag_trim", "sequence_recovery", "masked_nll", "metric_summary",
    "paired_wins", "gate_select", "id_fingerprint", "ref_audit", "region_overlap", "lease_expiry", "release_audit",
    "contact_agreement", "structure_metrics",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from strataloom.plans import load_queries
    from strataloom.plans.registry import QUERIES
    from strataloom.session import build_session

    spark = build_session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "16g", "spark.ui.enabled": "false"})
    spark.sparkContext.setLogLevel("ERROR")
    load_queries()
    names = sys.argv[1:] or HEADLINE
    # start the executor threads and Python workers before the clock does
    spark.range(0, 1000, 1, int(cpus)).mapInPandas(lambda it: it, "id bigint").groupBy("id").count().write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
                      "queries": seconds, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
