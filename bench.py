"""Benchmark the headline queries.

    BENCH_SF_DIR=/root/testdata/sf0.1 BENCH_CPUS=4 python bench.py

Each query is executed in full with the ``noop`` sink (the whole plan runs, no
rows are collected); the median of ``BENCH_REPEAT`` runs (default 3) is
reported. Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "gold_loss_ratio", "scd1_customer", "scd2_customer", "scd2_snapshot_delete", "table_diff_customer",
    "dedupe_lineitem", "delete_insert_lineitem", "customer_tier_history", "asof_orders_customer",
    "dq_results", "dq_split_bad", "recon_rules", "recon_keys_customer", "profile_orders", "pii_classify",
    "pii_redact", "run_fold", "anomaly_durations", "last_n_runs", "lineage_closure", "eav_pivot",
    "cdc_parse_events",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "4"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or HEADLINE

    from stratum.plans.catalog import load_all
    from stratum.session import build_session

    spark = build_session(f"local[{cpus}]", app="stratum-bench", shuffle_partitions=max(cpus * 2, 8),
                          extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEMORY", "8g")})
    reg = load_all()
    # Untimed warm-up: JVM class loading and code generation are not query cost.
    spark.read.parquet(f"{sf_dir}/lineitem.parquet").groupBy("l_returnflag").count().write.format("noop") \
        .mode("overwrite").save()
    timings = {}
    for n in names:
        runs = []
        for _ in range(repeat):
            t0 = time.perf_counter()
            reg[n].build(spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - t0)
        timings[n] = round(statistics.median(runs), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    out = {"metric": "sum_median_query_seconds", "value": round(sum(timings.values()), 3), "unit": "sec",
           "queries": timings, "sf": sf, "cpus": cpus, "repeat": repeat}
    print(json.dumps(out))
    spark.stop()


if __name__ == "__main__":
    main()
