"""Headline queries on local[$BENCH_CPUS] over $BENCH_SF_DIR; prints one JSON line."""

from __future__ import annotations

import json
import os
import sys
import time

os.environ.setdefault("NAVLOOM_DRIVER_MEMORY", "6g")
sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "performance_peer_rank",
    "k13_stats_many_windows",
    "k15_wide_by_period",
    "k28_classic_stats_row",
    "k19_capture_ratios",
    "l24_performance_rank",
    "l26_alpha_total_score",
    "l17_log_alpha_vs_peers",
    "l03_industry_exposure",
    "l13_sector_rotation",
    "l30_stock_temperature",
    "e05_percent_rank_sql",
    "e11_equal_frequency_groups",
    "d04_grouping_sets",
    "d05_class_median_mean",
    "c09_interval_validity_join",
    "c10_as_of_join",
    "m01_weight_drift",
    "m07_linked_contribution",
    "m10_compliance_checks",
    "m21_average_cost_ledger",
    "o02_rolling_window_moments",
    "p01_bars_30min",
    "a08_partitioned_write_update",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from navloom import catalog
    from navloom.session import local_session

    spark = local_session(cpus, partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    queries["a18_coverage_statistics"](spark, sf_dir).write.format("noop").mode("overwrite").save()  # starts the JVM's threads
    spent: dict[str, float] = {}
    for name in HEADLINE:
        t0 = time.time()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        spent[name] = round(time.time() - t0, 3)
        print(f"{name} {spent[name]}", file=sys.stderr, flush=True)
    total = round(sum(spent.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": spent, "sf": os.path.basename(sf_dir.rstrip("/"))}))


if __name__ == "__main__":
    main()
