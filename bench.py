"""Times queries on the bench tables and prints one JSON line.

BENCH_SF_DIR   folder of the tables (default /root/testdata/sf0.1)
BENCH_CPUS     local cores (default 8)
BENCH_QUERIES  comma-separated names, or ``all`` (default: the headline queries)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "c1_dimension", "c2_sync_update_queue", "j1_star_left_chain", "j3_create_queue", "j7_flag_mismatch", "j9_env_compare_metrics", "j16_resolve_links", "j22_identity_profile", "j23_identity_patterns",
    "a1_aggregate_many_to_one", "a4_kpi_summary", "a5_entity_performance", "a13_applicant_report", "a14_kpi_table", "a17_exclusion_waterfall", "a24_reference_usage", "a26_duration_stats",
    "f12_flag_points", "m3_health_check", "m7_compare_summary", "m8_dataset_parity", "m13_update_impact", "r2_apply_changes", "s7_batch_numbers", "w8_time_in_status", "w10_rank_of",
]


def main() -> None:
    import bindings.all  # noqa: F401
    from bindings.base import QUERIES
    from crosswalk.session import local_session

    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = local_session(cpus, cpus)
    spark.read.parquet(f"{folder}/lineitem.parquet").groupBy("l_returnflag").count().collect()  # start the executors
    seconds = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "total_query_seconds", "value": total, "unit": "sec", "queries": seconds, "sf": os.path.basename(folder.rstrip("/"))}))


if __name__ == "__main__":
    main()
