"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: folder of the tables (default /root/testdata/sf0.1). BENCH_CPUS: local cores (default 8).
Every query is executed whole into a no-op sink, after one untimed query has started the engine.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "a1_subject_costs",
    "a2_step_costs",
    "a3_list_price_savings_by_step",
    "j4_run_costs",
    "j3_subject_run_report",
    "a10_pod_aggregation",
    "a13_session_cost_report",
    "a14_rate_calibration",
    "w1_latest_per_unit",
    "j1_scan_scope_join",
    "j8_asof_earlier",
    "j9_match_series",
    "w5_interval_union",
    "w6_concurrency_shares",
    "w7_node_occupancy",
    "j6_containment_join",
    "a17_subject_manifest",
    "a24_participant_flow",
    "a39_redrive_plan",
    "a30_wide_table",
    "a25_describe_columns",
    "v1_tsnr_median",
    "v2_global_correlation",
    "v11_mutual_information",
    "v22_confounds_frame",
    "e3_trimmed_moments",
    "e13_agreement_description",
    "q1_stratified_sample",
    "s5_compaction_round_trip",
    "r4_hourly_costs",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from tidemark.plans import registry
    from tidemark.session import build_session

    registry.load_all()
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "16g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    registry.QUERIES["a4_distribution_summary"](spark, folder).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in HEADLINE:
        start = time.perf_counter()
        registry.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
