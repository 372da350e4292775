"""Time the headline queries; prints one JSON line.

``BENCH_SF_DIR`` names the tables (default sf0.1) and ``BENCH_CPUS`` the cores. Every query runs once to warm up and
then ``BENCH_RUNS`` times; the best time counts. Results go to a sink that keeps nothing, so all rows are made.
"""

from __future__ import annotations

import json
import os
import sys
import time
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

HEADLINE = [
    "p1_split_record", "p7_mask_identities", "p9_request_type", "p19_stamped_codes", "p22_booking_digests",
    "p24_processed_line", "a1_block_count", "a4_agent_count", "a5_min_gap", "a6_short_gaps", "j1_metrics_per_request",
    "a11_flow_result", "a12_latest_entry", "g2_five_minute_metrics", "n2_bookings_per_key", "j2_spider_join_left",
    "a18_select_conversion", "a22_volumes", "w3_daily_series", "a15_link_snapshot", "a28_host_status", "t1_route_ranking",
    "t2_seat_ranking_page", "s9_flow_rules", "j3_newest_backup", "g2_streamed_metrics",
]


def main() -> None:
    from skywarden.plans.catalog import QUERIES
    from skywarden.session import build_session

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session("bench", f"local[{cpus}]", spark__ui__enabled="false", spark__ui__showConsoleProgress="false",
                          spark__sql__shuffle__partitions=cpus, spark__driver__memory="12g")
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    times = {}
    for name in HEADLINE:
        run(name)
        times[name] = round(min(run(name) for _ in range(runs)), 3)
    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline queries, total", "value": total, "unit": "sec", "queries": times,
                      "sf": Path(sf_dir).name.removeprefix("sf")}))
    spark.stop()


if __name__ == "__main__":
    main()
