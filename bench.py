"""Bench: build the gold layer from the driver tables, then run the headline
queries, each to completion (``noop`` sink: full execution, nothing collected).

The JVM is warmed first by the same build and queries on the smallest tables
(sf0.001), so the timings are steady-state (JIT-compiled) throughput; the
untimed warm-up's build time is reported as ``warmup_build_sec``.

Env: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_WARMUP_DIR (default /root/testdata/sf0.001; empty string: no warm-up).
Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pitchhouse import registry  # noqa: E402
from pitchhouse.plans.warehouse import warehouse  # noqa: E402
from pitchhouse.session import get_session  # noqa: E402

HEADLINE = [
    "season_summary", "team_performance", "home_away_advantage", "monthly_goals",
    "top_team_seasons", "league_overview", "team_match_log", "team_venue_split",
    "head_to_head", "head_to_head_avg_stats", "role_playing_names", "dq_report",
    "row_count_integrity", "silver_matches", "completeness_by_season",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    spark = get_session(f"local[{cpus}]", shuffle_partitions=2 * cpus,
                        extra={"spark.driver.memory": "16g"})
    spark.sparkContext.setLogLevel("ERROR")
    qs = registry.queries()
    warm_dir = os.environ.get("BENCH_WARMUP_DIR", "/root/testdata/sf0.001")
    warmup_build = None
    if warm_dir and os.path.isdir(warm_dir) and os.path.abspath(warm_dir) != os.path.abspath(sf_dir):
        t = time.time()
        warehouse(spark, warm_dir)
        warmup_build = round(time.time() - t, 3)
        for name in HEADLINE:
            qs[name](spark, warm_dir).write.format("noop").mode("overwrite").save()

    times: dict[str, float] = {}
    t0 = time.time()
    gold = warehouse(spark, sf_dir)
    times["build_gold"] = round(time.time() - t0, 3)

    for name in HEADLINE:
        t = time.time()
        qs[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.time() - t, 3)

    total = round(sum(times.values()), 3)
    matches = gold.silver.count()  # untimed; Parquet footers only
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_sec_build_plus_queries", "value": total, "unit": "sec",
                      "queries": times, "sf": sf, "matches": matches,
                      "build_matches_per_sec": round(matches / times["build_gold"]),
                      "warmup": warm_dir or None, "warmup_build_sec": warmup_build}))
    spark.stop()


if __name__ == "__main__":
    main()
