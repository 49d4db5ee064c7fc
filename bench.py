"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the table folder, BENCH_CPUS the local cores. Each query is run to completion
into a no-op sink, once to warm up and BENCH_RUNS times timed; the fastest run counts.
"""

import json
import os
import time

from pyspark.sql import SparkSession

from matchlake.plans import registry

HEADLINE = (
    "w9_player_performance",
    "w8_fact_match_summary",
    "w3_dim_player",
    "w4_dim_team",
    "g1_batting",
    "g4_team_season",
    "g7_phase_analysis",
    "e1_running_totals",
    "e8_ball_win_probability",
    "t3_window_stats",
    "i1_merge_upsert",
    "i2_team_history",
    "r1_player_listing",
    "r5_head_to_head",
    "d21_dream_team",
    "d23_recent_deliveries",
    "k1_null_check",
    "k10_relationships",
)


def session(cpus: str) -> SparkSession:
    return (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("matchlake-bench")
        .config("spark.driver.memory", "8g")
        .config("spark.driver.host", "127.0.0.1")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = session(os.environ.get("BENCH_CPUS", "8"))
    spark.sparkContext.setLogLevel("ERROR")
    registered = registry()
    picked = os.environ.get("BENCH_QUERIES", "").split() or HEADLINE

    def timed(name: str) -> float:
        start = time.perf_counter()
        registered[name].run(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in picked:
        timed(name)
        seconds[name] = round(min(timed(name) for _ in range(runs)), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of fastest runs",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
