"""Time the headline queries and print one JSON line.

Environment: BENCH_SF_DIR (tables, default /root/testdata/sf0.1), BENCH_CPUS (local
cores, default 8), BENCH_QUERIES (comma-separated names instead of the headline ones).
"""

from __future__ import annotations

import json
import os
import time

from tarnworks.plans import registered
from tarnworks.session import local_session

HEADLINE = [
    "pagerank_trade", "pagerank_topic", "rank_name_join", "topic_top", "node_counts",
    "components", "sentence_rank", "keyphrase_merge", "first_occurrence", "weekly_rate",
    "rate_trend", "user_trend", "emails_per_user", "log_parse", "daily_spine", "rolling_std",
    "queue_schedule", "pair_samples", "kendall_tau", "drug_plan_long", "plan_one_hot",
    "game_points", "game_pairs", "null_safe_ratio", "pagerank_sweep", "edit_distance", "ridge_rank",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    spark = local_session(cores, "bench")
    spark.sparkContext.setLogLevel("ERROR")
    queries = registered()
    spark.read.parquet(f"{folder}/orders.parquet").groupBy("o_orderstatus").count().collect()
    seconds = {}
    for name in names:
        start = time.time()
        queries[name][0](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.time() - start, 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
