"""Seconds per headline query at $BENCH_SF_DIR on local[$BENCH_CPUS], as one JSON line."""

from __future__ import annotations

import json
import os
import time

from clickledger.session import clear_steps, local_session
from clickledger.workload import queries

HEADLINES = [
    "sessionize",
    "session_bounds",
    "session_facts",
    "channel_prep",
    "channel_classify",
    "adgroup_utm_map",
    "onsite_conversions",
    "attribution_weights",
    "attributed_return",
    "ad_spend",
    "spend_facts",
    "lead_dim",
    "cumulative_marketing",
    "opportunity_mart",
    "quality_report",
    "profile_by_month",
    "profile_by_city",
    "information_gain",
    "upsert_by_key",
    "replace_tail",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    spark = local_session("bench", cores, shuffle_partitions=int(cores) if cores.isdigit() else 8)
    jobs = queries()
    jobs["bot_filter"](spark, folder).write.format("noop").mode("overwrite").save()  # start the JVM
    seconds = {}
    for name in HEADLINES:
        started = time.perf_counter()
        jobs[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
        clear_steps(spark)
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
