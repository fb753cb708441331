"""Times the headline queries and prints one line of JSON.

BENCH_SF_DIR names the folder of tables, BENCH_CPUS the number of local cores.
Every query runs once after a warm-up of the session and is written in full to a
sink that keeps nothing.
"""

from __future__ import annotations

import json
import os
import time

from tillflow.plans.queries import QUERIES
from tillflow.session import build_session

HEADLINE = [
    "transactions", "factors", "numbered_lines", "daily_revenue", "daily_features",
    "gap_filled_daily", "eval_metrics", "overview", "predictions_page_1", "weekday_profile",
    "region_category_totals", "top15_groups", "recent_events_20", "json_roundtrip",
    "json_dead_letter", "csv_roundtrip", "appended_orders", "stream_totals",
    "stream_raw_append", "live_snapshot", "rf_metrics",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus,
        spark__driver__memory=os.environ.get("BENCH_MEMORY", "8g"),
        spark__ui__showConsoleProgress="false",
    )
    spark.sparkContext.setLogLevel("OFF")

    def run(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return round(time.perf_counter() - start, 3)

    run("daily_revenue")
    seconds = {name: run(name) for name in HEADLINE}
    print(json.dumps({
        "metric": "total_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(folder).removeprefix("sf"),
        "cpus": int(cpus),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
