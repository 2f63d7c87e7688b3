"""Times the headline queries and prints one line of JSON.

Every query is run over the whole table and written to a sink that discards the rows. One run warms up; the
median of the following runs counts.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from cartspark.plans.catalogue import QUERIES  # noqa: E402
from cartspark.session import build_session  # noqa: E402

HEADLINES = (
    "batch_summary",
    "history_rollup",
    "pair_state",
    "top_abandoned_products",
    "hourly_event_trend",
    "hourly_abandonment_trend",
    "sliding_windows_5m",
    "sliding_windows_60m",
    "serving_view",
    "decode_envelope",
    "micro_batch_estimate",
    "archive_stream",
    "stream_sliding_windows",
    "ratio_to_baseline",
)


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = build_session(
        "cartspark-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus if cpus.isdigit() else "8",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
            "spark.driver.memory": "12g",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")

    def timed(name: str) -> float:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - start

    seconds = {}
    for name in HEADLINES:
        timed(name)
        seconds[name] = round(statistics.median(timed(name) for _ in range(runs)), 3)
    print(
        json.dumps(
            {
                "metric": "headline queries, sum of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "cpus": cpus,
                "spark": spark.version,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
