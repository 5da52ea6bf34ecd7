"""Seconds per query over $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs twice, building its plan and writing every row to a sink that drops
them; the faster run counts. Name queries as arguments to run only those.
"""

from __future__ import annotations

import json
import os
import sys
import time

from packwatch.queries import QUERIES
from packwatch.session import build_session

RUNS = 2


def seconds(spark, folder: str, query) -> float:
    start = time.perf_counter()
    query(spark, folder).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main(names: list[str]) -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name, query in QUERIES.items():
        if names and name not in names:
            continue
        times[name] = round(min(seconds(spark, folder, query) for _ in range(RUNS)), 3)
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main(sys.argv[1:])
