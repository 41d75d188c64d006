"""Time every registered query once and print one JSON line.

Settings: BENCH_SF_DIR (tables, default /root/testdata/sf0.1), BENCH_CPUS (default 8)
and BENCH_QUERIES (comma-separated names, default all).
"""

from __future__ import annotations

import json
import os
import time

import pyspark

from orderloom.catalog import QUERIES
from orderloom.session import build_session


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = [n for n in os.environ.get("BENCH_QUERIES", "").split(",") if n] or list(QUERIES)
    partitions = cpus if cpus.isdigit() else "8"
    spark = build_session(
        f"local[{cpus}]",
        "orderloom-bench",
        **{
            "spark.sql.shuffle.partitions": partitions,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.read.parquet(f"{folder}/region.parquet").count()
    seconds = {}
    for name in names:
        started = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - started, 3)
    print(
        json.dumps(
            {
                "metric": "total wall time of all queries, one run each",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf"),
                "spark": pyspark.__version__,
                "cpus": cpus,
                "shuffle_partitions": partitions,
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
