"""Time every registered query; prints one JSON line.

Environment: BENCH_SF_DIR (tables), BENCH_CPUS (cores), BENCH_RUNS (runs per
query, the median counts). Work that happens once per application, such as
loading the warehouse or landing and streaming the files, is timed once, on
its own entry, and the queries over its tables are timed after it.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tillroll import registry  # noqa: E402
from tillroll.session import local_session  # noqa: E402

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

PREPARE = {
    "load_warehouse": registry.star,
    "land_csv": registry.landed,
    "stream_two_deliveries": registry.streamed,
}


def seconds(work):
    start = time.perf_counter()
    work()
    return time.perf_counter() - start


def execute(rows):
    """Compute every row without sending any to the driver."""
    rows.write.format("noop").mode("overwrite").save()


def main():
    spark = local_session(CPUS, "tillroll-bench")
    spark.sparkContext.setLogLevel("ERROR")
    # One load of the smallest tables beside them loads and compiles the classes.
    small = os.path.join(os.path.dirname(SF_DIR.rstrip("/")), "sf0.001")
    if os.path.isdir(small):
        execute(registry.QUERIES["q01_revenue_by_mall"](spark, small))
    times = {}
    for name, build in PREPARE.items():
        times[name] = round(seconds(lambda: build(spark, SF_DIR)), 3)
    for name, query in registry.QUERIES.items():
        runs = [seconds(lambda: execute(query(spark, SF_DIR))) for _ in range(RUNS)]
        times[name] = round(statistics.median(runs), 3)
    print(
        json.dumps(
            {
                "metric": "seconds to load, stream and answer every query once",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(SF_DIR.rstrip("/")).replace("sf", ""),
                "cpus": CPUS,
                "runs": RUNS,
            }
        )
    )


if __name__ == "__main__":
    main()
