"""Time the headline queries and print one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) and BENCH_CPUS (default 8) set the
data and the local cores. Each query runs once to warm up and then three times;
the median counts. A run covers building the plan, all jobs, and consuming every
result row without collecting it.
"""

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from tallygrain import catalog
from tallygrain.session import build_session

HEADLINE = ["rfm_segments", "behavior_features", "tx_with_merchant", "customer_wide_table", "woe_apply", "roc_auc"]


def main():
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = sys.argv[1:] or HEADLINE
    spark = build_session(
        "bench",
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": "16g",
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(4):
            start = time.perf_counter()
            queries[name](spark, folder).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs[1:]), 3)
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline queries, warm median", "value": total, "unit": "sec", "queries": seconds, "sf": folder}))
    spark.stop()


if __name__ == "__main__":
    main()
