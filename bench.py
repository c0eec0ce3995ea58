"""Benchmark: run the headline queries on ``$BENCH_SF_DIR`` (default
/root/testdata/sf0.1) with ``local[$BENCH_CPUS]`` and print one JSON line.

Each query is executed in full through the ``noop`` sink (no collect to the
driver); the wall time per query is reported.
"""

from __future__ import annotations

import json
import os
import sys
import time
import warnings

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
warnings.filterwarnings("ignore")

HEADLINE = [
    "load_clean", "prior_count", "feature_frame", "category_profile", "numeric_histogram",
    "feature_drift", "target_encode_oof", "one_hot_long", "metrics", "best_f1",
    "backtest_counts", "routed_decision",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    from orderlens.session import get_spark
    spark = get_spark(f"local[{cpus}]", int(cpus) * 2,
                      extra={"spark.driver.memory": os.environ.get("BENCH_DRIVER_MEM", "16g")})
    from orderlens import catalog
    names = sys.argv[1:] or HEADLINE
    # warm-up: JVM class loading and the parquet footers, outside the timings
    spark.read.parquet(f"{sf_dir}/orders.parquet").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        t0 = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({"metric": "total_query_seconds", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf else sf_dir}))


if __name__ == "__main__":
    main()
