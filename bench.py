"""Benchmark of the headline queries.

Runs on ``local[$BENCH_CPUS]`` over ``$BENCH_SF_DIR`` (default sf0.1): one
warm-up run, then the median of ``$BENCH_REPEAT`` (default 3) runs per
query, each run fully executed into the ``noop`` sink.  Prints one JSON line.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = ("sales_agg_mn", "top3_sales_month", "ml_features", "mlfeatures", "mlfeatures_no_sentiment",
            "category_nodes", "reviews_tfidf", "salesaggregate", "fk_orphans", "sales")


def run_once(fn, spark, sf_dir) -> float:
    t0 = time.perf_counter()
    fn(spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - t0


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    repeat = int(os.environ.get("BENCH_REPEAT", "3"))
    names = sys.argv[1:] or list(HEADLINE)

    from shelfcast.session import build_session
    from shelfcast.plans.catalog import QUERIES
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=2 * cpus)

    times = {}
    for name in names:
        fn = QUERIES[name]
        run_once(fn, spark, sf_dir)                      # warm-up (JIT, file listing)
        times[name] = round(statistics.median(run_once(fn, spark, sf_dir) for _ in range(repeat)), 3)
    sf = sf_dir.rsplit("sf", 1)[-1]
    print(json.dumps({"metric": "headline_queries_total", "value": round(sum(times.values()), 3),
                      "unit": "sec", "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus, "repeat": repeat}))
    spark.stop()


if __name__ == "__main__":
    main()
