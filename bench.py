"""Wall time of the headline queries. Prints one JSON line: ``queries`` with the stored tables there,
``cold`` with all of them yet to be built."""
from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = (
    "stock_risk_quarter", "price_quarterly", "dividends_as_paid", "corrupt_tickers",
    "eps_quarterly", "shares_quarterly", "split_factor_after", "split_factor_between",
    "quarterly_fundamentals", "value_panel", "backtest_stats", "dq_violation_report",
)


def main() -> None:
    from pyspark.sql import SparkSession

    from quarterline.plans.domain import Domain
    from quarterline.queries import QUERIES

    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]").appName("quarterline-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "12g"))
        .config("spark.ui.enabled", "false").config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        # shuffles of a few megabytes still use all cores of one machine
        .config("spark.sql.adaptive.coalescePartitions.minPartitionSize", "128k")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    names = os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",")
    cold, took = {}, {}
    for name in names:
        Domain.forget(spark, sf_dir)
        for times in (cold, took):
            t0 = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times[name] = round(time.perf_counter() - t0, 3)
    spark.stop()
    print(json.dumps({
        "metric": "headline queries, total wall time after one warm-up each",
        "value": round(sum(took.values()), 3), "unit": "sec", "queries": took, "cold": cold, "cold_value": round(sum(cold.values()), 3),
        "sf": os.path.basename(sf_dir.rstrip("/")),
    }))


if __name__ == "__main__":
    main()
