"""Headline queries at ``$BENCH_SF_DIR``; prints one JSON line.

Every query is run once to warm up and then three times; the median counts.
Results go to the no-op sink, so all rows are computed and none collected.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pyspark.sql import SparkSession

from fieldfit.bindings import queries as _queries  # noqa: F401  (registers)
from fieldfit.bindings.registry import REGISTRY

HEADLINE = (
    "completeness_by_deal",
    "completeness_by_company",
    "install_counts",
    "esn_validation",
    "esn_by_ticket",
    "ticket_table",
    "ticket_products",
    "dashboard_table",
    "grade_evolution",
    "revenue_thresholds",
    "upsert",
    "replace_by_key",
    "visible_tickets",
)
WARM_RUNS = 3


def timed(spark: SparkSession, sf_dir: str, name: str) -> float:
    started = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - started


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "16g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        timed(spark, sf_dir, name)
        runs = [timed(spark, sf_dir, name) for _ in range(WARM_RUNS)]
        seconds[name] = round(statistics.median(runs), 3)
    total = round(sum(seconds.values()), 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": total,
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
