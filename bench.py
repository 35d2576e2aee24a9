"""Times the headline queries; prints one JSON line.

One unmeasured query warms the JVM up; then each runs BENCH_RUNS times (default
3), of which the median counts.

BENCH_SF_DIR   tables to read (default /root/testdata/sf0.1)
BENCH_CPUS     local threads (default 8)
"""

from __future__ import annotations

import json
import os
import statistics
import time

from pyspark.sql import SparkSession

from workloads.queries import QUERIES

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

# The thirteen tables, whole texts, deduplication, and the job over files.
HEADLINE = (
    "works_parent",
    "works_locations",
    "works_authorships",
    "works_topics",
    "works_open_access",
    "works_citations",
    "authors_parent",
    "authors_ids",
    "authors_counts_by_year",
    "institutions_parent",
    "institutions_geo",
    "publishers_parent",
    "topics_parent",
    "document_works",
    "document_references",
    "dedup_first_per_id",
    "strict_scalars",
    "job_works_citations",
    "job_works_authorships",  # many duplicates, no broadcast
    "job_authors_ids",
)


WARM_UP = "works_authorships"


def run(spark: SparkSession, name: str) -> float:
    start = time.perf_counter()
    # All rows and columns are computed, none are kept.
    QUERIES[name](spark, SF_DIR).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    spark = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", "16g")
        .config("spark.sql.shuffle.partitions", CPUS)
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    run(spark, WARM_UP)

    seconds = {}
    for name in HEADLINE:
        seconds[name] = round(statistics.median(run(spark, name) for _ in range(RUNS)), 3)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(SF_DIR.rstrip("/")),
            }
        )
    )


if __name__ == "__main__":
    main()
