"""Headline queries, timed one after another; prints one JSON line.

BENCH_SF_DIR folder of the tables (sf0.1), BENCH_CPUS threads (8), BENCH_RUNS timed
runs per query of which the median counts (1). Every query runs once untimed on the
smallest tables before, so the figures are those of a warm session.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from kvartal.catalogue.queries import QUERIES
from kvartal.session import local_session
from kvartal.sources.staging import staged_tables

HEADLINE = (
    "star_price_by_district",
    "silver_full",
    "listings_dedup",
    "duplicate_report",
    "duplicate_numbers",
    "keyword_scores",
    "document_keyword_scores",
    "area_bounds",
    "drop_reasons",
    "dim_property",
    "fact_listing",
    "layer_checks",
    "skip_seen",
    "append_new",
    "csv_roundtrip",
    "page_links",
    "raw_page_listings",
)
WARM_DIR = "/root/testdata/sf0.001"


def run(name: str, spark, sf_dir: str) -> float:
    """Seconds for one query, all rows and columns worked out and thrown away."""
    start = time.perf_counter()
    with staged_tables(spark):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    names = sys.argv[1:] or HEADLINE
    folder = tempfile.mkdtemp(prefix="kvartal-bench-")
    spark = local_session(cpus, "kvartal-bench", **{"spark.checkpoint.dir": folder})
    spark.sparkContext.setLogLevel("ERROR")
    for name in names:
        if os.path.isdir(WARM_DIR):
            run(name, spark, WARM_DIR)
    took = {
        name: round(statistics.median(run(name, spark, sf_dir) for _ in range(runs)), 3)
        for name in names
    }
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
        "runs": runs,
        "spark": spark.version,
        "shuffle_partitions": spark.conf.get("spark.sql.shuffle.partitions"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
