"""Time the headline queries; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) is the input, BENCH_CPUS (default 8)
the number of local cores.  Every query runs once to warm up and is then timed;
results go to Spark's no-op sink, so all rows and columns are computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from firmloom.plans.catalog import QUERIES
from firmloom.session import local_session

HEADLINE = (
    "url_components", "seed_frontier", "schedule_batch", "page_contacts", "parse_pages", "discover_links",
    "structured_company", "document_emails", "document_phones", "company_name_scores", "profile_scalars",
    "profile_values", "recomputed_profiles", "search_inputs", "block_guard", "host_rollup", "latest_fetches",
    "keyed_upsert", "lookup_companies", "survivorship", "resolve_components", "resolve_exact",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    names = sys.argv[1:] or HEADLINE
    spark = local_session(cpus, shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    seconds = {}
    for name in names:
        times = []
        for _ in range(repeats + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            times.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(times[1:]), 3)
        print(f"{name} {seconds[name]}", file=sys.stderr)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    total = round(sum(seconds.values()), 3)
    print(json.dumps({"metric": "headline_queries_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf, "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
