"""Times the headline queries and prints one JSON line."""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from pricetide.plans.queries import QUERIES
from pricetide.session import local_session

HEADLINE = [
    "price_text_roundtrip",
    "discount_rule",
    "dedup_first",
    "shard_urls",
    "breaker_pending",
    "overlap_links",
    "overlap_by_page",
    "catalog_merge",
    "merge_report",
    "topic_workbook",
    "page_links",
    "page_fields",
    "selector_hits",
    "extract_cellphones",
    "extract_gearvn",
    "extract_tgdd",
    "extract_fptshop",
    "extract_phongvu",
    "json_ld_product",
    "spec_map_last",
    "promo_clean",
    "listing_json",
    "store_report",
    "embedded_specs",
    "shard_run",
    "publish_catalog",
    "compact_shards",
    "append_stream",
]
# Each query runs so often; the median counts.
RUNS = int(os.environ.get("BENCH_RUNS", "3"))


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    names = list(QUERIES) if "--all" in sys.argv else HEADLINE
    spark = local_session(cpus, partitions=int(cpus), **{"spark.driver.memory": "12g"})
    spark.sparkContext.setLogLevel("ERROR")
    # Start the JIT and the Python workers outside the timings.
    for name in ("price_text_roundtrip", "selector_hits"):
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        runs = []
        for _ in range(RUNS):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(runs), 3)
    line = {
        "metric": f"total wall time of the queries, median of {RUNS} runs each",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus,
    }
    spark.stop()
    print(json.dumps(line))


if __name__ == "__main__":
    main()
