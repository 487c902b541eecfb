"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query is run once to warm up and then $BENCH_RUNS times (default 3); the median counts.
Results go to the no-op sink, so every row and column is computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from newsloom.plans.verification import QUERIES
from newsloom.session import local_session

HEADLINE = (
    "listing_links",
    "article_extract",
    "sanitize_pages",
    "clean_text",
    "parse_dates",
    "metadata_merge",
    "fingerprint_docs",
    "first_urls",
    "first_fingerprints",
    "request_page_join",
    "json_ingest",
    "build_rows",
    "upsert_articles",
    "collect_metrics",
    "collect_articles",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    staging = tempfile.mkdtemp(prefix="run-")
    spark = local_session(cpus, "newsloom-bench", **{"spark.checkpoint.dir": staging})
    seconds: dict[str, float] = {}
    for name in names:
        samples = []
        for _ in range(runs + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            samples.append(time.perf_counter() - start)
        seconds[name] = round(statistics.median(samples[1:]), 3)
        print(name, [round(s, 2) for s in samples], file=sys.stderr)
    result = {
        "metric": "news_collect_total",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": int(cpus),
    }
    print(json.dumps(result))
    spark.stop()


if __name__ == "__main__":
    main()
