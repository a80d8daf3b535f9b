"""Headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Each query runs once to warm up and then three times; the median counts. The result goes to the
noop sink, so every column of every row is really computed.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import SparkSession  # noqa: E402

HEADLINE = (
    "page_articles pruned_pages d4_rule_demotion d5_parse_batch f3_execute_requests r2_match_domain r5_route "
    "x1_select_region x2_article_text x3_html_blocks x4_prune_blocks x11_dedup_corpus x11_dedup_documents "
    "x12_vote_language x14_extract_metadata x16_fingerprint d7_outcome_summary f4_parse_stream"
).split()


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    repeats = int(os.environ.get("BENCH_REPEATS", "3"))
    names = os.environ.get("BENCH_QUERIES", " ".join(HEADLINE)).split()
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")

    from pagework.queries import QUERIES

    seconds: dict[str, float] = {}
    for name in names:
        runs = []
        for _ in range(repeats + 1):
            start = time.time()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            runs.append(time.time() - start)
        seconds[name] = round(statistics.median(runs[1:] or runs), 3)
        print(name, [round(r, 2) for r in runs], file=sys.stderr, flush=True)
    sf = os.path.basename(os.path.normpath(sf_dir)).removeprefix("sf")
    print(json.dumps({
        "metric": "total_headline_seconds",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": int(cpus),
        "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
