"""Headline queries, timed.  Prints one JSON line.

Each query runs once to warm up and then BENCH_RUNS times (default 2); the median counts.  All rows
are computed and thrown away by a sink that writes nothing.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from chatterscope.plans import registry
from chatterscope.plans.trend_queries import flagship
from chatterscope.session import get_spark

HEADLINE = (
    "ngram_count_month",
    "ngram_count_community_month",
    "ngram_count_daily",
    "relative_frequency",
    "community_counters",
    "top_communities",
    "compare_ngrams",
    "daily_stats",
    "author_activity",
    "edge_weights",
    "graph_by_year",
    "communities",
    "k_hop_followers",
    "stream_backlinks",
    "upsert_set_union",
    "text_match",
    "boundary_model_score",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    runs = int(os.environ.get("BENCH_RUNS", "2"))
    spark = get_spark(
        "chatterscope-bench",
        f"local[{cpus}]",
        **{
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.sql.shuffle.partitions": cpus,
            "spark.ui.enabled": "false",
            "spark.chatterscope.scanPartitions": cpus,
            "spark.checkpoint.dir": tempfile.mkdtemp(prefix="chatterscope-bench-"),
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = {"flagship": flagship, **{name: registry.queries()[name] for name in HEADLINE}}

    def run(query) -> float:
        started = time.perf_counter()
        query(spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - started

    seconds = {}
    for name, query in queries.items():
        run(query)
        seconds[name] = round(statistics.median(run(query) for _ in range(runs)), 3)
        print(name, seconds[name], file=sys.stderr)
    print(
        json.dumps(
            {
                "metric": "headline queries, total of medians",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
