"""Benchmark: headline queries at $BENCH_SF_DIR on local[$BENCH_CPUS].

Every timed run starts from the raw parquet tables (a fresh daily run, so no
step table of an earlier run is reused) and writes the whole result to the
``noop`` sink.  One warm-up, then the median of three runs per query.
Prints one JSON line.  ``BENCH_QUERIES=all`` (or a comma list) times every
registered query instead of the headline set.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

HEADLINE = [
    "daily_interactions",
    "post_meta",
    "tfidf_weights",
    "seed_similarity",
    "hybrid_recs",
    "implicit_recs",
    "outbound_feed",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    names = sys.argv[1:] or HEADLINE
    if os.environ.get("BENCH_QUERIES") == "all":
        names = [n for n in __import__("__spark_entry__").queries()]
    elif os.environ.get("BENCH_QUERIES"):
        names = os.environ["BENCH_QUERIES"].split(",")

    from tallyrec.plans import catalog
    from tallyrec.session import build_session

    spark = build_session(cpus, shuffle_partitions=int(os.environ.get("BENCH_SHUFFLE_PARTITIONS", "16")))
    catalog.FRESH["value"] = True

    def once(name: str) -> float:
        t = time.perf_counter()
        catalog.QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        return time.perf_counter() - t

    once("hybrid_recs")  # warm-up: JVM, code generation, file listing
    out = {}
    for name in names:
        out[name] = round(statistics.median(once(name) for _ in range(runs)), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).replace("sf", "")
    print(json.dumps({
        "metric": "sum_of_median_query_seconds",
        "value": round(sum(out.values()), 3),
        "unit": "sec",
        "queries": out,
        "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
        "cpus": cpus,
        "runs": runs,
    }))


if __name__ == "__main__":
    main()
