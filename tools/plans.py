"""Summarise the physical plans of the headline queries (shuffles, broadcasts, top-k, pushdown).

usage: python tools/plans.py [sf_dir] > docs/PLANS.md
Counts are taken from the plan Spark would run for the final step of each
query (upstream step tables are materialised first, as in a daily run).
"""

from __future__ import annotations

import os
import re
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

HEADLINE = ["daily_interactions", "post_meta", "doc_tokens", "tfidf_weights", "seed_similarity", "similar_posts",
            "hybrid_recs", "bias_rmse", "outbound_feed"]


def main() -> None:
    sf = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.1"
    from tallyrec.plans import catalog
    from tallyrec.plans.daily import DailyRun
    from tallyrec.session import build_session

    spark = build_session(8, 16)
    spark.conf.set("spark.sql.maxMetadataStringLength", "400")
    run = DailyRun(spark, sf)
    # Final-step plans of the materialised steps are shown through these unmaterialised builders.
    from tallyrec.operators import interactions, posts, tfidf

    builders = {
        "daily_interactions": lambda: interactions.rated_interactions(*run.activity, run.cohort, run.seed_log),
        "post_meta": lambda: posts.post_meta(run.base, run.permalink, run.content, run.categories),
        "doc_tokens": lambda: tfidf.doc_tokens(run.meta_text, spark, run.p.extra_stop_words),
        "tfidf_weights": lambda: tfidf.tfidf(run.tokens, run.vocab, run.meta.select("*").count()),
        "seed_similarity": lambda: run.similarity(run.weights),
        "similar_posts": lambda: run.similar,
        "hybrid_recs": lambda: run._hybrid(lambda df: __import__("tallyrec.operators.rating", fromlist=["x"])
                                           .predict_bias(df, run.bias)),
        "bias_rmse": lambda: catalog.QUERIES["bias_rmse"](spark, sf),
        "outbound_feed": lambda: run.outbound,
    }
    print(f"# Physical plans of the headline steps ({os.path.basename(sf)}, before AQE re-planning)\n")
    print("Generated by `python tools/plans.py`. Shuffles = hash/range exchanges. SinglePartition exchanges come only "
          "from global scalar aggregates (means, counts, newest time), Spark's runtime bloom-filter builds (a few MB "
          "each) or the bounded bucket-offset window. Counts are of plan nodes; the plan text repeats a subtree "
          "used in several places (e.g. a key set that filters another table), and identical exchanges run once "
          "(exchange reuse).\n")
    print("| step | shuffles | single-partition | runtime bloom filters | broadcasts | WindowGroupLimit (partial/final) "
          "| partial aggs | Python |")
    print("| --- | --- | --- | --- | --- | --- | --- | --- |")
    scans = {}
    for name in HEADLINE:
        p = builders[name]()._jdf.queryExecution().executedPlan().toString()
        shuffles = len(re.findall(r"Exchange (hashpartitioning|rangepartitioning)", p))
        single = p.count("Exchange SinglePartition")
        bcast = p.count("BroadcastExchange")
        wgl = f"{p.count('WindowGroupLimit') and len(re.findall(r'WindowGroupLimit.*Partial', p))}/" \
              f"{len(re.findall(r'WindowGroupLimit.*Final', p))}"
        partial = len(re.findall(r"functions=\[partial_", p))
        py = "yes" if ("BatchEvalPython" in p or "ArrowEvalPython" in p) else "no"
        bloom = p.count("partial_bloom_filter_agg")
        print(f"| {name} | {shuffles} | {single} | {bloom} | {bcast} | {wgl} | {partial} | {py} |")
        for line in p.splitlines():
            if "FileScan parquet" in line and "events.parquet" in line:
                scans.setdefault(name, []).append(line.strip())
    print("\n## Event scans (filters pushed into parquet, pruned read schema)\n")
    seen = set()
    for name, lines in scans.items():
        for line in lines:
            m = re.search(r"PushedFilters: (\[.*?\]), ReadSchema: (struct<[^>]*>)", line)
            if m and m.group(0) not in seen:
                seen.add(m.group(0))
                print(f"- `{name}`: PushedFilters {m.group(1)}; ReadSchema `{m.group(2)}`")


if __name__ == "__main__":
    main()
