"""Wall time of the headline queries; prints one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose data and cores; BENCH_QUERIES (comma list) narrows the set.
"""

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from laurel.session import build_session  # noqa: E402

HEADLINE = [
    "flagship_rank", "transform_stage", "final_rank", "midrank_percentile", "midrank_percentile_skew",
    "position_in_skewed_groups", "lexicon_sentiment", "aspect_mean", "upper_median_recency", "order_recency",
    "page_audit", "type_accept", "geo_radius_filter", "candidate_dedup_merge", "topk_per_topic", "entity_resolution",
    "business_upsert", "raw_latest", "metric_upsert", "platform_match_geo", "serp_rank_join", "ai_mention_join",
    "review_snippets", "strengths_context", "ranking_wide", "export_csv_rows", "export_json_docs",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    wanted = os.environ.get("BENCH_QUERIES")
    spark = build_session("laurel-bench", master=f"local[{cpus}]", shuffle_partitions=int(cpus) if cpus.isdigit() else 8)
    spark.sparkContext.setLogLevel("ERROR")
    from laurel.plans import driver_tables
    from laurel.plans.queries import QUERIES
    # the tables' files have one split each
    driver_tables.TEXT_TASKS = spark.sparkContext.defaultParallelism
    names = wanted.split(",") if wanted else HEADLINE
    # one small query first: JVM and Python start-up are not part of any query
    QUERIES["bayesian_rating"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    spark.stop()
    print(json.dumps({"metric": "total_wall_time", "value": round(sum(times.values()), 3), "unit": "sec",
                      "queries": times, "sf": os.path.basename(folder.rstrip("/")).removeprefix("sf")}))


if __name__ == "__main__":
    main()
