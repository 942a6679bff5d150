"""Seconds per headline query; prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS (default 8) the cores.
Each query is run once to warm up and then timed, its whole result being produced and dropped.
BENCH_QUERIES, a comma-separated list, replaces the default choice.
"""

from __future__ import annotations

import json
import os
import sys
import time

from hubbub.plans import catalog
from hubbub.session import local_session

HEADLINE = (
    "content_stats",
    "creator_stats",
    "hashtag_stats",
    "user_stats",
    "user_topic_engagement",
    "user_topic_maps",
    "feed_performance",
    "country_training_set",
    "country_models",
    "account_models",
    "interactions",
    "default_feed",
    "member_recommendations",
    "user_clusters",
    "clean_message",
    "clean_message_v2",
    "language_tag",
    "tag_messages",
    "topic_taxonomy",
    "embedding_topics",
    "reading_times",
    "credential_features",
    "classification_report",
    "suspicious_users",
    "upsert_replace",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cores = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = local_session(cores, shuffle_partitions=int(cores))
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalog.queries()
    seconds: dict[str, float] = {}
    for name in names:
        for _ in range(2):
            start = time.perf_counter()
            queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            seconds[name] = round(time.perf_counter() - start, 3)
        print(name, seconds[name], file=sys.stderr, flush=True)
    spark.stop()
    print(
        json.dumps(
            {
                "metric": "total_seconds",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )


if __name__ == "__main__":
    main()
