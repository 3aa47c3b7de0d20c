"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` names the tables, ``BENCH_CPUS`` the local cores, ``BENCH_QUERIES`` (names
split by commas) an own choice of queries. Each query is timed to the last row of its whole
result, which is discarded. A short unrelated job starts the workers before the clock.
"""

import json
import os
import time

from agoralens.plans.catalogue import QUERIES
from agoralens.session import build_session

HEADLINE = (
    "match_best",
    "match_topk",
    "match_broadcast",
    "match_blocked",
    "match_cells",
    "text_match_topk",
    "encode_tfidf",
    "threshold_sweep",
    "score_boxplot",
    "similarity_report",
    "text_stats",
    "clean_opinions",
    "quality_report",
    "describe_lengths",
    "describe_values",
    "histogram_lengths",
    "top15_pivot",
    "top20_topics",
    "dup_counts",
    "stratified_split",
    "class_report",
    "train_predict",
    "topic_analysis",
    "topic_prompt",
    "conclusions",
    "stream_results",
    "stream_topic_state",
)


def main():
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES")
    names = chosen.split(",") if chosen else HEADLINE
    spark = build_session(
        f"local[{cpus}]",
        **{
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1000).mapInArrow(lambda it: it, "id long").write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(times.values()), 3),
                "unit": "sec",
                "queries": times,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
