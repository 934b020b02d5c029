"""Times the headline queries; prints one JSON line.

BENCH_SF_DIR (data folder), BENCH_CPUS (local threads) and BENCH_RUNS (timed runs after
one warm-up, the median counts) can be set; names of queries can be given as arguments.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

from tallyfold.plans import REGISTRY
from tallyfold.session import build_session

HEADLINE = """
word_count top_words top_words_of_year letter_count avg_word_length count_matches
keyword_top_articles corpus_report duplicate_articles most_commented articles_by_year
word_histogram capped_rows first_n_records incremental_append extract_articles max_by_station
spend_by_customer hyped_movies argmax_lookup min_scalar_semijoin previous_time_lookup out_of_order
kfold_positional_split leave_n_out_split graph_common_neighbors graph_undirected_hop
graph_merge_edge graph_having_label graph_upsert_counter regress_tree stream_word_count
stream_window_word_count stream_sliding_cond_count multi_sink
""".split()


def seconds(spark, name: str, sf_dir: str) -> float:
    start = time.perf_counter()
    REGISTRY[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "1"))
    spark = build_session(
        "bench",
        **{
            "spark.master": f"local[{cpus}]",
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "16g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    times = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds(spark, name, sf_dir)
        times[name] = round(statistics.median(seconds(spark, name, sf_dir) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total time of the headline queries",
        "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": sf_dir.rstrip("/").rsplit("sf", 1)[-1], "cpus": int(cpus), "spark": spark.version,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
