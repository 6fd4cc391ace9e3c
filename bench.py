"""Time the headline queries and print one JSON line.

BENCH_SF_DIR names the data, BENCH_CPUS the local threads. Arguments select queries;
``all`` runs every registered one.
"""

from __future__ import annotations

import json
import os
import sys
import time

from storyloom.plans import catalog
from storyloom.session import session

HEADLINE = [
    "extract_article", "extract_links", "make_articles", "normalize_text", "dedup_exact", "dedup_prefix",
    "clean_articles", "near_duplicate_ids", "near_dup_minhash", "near_dup_cosine", "cleaning_report", "embed_batches",
    "mean_pool", "softmax_scores", "label_scores", "classify_text", "score_bias", "knn_exact", "knn_ivf", "knn_assign",
    "cosine_topk", "cluster_nn_stats", "window_candidates", "hdbscan_new", "hdbscan_soft", "cluster_assignments",
    "last_wins", "join_outputs", "event_stats", "upsert_events", "upsert_articles", "integrity_checks",
    "corpus_event_stats", "event_digest", "latest_articles", "similar_articles", "profile_table",
    "commit_warehouse", "incremental_run", "spanning_forest", "ivf_recall", "score_bias_trees", "classify_text_fitted",
    "warehouse_stats", "read_key_range",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = session("bench", f"local[{cpus}]", **{
        "spark.sql.shuffle.partitions": cpus,
        "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
        "spark.ui.enabled": "false",
    })
    spark.sparkContext.setLogLevel("ERROR")
    names = list(catalog.QUERIES) if sys.argv[1:] == ["all"] else sys.argv[1:] or HEADLINE
    catalog.QUERIES["clean_articles"](spark, folder).write.format("noop").mode("overwrite").save()
    times = {}
    for name in names:
        start = time.perf_counter()
        catalog.QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {times[name]}", file=sys.stderr)
    print(json.dumps({
        "metric": "total_query_time",
        "value": round(sum(times.values()), 3),
        "unit": "sec",
        "queries": times,
        "sf": os.path.basename(folder.rstrip("/")),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
