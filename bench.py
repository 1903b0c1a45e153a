"""Time the headline queries and print one JSON line.

BENCH_SF_DIR: table folder (default /root/testdata/sf0.1); BENCH_CPUS: local cores.
BENCH_QUERIES: comma-separated names, or ``all``.
"""

from __future__ import annotations

import json
import os
import sys
import time

from staylens.catalog import QUERIES
from staylens.session import get_session

HEADLINE = [
    "entity_stats",
    "entity_stats_lines",
    "user_features",
    "review_features",
    "mean_impute",
    "date_features",
    "quantile_labels",
    "exact_quantiles",
    "standard_scale",
    "hash_split",
    "oversample",
    "oversample_poisson",
    "tokenize",
    "hashing_tfidf",
    "tfidf",
    "f1_scores",
    "auc",
    "silhouette",
    "kmeans_assign",
    "flag_anomalies",
    "registry_upsert",
    "registry_lookup",
    "leaderboard",
    "job_segment",
    "job_classify",
    "job_sentiment",
    "job_anomaly",
    "score_batch",
    "score_stream",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    chosen = os.environ.get("BENCH_QUERIES", "")
    names = list(QUERIES) if chosen == "all" else [n for n in chosen.split(",") if n] or HEADLINE
    spark = get_session(
        "staylens-bench",
        f"local[{cpus}]",
        {
            "spark.sql.shuffle.partitions": cpus,
            "spark.driver.memory": os.environ.get("BENCH_MEMORY", "12g"),
            "spark.ui.enabled": "false",
            "spark.ui.showConsoleProgress": "false",
        },
    )
    spark.sparkContext.setLogLevel("ERROR")
    spark.range(1_000_000).selectExpr("sum(id)").collect()  # start the JVM's workers

    seconds = {}
    for name in names:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name}: {seconds[name]}", file=sys.stderr, flush=True)
    result = {
        "metric": "total wall time of the headline queries",
        "value": round(sum(seconds.values()), 3),
        "unit": "sec",
        "queries": seconds,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
