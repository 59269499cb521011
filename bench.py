"""Time the headline queries: ``python bench.py`` prints one JSON line.

``BENCH_SF_DIR`` names the input folder, ``BENCH_CPUS`` the local cores and
``BENCH_QUERIES`` an optional comma-separated list of query names.
"""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

from affinis.plans.queries import QUERIES

HEADLINE = [
    "interactions_max_rate",
    "dataset_profile",
    "split_leave_n_a",
    "item_cooccurrence_min_support",
    "itemcf_cosine_topk",
    "itemcf_pearson_topk",
    "swing_topk",
    "swing_dense_topk",
    "recommend_swing",
    "eval_swing",
    "ppr_iterate",
    "ppr_push_recommend",
]


def main() -> None:
    folder = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    names = os.environ.get("BENCH_QUERIES", "").split(",") if os.environ.get("BENCH_QUERIES") else HEADLINE
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .config("spark.sql.shuffle.partitions", str(2 * int(cpus)))
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "16g"))
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["interactions_max_rate"](spark, folder).write.format("noop").mode("overwrite").save()
    took = {}
    for name in names:
        start = time.time()
        QUERIES[name](spark, folder).write.format("noop").mode("overwrite").save()
        took[name] = round(time.time() - start, 3)
        print(name, took[name], file=sys.stderr, flush=True)
    result = {
        "metric": "headline query seconds",
        "value": round(sum(took.values()), 3),
        "unit": "sec",
        "queries": took,
        "sf": folder.rstrip("/").rsplit("sf", 1)[-1],
    }
    print(json.dumps(result))


if __name__ == "__main__":
    main()
