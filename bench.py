"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR (default /root/testdata/sf0.1) names the tables, BENCH_CPUS the cores."""

from __future__ import annotations

import json
import os
import sys
import time

from pyspark.sql import SparkSession

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

import catalogue  # noqa: E402

HEADLINE = [
    "study_split",
    "recode_binary",
    "scale_minmax",
    "winsorize_exact",
    "row_key_copies",
    "latest_per_key",
    "split_exact_test",
    "summary_exact",
    "distinct_all",
    "cramers_v_all",
    "gvif_factor",
    "glm_coefficients",
    "ridge_scores",
    "stepwise_path",
    "group_report",
    "kmeans_sizes",
    "kmeans_elbow",
    "newton_margins",
    "newton_continuous",
    "adaboost_leaf_cap_margins",
    "newton_sweep",
    "shap_mean_absolute",
    "report_by_segment",
    "roc_fine_scores",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", str(os.cpu_count() or 8))
    spark = (
        SparkSession.builder.master(f"local[{cpus}]")
        .appName("riskframe-bench")
        .config("spark.sql.shuffle.partitions", cpus)
        .config("spark.driver.memory", "12g")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    queries = catalogue.queries()
    names = sys.argv[1:] or HEADLINE
    # start the Python workers and load the tables' first blocks outside the clock
    queries["kmeans_embeddings"](spark, sf_dir).write.format("noop").mode("overwrite").save()
    seconds = {}
    for name in names:
        start = time.perf_counter()
        queries[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        seconds[name] = round(time.perf_counter() - start, 3)
        print(f"{name} {seconds[name]}", file=sys.stderr, flush=True)
        spark.catalog.clearCache()
    total = round(sum(seconds.values()), 3)
    sf = os.path.basename(sf_dir.rstrip("/")).removeprefix("sf")
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec", "queries": seconds, "sf": sf}))
    spark.stop()


if __name__ == "__main__":
    main()
