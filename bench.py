"""Time the headline queries and print one JSON line.

BENCH_SF_DIR and BENCH_CPUS choose the data and the cores, BENCH_RUNS the runs
whose median is reported. Every query computes its whole result; the result is
not brought to the driver.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import time

import verify
from registry import QUERIES

HEADLINE = (
    "stg_clean", "clean_for_training", "cleaning_report", "dedupe_narrative",
    "mart_by_category", "mart_by_response", "mart_top_companies", "marts_from_cube",
    "worst_in_class", "worst_in_class_orders", "rank_within_category",
    "check_suite", "lake_export_counts", "lake_snapshot_latest", "gated_build",
    "json_hits_explode", "load_raw_responses", "quota_per_category", "csv_roundtrip",
    "length_profile", "length_box_by_category",
    "stratified_split", "stratified_folds", "sample_per_class",
    "tokens_per_doc", "document_frequency", "tfidf_formula",
    "confusion_matrix", "classification_report", "macro_f1", "mean_ci",
    "parse_labels", "external_scores", "external_reliability",
)


def run_once(spark, sf_dir: str, name: str) -> float:
    start = time.perf_counter()
    QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
    return time.perf_counter() - start


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    runs = int(os.environ.get("BENCH_RUNS", "3"))
    spark = verify.session(cpus)
    run_once(spark, sf_dir, "mart_by_category")  # class loading is not a query
    seconds = {}
    for name in sys.argv[1:] or HEADLINE:
        seconds[name] = round(statistics.median(run_once(spark, sf_dir, name) for _ in range(runs)), 3)
    print(json.dumps({
        "metric": "total_query_seconds", "value": round(sum(seconds.values()), 3), "unit": "sec",
        "queries": seconds, "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
        "cpus": cpus, "runs": runs,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
