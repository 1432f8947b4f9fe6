"""Time the headline queries on one local session and print one JSON line."""

from __future__ import annotations

import json
import os
import time

from vitalsieve.plans.catalog import QUERIES
from vitalsieve.session import build_session

HEADLINE = (
    "iqr_outliers", "column_profile", "summary_statistics", "box_by_class", "corr_matrix", "histogram_by_class", "kde_grid",
    "prevalence_by_category", "flag_rate_gap", "dup_groups", "conflicts", "stratified_split_orders", "stratified_folds", "group_split",
    "impute_scale_onehot", "threshold_metrics", "ranking_metrics", "fold_summary", "linear_score", "answer_requests", "fingerprint",
    "answer_mixed_requests", "cv_metrics", "corr_many_columns",
)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    cpus = os.environ.get("BENCH_CPUS", "8")
    spark = build_session(
        "bench", f"local[{cpus}]", spark__sql__shuffle__partitions=cpus, spark__ui__enabled="false",
        spark__ui__showConsoleProgress="false", spark__driver__memory="16g", spark__sql__files__maxPartitionBytes="8m",
        spark__sql__files__openCostInBytes="1m",
    )
    spark.sparkContext.setLogLevel("ERROR")
    QUERIES["value_counts"](spark, sf_dir).collect()
    times: dict[str, float] = {}
    for name in HEADLINE:
        start = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        times[name] = round(time.perf_counter() - start, 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
