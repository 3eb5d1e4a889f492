"""Times the headline queries and prints one JSON line.

BENCH_SF_DIR names the data folder (default /root/testdata/sf0.1), BENCH_CPUS the number
of local cores (default 8). Every query runs to its last row without fetching rows.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfcast.plans import QUERIES  # noqa: E402
from shelfcast.plans.shared import stored_panel, stored_prepared_panel, stored_top_cells  # noqa: E402
from shelfcast.session import local_session  # noqa: E402

# Tables several queries share are built and timed on their own.
SHARED = {
    "build_panel": stored_panel,
    "build_top_cells": stored_top_cells,
    "build_prepared_panel": lambda spark, sf_dir: stored_prepared_panel(spark, sf_dir, base_slot=True),
}

HEADLINE = [
    "submission_matrix",
    "panel_label",
    "sum_top_cells",
    "sum_sq_error_by_key",
    "describe_columns",
    "missing_by_column",
    "pivot_two_keys",
    "distinct_keys",
    "top_keys",
    "box_by_month",
    "box_by_store_snap",
    "box_all_groupings",
    "split_hash_90_10",
    "stratified_sample",
    "category_index",
    "onehot_slots",
    "assemble_features",
    "dummy_columns",
    "scan_csv_typed",
    "sink_parquet_roundtrip",
    "array_reshape",
    "array_first_positive",
    "linear_regression",
    "submission_from_model",
    "glr_gaussian",
    "per_key_regression",
    "per_key_rmse",
    "per_key_least_squares",
]


def timed(build) -> float:
    start = time.perf_counter()
    build().write.format("noop").mode("overwrite").save()
    return round(time.perf_counter() - start, 3)


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    spark = local_session("bench", cores=os.environ.get("BENCH_CPUS", "8"))
    timed(lambda: QUERIES["submission_matrix"](spark, sf_dir))  # starts the JVM's compilers
    seconds = {}
    for name, build in {**SHARED, **{n: QUERIES[n] for n in HEADLINE}}.items():
        seconds[name] = timed(lambda build=build: build(spark, sf_dir))
    print(
        json.dumps(
            {
                "metric": "headline_queries_total",
                "value": round(sum(seconds.values()), 3),
                "unit": "sec",
                "queries": seconds,
                "sf": os.path.basename(sf_dir.rstrip("/")).removeprefix("sf"),
            }
        )
    )
    spark.stop()


if __name__ == "__main__":
    main()
