"""What the physical plans must and must not hold."""

from __future__ import annotations

import contextlib
import io

import pytest

import __spark_entry__ as entry_module

QUERIES = entry_module.queries()

# Plans of these come from model transformers or per-key solving, which run outside
# generated code by design.
SINGLE_PASS = [
    "panel_label", "sum_top_cells", "sum_sq_error_by_key", "composite_id", "clamp_non_negative",
    "row_null_count", "squared_error_rules", "pivot_validation", "pivot_two_keys", "submission_matrix",
    "describe_columns", "missing_by_column", "per_key_regression", "per_key_rmse", "split_hash_90_10",
    "array_reshape", "array_first_positive", "distinct_keys", "top_keys", "null_row_count",
]


def plan_of(df, mode="formatted") -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain(mode)
    return out.getvalue()


@pytest.mark.parametrize("name", SINGLE_PASS)
def test_stays_in_the_jvm_without_cross_joins(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for word in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "ExistingRDD", "CartesianProduct", "NestedLoop"):
        assert word not in plan
    for line in plan.splitlines():
        if "SinglePartition" in line:
            # Only a global aggregate of one row may meet in one task.
            assert name in ("describe_columns", "missing_by_column", "null_row_count")


def test_flagship_reads_only_the_horizon_days(spark, sf_dir):
    plan = plan_of(QUERIES["submission_matrix"](spark, sf_dir))
    pushed = [line for line in plan.splitlines() if "PushedFilters" in line and "l_shipdate" in line]
    assert len(pushed) == 1 and "GreaterThanOrEqual(l_shipdate" in pushed[0]
    assert "l_extendedprice" not in plan


def test_top_keys_is_a_top_k(spark, sf_dir):
    assert "TakeOrderedAndProject" in plan_of(QUERIES["top_keys"](spark, sf_dir))
