"""Grouped sums, value lists and column summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.columns import squared_error_or_default
from shelfcast.operators.clean import per_column
from shelfcast.sources.schema import columns_by_kind

# The fields that make up a top cell.
TOP_CELL = ["year", "month", "wday", "store_id", "snap", "flag_ram", "dept_id"]


def top_cells(panel: DataFrame) -> DataFrame:
    """Known sales summed per calendar, store and department cell."""
    return (
        panel.where(F.col("label").isNotNull())
        .groupBy(*TOP_CELL)
        .agg(F.sum("label").alias("sum_label"))
    )


def squared_error_by_key(panel: DataFrame) -> DataFrame:
    """Squared error of the delivered predictions per store, department and year."""
    return panel.groupBy("store_id", "dept_id", "year").agg(
        F.sum(squared_error_or_default("Sales_Pred", "sales")).alias("sum_sq_error")
    )


def value_lists(df: DataFrame, key: str, value: str) -> DataFrame:
    """Every key's values, in key and value order, equal values as one row with a count.

    A list per key would put a key's rows into one cell of one task; counted values
    hold the same list and spread over all tasks.
    """
    return (
        df.groupBy(F.col(key).alias("key"), F.col(value).alias("value"))
        .agg(F.count("*").alias("copies"))
        .orderBy("key", "value")
    )


def describe_numbers(df: DataFrame) -> DataFrame:
    """Count, mean, deviation and range of every numeric column, one row each."""
    columns = [c for c, kind in columns_by_kind(df.schema).items() if kind == "numeric"]
    return per_column(
        df,
        {
            "n": {c: F.count(c) for c in columns},
            "mean": {c: F.avg(c) for c in columns},
            "stddev": {c: F.stddev_samp(c) for c in columns},
            "min": {c: F.min(c).cast("double") for c in columns},
            "max": {c: F.max(c).cast("double") for c in columns},
        },
    )


def describe_texts(df: DataFrame) -> DataFrame:
    """Count and range of every text column, one row each."""
    columns = [c for c, kind in columns_by_kind(df.schema).items() if kind == "categorical"]
    return per_column(
        df,
        {
            "n": {c: F.count(c) for c in columns},
            "min_text": {c: F.min(c) for c in columns},
            "max_text": {c: F.max(c) for c in columns},
        },
    )


def column_profile(df: DataFrame, count_distinct: Sequence[str] = ()) -> DataFrame:
    """Kind, filled and missing values of every column; distinct values where asked.

    Exact distinct counts shuffle the distinct values, so name only columns whose
    values are worth that.
    """
    kinds = columns_by_kind(df.schema)
    wanted = set(count_distinct)
    profile = per_column(
        df,
        {
            "n_filled": {c: F.count(c) for c in kinds},
            "n_missing": {c: F.count_if(F.col(c).isNull()) for c in kinds},
            "n_distinct": {
                c: F.count_distinct(c) if c in wanted else F.max(F.lit(None).cast("bigint"))
                for c in kinds
            },
        },
    )
    kind = F.when(F.col("column_name").isin([c for c in kinds if kinds[c] == "numeric"]), "numeric")
    return profile.withColumn("kind", kind.otherwise("categorical"))


def shape(df: DataFrame) -> DataFrame:
    """One row: number of rows and of columns."""
    return df.agg(F.count("*").alias("n_rows"), F.lit(len(df.columns)).alias("n_columns"))
