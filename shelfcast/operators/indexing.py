"""Global positions and category numbers without a single-task sort."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from shelfcast.operators.skew import measured_join
from shelfcast.scratch import stage


def with_position(df: DataFrame, order: Sequence[Column | str], name: str = "position") -> DataFrame:
    """Add the 0-based position of each row in the global order.

    A range-partitioned sort gives each row its place within its partition; adding the
    sizes of the partitions before it makes the place global. The sorted rows are
    written first, so both readings see the same partitions.
    """
    local = stage(
        df.orderBy(*order).withColumn("_at", F.monotonically_increasing_id()), "sorted"
    ).withColumns(
        {"_block": F.shiftright("_at", 33), "_place": F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))}
    )
    # One row per sort partition, so this window is as small as the cluster's task count.
    earlier = Window.orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        local.groupBy("_block")
        .agg(F.count("*").alias("_size"))
        .withColumn("_start", F.coalesce(F.sum("_size").over(earlier), F.lit(0)))
        .drop("_size")
    )
    return (
        local.join(starts, "_block")
        .withColumn(name, F.col("_start") + F.col("_place"))
        .drop("_at", "_block", "_place", "_start")
    )


def category_index(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Number of every category of the columns: most frequent first, ties by text.

    Rows are ``column_name, value, n, idx``. All columns share one pass and one sort.
    """
    pairs = df.select(
        F.inline(
            F.array(
                *[
                    F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value"))
                    for c in columns
                ]
            )
        )
    )
    counts = (
        pairs.where(F.col("value").isNotNull())
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("n"))
    )
    placed = with_position(counts, ["column_name", F.desc("n"), "value"])
    # One row per column: a join on the column's name would send almost all rows to one task.
    starts = placed.groupBy("column_name").agg(F.min("position").alias("first")).collect()
    first = F.lit(0)
    for row in starts:
        first = F.when(F.col("column_name") == row["column_name"], F.lit(row["first"])).otherwise(first)
    return placed.select("column_name", "value", "n", (F.col("position") - first).alias("idx"))


def with_category_numbers(
    df: DataFrame, index: DataFrame, columns: Sequence[str], spread_by: Sequence[str]
) -> DataFrame:
    """Add ``i<column>``, the category number, for each column, with the number of
    categories as metadata.

    Numbers come by join, so no list of categories passes through the driver and a
    frequent category is spread over tasks once the index is too large to broadcast: the
    index says how frequent a category is, and only those are repeated.
    """
    per_column = index.groupBy("column_name").agg(F.count("*").alias("n_values")).collect()
    sizes = {row["column_name"]: row["n_values"] for row in per_column}
    for c in columns:
        known = {"ml_attr": {"type": "nominal", "name": f"i{c}", "num_vals": sizes.get(c, 0)}}
        own = index.where(F.col("column_name") == c)
        numbers = own.select(
            F.col("value").alias("_value"),
            F.col("idx").cast("double").alias(f"i{c}", metadata=known if c in sizes else None),
        )
        keyed = df.withColumn("_value", F.col(c).cast("string"))
        counted = own.select(F.col("value").alias("_value"), F.col("n").alias("_n"))
        df = measured_join(keyed, numbers, ["_value"], spread_by, how="left", counted=counted).drop("_value")
    return df
