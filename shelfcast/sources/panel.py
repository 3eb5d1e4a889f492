"""The sales panel (one row per item, store and day) from the order tables."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession, functions as F

from shelfcast.operators.skew import PLAIN_LOOKUP_ROWS, measured_join
from shelfcast.sources.scans import read_named

# Day 0, the last day with known sales, and the length of a horizon.
DAY_ZERO = date(1995, 1, 1)
HISTORY_END = 2443
HORIZON = 28
VALIDATION_END = HISTORY_END + HORIZON


def _midnight(day_number: int):
    return F.expr(f"timestamp_ntz'{DAY_ZERO + timedelta(days=day_number)}'")


def sales_panel(
    spark: SparkSession,
    sf_dir: str,
    first_day: int | None = None,
    last_day: int | None = None,
    dept_id: str | None = None,
    store_id: str | None = None,
    plain_rows: int = PLAIN_LOOKUP_ROWS,
) -> DataFrame:
    """Panel rows of the days first_day..last_day (both ends included), of one department
    and one store if they are given; then other line items go before they are summed.

    A day range becomes a plain comparison on the ship date, which parquet can skip
    row groups by; the same test on ``dn`` after the aggregation could not be pushed.
    Units are summed per item, store and day on plain numbers before names and item
    fields are joined, so a best-selling item reaches those joins with at most
    stores x days rows. The supplier join before the sum splits suppliers with many line
    items, once there are more than ``plain_rows`` suppliers.
    """
    lines = read_named(spark, sf_dir, "lineitem")
    if first_day is not None:
        lines = lines.where(F.col("l_shipdate") >= _midnight(first_day))
    if last_day is not None:
        lines = lines.where(F.col("l_shipdate") < _midnight(last_day + 1))
    stores = read_named(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("l_suppkey"), "s_nationkey")
    stores = stores.where(F.col("l_suppkey").isNotNull())
    names = read_named(spark, sf_dir, "nation").select("n_nationkey", F.col("n_name").alias("store_id"))
    items = read_named(spark, sf_dir, "part").select(
        "p_partkey", F.col("p_type").alias("dept_id")
    )
    if store_id is not None:
        names = names.where(F.col("store_id") == store_id)
        stores = stores.join(names, F.col("s_nationkey") == F.col("n_nationkey"), "left_semi")
    if dept_id is not None:
        items = items.where(F.col("dept_id") == dept_id)
        lines = lines.join(items, F.col("l_partkey") == F.col("p_partkey"), "left_semi")
    lines = lines.select("l_partkey", "l_suppkey", "l_shipdate", "l_quantity")
    daily = (
        measured_join(lines, stores, ["l_suppkey"], ["l_partkey", "l_shipdate"], plain_rows=plain_rows)
        .groupBy("l_partkey", "s_nationkey", F.to_date("l_shipdate").alias("day"))
        .agg(F.sum("l_quantity").alias("units"))
        .join(names, F.col("s_nationkey") == F.col("n_nationkey"))
    )
    day = F.col("day")
    dn = F.datediff(day, F.lit(DAY_ZERO))
    no_forecast = (F.col("l_partkey") + F.col("dn")) % 11 == 0
    return (
        daily.join(items, F.col("l_partkey") == F.col("p_partkey"))
        .withColumn("dn", dn)
        .select(
            F.year(day).alias("year"),
            F.month(day).alias("month"),
            "dn",
            (F.weekday(day) + 1).alias("wday"),
            F.when(F.dayofmonth(day) <= 10, 1).otherwise(0).alias("snap"),
            "dept_id",
            F.col("l_partkey").cast("string").alias("item_id"),
            "store_id",
            F.when(F.col("dn") <= HISTORY_END, F.col("units")).alias("sales"),
            F.when(F.month(day) == 12, 1).otherwise(0).alias("flag_ram"),
            F.when(~no_forecast, (F.col("l_partkey") % 50 - 5).cast("double")).alias("Sales_Pred"),
        )
    )


def labelled_panel(spark: SparkSession, sf_dir: str, **days) -> DataFrame:
    """Panel with ``label``, the copy of ``sales`` that models train on."""
    return sales_panel(spark, sf_dir, **days).withColumn("label", F.col("sales"))


def known_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows with known sales; the scan reads the history days only."""
    return labelled_panel(spark, sf_dir, last_day=HISTORY_END).where(F.col("label").isNotNull())


def rows_to_predict(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled rows without sales; the scan reads the days after the history only."""
    return labelled_panel(spark, sf_dir, first_day=HISTORY_END + 1).where(F.col("label").isNull())


def rated_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mixed-type table with missing values: documents with the ratings some of them have."""
    documents = read_named(spark, sf_dir, "documents").select("doc_id", "lang", "source", "n_chars")
    return documents.join(read_named(spark, sf_dir, "labels"), "doc_id", "left")
