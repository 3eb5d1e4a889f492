"""Queries for scans and sinks: what is written to the shared folder is read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import aggregate, forecast
from shelfcast.plans.forecasts import _both_sql, submission_matrix
from shelfcast.plans.registry import PANEL_FIELDS, over_panel, over_rated, register
from shelfcast.plans.totals import TOP_CELLS_SQL
from shelfcast.scratch import fresh_path
from shelfcast.sources import scans, sinks
from shelfcast.sources.panel import HISTORY_END, known_rows, labelled_panel, rated_documents, sales_panel
from shelfcast.sources.schema import LABELLED_SCHEMA, PANEL_SCHEMA, numbered_names

# The wide table has a column for every day of the history; fixed value: the columns that
# the two readers of a part of it select.
FIRST_DAY, LAST_DAY = 1, HISTORY_END
SELECTED_DAYS = (1, 15)


def _panel_csv(spark, sf_dir) -> str:
    path = fresh_path(spark, "panel-csv")
    sinks.write_csv(sales_panel(spark, sf_dir), path)
    return path


@register("scan_csv_typed", over_panel(f" SELECT {PANEL_FIELDS} FROM panel"))
def scan_csv_typed(spark, sf_dir):
    return scans.read_csv_typed(spark, _panel_csv(spark, sf_dir), PANEL_SCHEMA)


@register(
    "scan_csv_strings",
    over_panel(
        " SELECT "
        + ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in PANEL_FIELDS.split(", "))
        + " FROM panel"
    ),
)
def scan_csv_strings(spark, sf_dir):
    return scans.read_csv_strings(spark, _panel_csv(spark, sf_dir))


@register(
    "scan_csv_semicolon",
    over_rated(
        """ SELECT CAST(doc_id AS INTEGER) AS doc_id, lang, source, CAST(n_chars AS INTEGER) AS n_chars, quality, toxic
        FROM rated"""
    ),
)
def scan_csv_semicolon(spark, sf_dir):
    path = fresh_path(spark, "rated-csv")
    sinks.write_csv(rated_documents(spark, sf_dir), path, sep=";")
    return scans.read_csv_inferred(spark, path, sep=";")


@register(
    "scan_csv_inferred",
    """SELECT CAST(p_partkey AS INTEGER) AS p_partkey, p_name, p_brand, p_type, p_size, p_retailprice
       FROM part""",
)
def scan_csv_inferred(spark, sf_dir):
    path = fresh_path(spark, "part-csv")
    sinks.write_csv(scans.read_named(spark, sf_dir, "part"), path)
    return scans.read_csv_inferred(spark, path)


@register(
    "scan_parquet",
    "SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem",
)
def scan_parquet(spark, sf_dir):
    lines = scans.read_named(spark, sf_dir, "lineitem")
    return lines.select("l_orderkey", "l_linenumber", "l_quantity")


@register("scan_typed_contract", over_panel(f" SELECT {PANEL_FIELDS}, label FROM panel"))
def scan_typed_contract(spark, sf_dir):
    path = fresh_path(spark, "panel-wider")
    wider = labelled_panel(spark, sf_dir).withColumns(
        {"dn": F.col("dn").cast("bigint"), "not_in_contract": F.lit(1)}
    )
    sinks.write_parquet(wider, path)
    return scans.read_contract(spark, path, LABELLED_SCHEMA)


@register("filter_even_orders", "SELECT l_orderkey AS n FROM lineitem WHERE l_orderkey % 2 = 0")
def filter_even_orders(spark, sf_dir):
    lines = scans.read_named(spark, sf_dir, "lineitem")
    return lines.where(F.col("l_orderkey") % 2 == 0).select(F.col("l_orderkey").alias("n"))


@register("sink_parquet_roundtrip", over_panel(f" SELECT {PANEL_FIELDS}, label FROM panel"))
def sink_parquet_roundtrip(spark, sf_dir):
    path = fresh_path(spark, "panel")
    sinks.write_parquet(labelled_panel(spark, sf_dir), path)
    return spark.read.parquet(path)


@register("sink_csv_roundtrip", over_panel(" " + _both_sql("Sales_Pred", "panel")))
def sink_csv_roundtrip(spark, sf_dir):
    table = submission_matrix(spark, sf_dir)
    path = fresh_path(spark, "submission-csv")
    sinks.write_csv(table, path)
    return scans.read_csv_typed(spark, path, table.schema)


@register("materialize_once", over_panel(f"{TOP_CELLS_SQL} SELECT * FROM cells"))
def materialize_once(spark, sf_dir):
    path = fresh_path(spark, "top-cells")
    sinks.materialize_once(spark, path, lambda: aggregate.top_cells(known_rows(spark, sf_dir)))

    def must_not_build():
        raise RuntimeError("the stored table was not found")

    return sinks.materialize_once(spark, path, must_not_build)


def _wide_csv(spark, sf_dir) -> str:
    """One row per item and store, one column per day of the history, as CSV.

    A line is a hundred times as long as the rows it is made of. By their bytes Spark would
    put them together into a few partitions, and so into few files that few tasks can read.
    """
    keys = ["item_id", "store_id", "dept_id"]
    dealt = known_rows(spark, sf_dir).repartition(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys)
    vectors = forecast.day_vectors(dealt, keys, "dn", "sales")
    path = fresh_path(spark, "wide-csv")
    names, lines = forecast.wide_lines(vectors, FIRST_DAY, LAST_DAY)
    sinks.write_csv_lines(lines, names, path)
    return path


_WIDE_SQL = ", ".join(
    f"CAST(SUM(sales) FILTER (WHERE dn = {d}) AS VARCHAR) AS d_{d}"
    for d in range(SELECTED_DAYS[0], SELECTED_DAYS[1] + 1)
)
_WIDE_ROWS = "FROM panel WHERE sales IS NOT NULL GROUP BY item_id, store_id"


@register("wide_day_columns", over_panel(f" SELECT item_id, store_id, {_WIDE_SQL} {_WIDE_ROWS}"))
def wide_day_columns(spark, sf_dir):
    wide = scans.read_csv_strings(spark, _wide_csv(spark, sf_dir))
    return wide.select("item_id", "store_id", *numbered_names("d_", *SELECTED_DAYS))


@register(
    "wide_day_totals",
    over_panel(
        f""" SELECT item_id, store_id, sum(sales) AS units, CAST(count(*) AS INTEGER) AS n_days,
        min(dn) AS first_day, max(dn) AS last_day, CAST({HISTORY_END} AS INTEGER) AS n_columns {_WIDE_ROWS}"""
    ),
)
def wide_day_totals(spark, sf_dir):
    """Every day column of the wide file, read back and added up."""
    days = numbered_names("d_", FIRST_DAY, LAST_DAY)
    wide = scans.read_csv_strings(spark, _wide_csv(spark, sf_dir), packed=days)
    sold = F.transform(
        "cells", lambda e: F.struct((e["at"] + FIRST_DAY).alias("day"), e["value"].cast("double").alias("units"))
    )
    numbers = wide.select("item_id", "store_id", F.lit(len(days)).alias("n_columns"), sold.alias("sold"))
    return numbers.select(
        "item_id",
        "store_id",
        F.aggregate("sold", F.lit(0.0), lambda a, e: a + e["units"]).alias("units"),
        F.size("sold").alias("n_days"),
        F.array_min(F.col("sold")["day"]).alias("first_day"),
        F.array_max(F.col("sold")["day"]).alias("last_day"),
        "n_columns",
    )


@register(
    "sort_hidden_columns",
    over_panel(
        f""" SELECT {', '.join(f'd_{d}' for d in range(SELECTED_DAYS[0], SELECTED_DAYS[1] + 1))}
        FROM (SELECT item_id, store_id, {_WIDE_SQL} {_WIDE_ROWS})
        ORDER BY item_id, store_id"""
    ),
)
def sort_hidden_columns(spark, sf_dir):
    wide = scans.read_csv_strings(spark, _wide_csv(spark, sf_dir))
    return wide.select(numbered_names("d_", *SELECTED_DAYS)).orderBy("item_id", "store_id")
