"""Queries for the box statistics of the nine groupings."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.columns import box_labels
from shelfcast.operators.boxstats import box_groupings, box_statistics
from shelfcast.plans.registry import over_panel, register
from shelfcast.plans.shared import stored_top_cells
from shelfcast.plans.totals import TOP_CELLS_SQL
from shelfcast.sources.panel import known_rows, rows_to_predict

# SQL twins of the grouping labels.
LABEL_SQL = {
    "month": "lpad(CAST(month AS VARCHAR), 2, '0')",
    "year": "lpad(CAST(year AS VARCHAR), 4, '0')",
    "store_snap": "store_id || ' ' || snap",
    "store_ram": "store_id || ' ' || flag_ram",
    "store": "store_id",
    "wday": "lpad(CAST(wday AS VARCHAR), 2, '0')",
    "dept": "dept_id",
    "dept_snap": "dept_id || ' ' || snap",
    "dept_ram": "dept_id || ' ' || flag_ram",
}


def box_sql(rows: str, keys: str) -> str:
    """Box statistics in SQL over a SELECT with the key columns and ``v``."""
    return f""", vals AS ({rows}),
    boxes AS (
      SELECT {keys}, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS median,
             quantile_cont(v, 0.75) AS q3 FROM vals GROUP BY {keys}
    ),
    judged AS (
      SELECT vals.*, q1, median, q3,
             v BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1) AS inside
      FROM vals JOIN boxes USING ({keys})
    )
    SELECT {keys}, count(*) AS n_values, max(q1) AS q1, max(median) AS median, max(q3) AS q3,
           min(v) FILTER (WHERE inside) AS whisker_low, max(v) FILTER (WHERE inside) AS whisker_high,
           count(*) FILTER (WHERE NOT inside) AS n_outliers
    FROM judged GROUP BY {keys}"""


def _register(grouping: str) -> None:
    rows = f"SELECT {LABEL_SQL[grouping]} AS key, CAST(sum_label AS DOUBLE) AS v FROM cells"

    @register(f"box_by_{grouping}", over_panel(TOP_CELLS_SQL + box_sql(rows, "key")))
    def query(spark, sf_dir):
        cells = stored_top_cells(spark, sf_dir).select(
            box_labels()[grouping].alias("key"), "sum_label"
        )
        return box_statistics(cells, ["key"], "sum_label").orderBy("key")


for _grouping in LABEL_SQL:
    _register(_grouping)


_ALL_ROWS = " UNION ALL ".join(
    f"SELECT '{name}' AS grouping_name, {label} AS key, CAST(sum_label AS DOUBLE) AS v FROM cells"
    for name, label in LABEL_SQL.items()
)


@register("box_all_groupings", over_panel(TOP_CELLS_SQL + box_sql(_ALL_ROWS, "grouping_name, key")))
def box_all_groupings(spark, sf_dir):
    boxes = box_groupings(stored_top_cells(spark, sf_dir), box_labels(), "sum_label")
    return boxes.withColumnRenamed("grouping", "grouping_name").orderBy("grouping_name", F.col("key"))


@register(
    "box_predicted_and_known",
    over_panel(
        box_sql(
            """SELECT 'known' AS key, sales AS v FROM panel WHERE label IS NOT NULL UNION ALL
            SELECT 'predicted', Sales_Pred FROM panel WHERE label IS NULL AND Sales_Pred IS NOT NULL""",
            "key",
        )
    ),
)
def box_predicted_and_known(spark, sf_dir):
    known = known_rows(spark, sf_dir).select(F.lit("known").alias("key"), F.col("sales").alias("v"))
    predicted = rows_to_predict(spark, sf_dir).select(
        F.lit("predicted").alias("key"), F.col("Sales_Pred").alias("v")
    )
    return box_statistics(known.unionByName(predicted), ["key"], "v").orderBy("key")
