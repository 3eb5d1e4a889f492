"""Queries for counts, grouped sums and column summaries."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.functions.columns import box_labels, scaled_class
from shelfcast.operators import aggregate
from shelfcast.operators.boxstats import QUARTILES, quantiles, value_counts
from shelfcast.operators.evaluate import accuracy_of, rmse_of
from shelfcast.plans.registry import over_panel, over_rated, register
from shelfcast.plans.shared import stored_top_cells
from shelfcast.sources.panel import known_rows, labelled_panel, rated_documents, sales_panel
from shelfcast.sources.scans import read_named


@register(
    "count_rows",
    over_panel(" SELECT count(*) AS n_rows, CAST(12 AS INTEGER) AS n_columns FROM panel"),
)
def count_rows(spark, sf_dir):
    return aggregate.shape(labelled_panel(spark, sf_dir))


TOP_CELLS_SQL = """, cells AS (
  SELECT year, month, wday, store_id, snap, flag_ram, dept_id, SUM(label) AS sum_label
  FROM panel WHERE label IS NOT NULL
  GROUP BY year, month, wday, store_id, snap, flag_ram, dept_id
)"""


@register("sum_top_cells", over_panel(f"{TOP_CELLS_SQL} SELECT * FROM cells"))
def sum_top_cells(spark, sf_dir):
    return aggregate.top_cells(known_rows(spark, sf_dir))


@register(
    "sum_sq_error_by_key",
    over_panel(
        """ SELECT store_id, dept_id, year,
        SUM(CASE WHEN Sales_Pred IS NULL THEN 0.0 ELSE pow(Sales_Pred - COALESCE(sales, 0), 2) END) AS sum_sq_error
        FROM panel GROUP BY store_id, dept_id, year"""
    ),
)
def sum_sq_error_by_key(spark, sf_dir):
    return aggregate.squared_error_by_key(sales_panel(spark, sf_dir))


@register(
    "collect_values_by_key",
    over_panel(
        f"""{TOP_CELLS_SQL} SELECT lpad(CAST(month AS VARCHAR), 2, '0') AS key, sum_label AS value, count(*) AS copies
        FROM cells GROUP BY 1, 2"""
    ),
)
def collect_values_by_key(spark, sf_dir):
    cells = stored_top_cells(spark, sf_dir).withColumn("key", box_labels()["month"])
    return aggregate.value_lists(cells, "key", "sum_label")


@register(
    "key_labels",
    over_panel(
        f"""{TOP_CELLS_SQL} SELECT lpad(CAST(month AS VARCHAR), 2, '0') AS k_month,
        lpad(CAST(year AS VARCHAR), 4, '0') AS k_year, store_id || ' ' || snap AS k_store_snap,
        store_id || ' ' || flag_ram AS k_store_ram, store_id AS k_store,
        lpad(CAST(wday AS VARCHAR), 2, '0') AS k_wday, dept_id AS k_dept,
        dept_id || ' ' || snap AS k_dept_snap, dept_id || ' ' || flag_ram AS k_dept_ram, sum_label
        FROM cells"""
    ),
)
def key_labels(spark, sf_dir):
    cells = stored_top_cells(spark, sf_dir)
    return cells.select(*[c.alias(f"k_{name}") for name, c in box_labels().items()], "sum_label")


def _described(column: str) -> str:
    return f"""SELECT '{column}' AS column_name, count({column}) AS n, round(avg({column}), 6) AS mean,
      round(stddev_samp({column}), 6) AS stddev, CAST(min({column}) AS DOUBLE) AS min,
      CAST(max({column}) AS DOUBLE) AS max FROM panel"""


@register(
    "describe_columns",
    over_panel(
        " SELECT * FROM ("
        + " UNION ALL ".join(
            _described(c)
            for c in ["year", "month", "dn", "wday", "snap", "sales", "flag_ram", "Sales_Pred", "label"]
        )
        + ")"
    ),
)
def describe_columns(spark, sf_dir):
    numbers = aggregate.describe_numbers(labelled_panel(spark, sf_dir))
    return numbers.withColumns({c: F.round(c, 6) for c in ("mean", "stddev")})


@register(
    "describe_texts",
    over_panel(
        " SELECT * FROM ("
        + " UNION ALL ".join(
            f"SELECT '{c}' AS column_name, count({c}) AS n, min({c}) AS min_text, max({c}) AS max_text FROM panel"
            for c in ["dept_id", "item_id", "store_id"]
        )
        + ")"
    ),
)
def describe_texts(spark, sf_dir):
    return aggregate.describe_texts(labelled_panel(spark, sf_dir))


@register(
    "describe_quartiles",
    """SELECT p_brand, round(quantile_cont(c, 0.25), 6) AS q0, round(quantile_cont(c, 0.5), 6) AS q1,
              round(quantile_cont(c, 0.75), 6) AS q2
       FROM (SELECT p_brand, CAST(trunc(p_retailprice * 10) AS DOUBLE) AS c FROM part) GROUP BY p_brand""",
)
def describe_quartiles(spark, sf_dir):
    classes = read_named(spark, sf_dir, "part").select(
        "p_brand", scaled_class("p_retailprice").alias("price_class")
    )
    found = quantiles(value_counts(classes, ["p_brand"], "price_class"), ["p_brand"], QUARTILES)
    return found.select("p_brand", *[F.round(c, 6).alias(c) for c in ("q0", "q1", "q2")])


@register(
    "rmse_overall",
    over_panel(
        """ SELECT round(sqrt(avg(pow(Sales_Pred - sales, 2))), 6) AS rmse, count(*) AS n_rows
        FROM panel WHERE sales IS NOT NULL"""
    ),
)
def rmse_overall(spark, sf_dir):
    known = known_rows(spark, sf_dir)
    return known.agg(F.round(rmse_of("Sales_Pred", "sales"), 6).alias("rmse"), F.count("*").alias("n_rows"))


@register(
    "accuracy_overall",
    over_rated(
        """ SELECT round(avg(CASE WHEN quality = CAST(n_chars > 1000 AS INTEGER) THEN 1.0 ELSE 0.0 END), 6) AS accuracy
        FROM rated WHERE quality IS NOT NULL"""
    ),
)
def accuracy_overall(spark, sf_dir):
    rated = rated_documents(spark, sf_dir).where(F.col("quality").isNotNull())
    guessed = rated.withColumn("guess", (F.col("n_chars") > 1000).cast("int"))
    return guessed.agg(F.round(accuracy_of("guess", "quality"), 6).alias("accuracy"))
