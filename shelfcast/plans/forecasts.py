"""Queries for forecast tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from shelfcast.operators import clean, forecast
from shelfcast.operators.models import fitted_line
from shelfcast.operators.sampling import train_and_test
from shelfcast.operators.store import ModelStore
from shelfcast.plans.registry import (
    EVALUATION_CUT,
    HELD_OUT_SQL,
    PANEL_KEY,
    VALIDATION_CUT,
    over_panel,
    register,
)
from shelfcast.plans.shared import stored_panel
from shelfcast.scratch import fresh_path
from shelfcast.sources.panel import rows_to_predict, sales_panel

VALIDATION = forecast.Horizon("validation", VALIDATION_CUT)
EVALUATION = forecast.Horizon("evaluation", EVALUATION_CUT)
LAST_DAY = EVALUATION_CUT + forecast.DAYS


def delivered_predictions(spark, sf_dir):
    """Rows to predict with the prediction that came with them."""
    return rows_to_predict(spark, sf_dir).select(
        "dn", "item_id", "store_id", F.col("Sales_Pred").alias("prediction")
    )


def _matrix_sql(horizon: forecast.Horizon, prediction: str, source: str) -> str:
    days = ", ".join(
        f"CAST(SUM(ipred) FILTER (WHERE dn = {horizon.cut + d}) AS BIGINT) AS F{d}"
        for d in range(1, forecast.DAYS + 1)
    )
    return f"""SELECT item_id || '_' || store_id || '_{horizon.suffix}' AS id, {days}
      FROM (SELECT *, CAST(CASE WHEN trunc({prediction}) < 0 THEN 0 ELSE trunc({prediction}) END AS INTEGER) AS ipred
            FROM {source} WHERE label IS NULL AND dn > {horizon.cut} AND dn <= {horizon.cut + forecast.DAYS})
      GROUP BY item_id, store_id"""


def _both_sql(prediction: str, source: str) -> str:
    return f"""SELECT * FROM ({_matrix_sql(VALIDATION, prediction, source)}
      UNION ALL {_matrix_sql(EVALUATION, prediction, source)})"""


@register("pivot_validation", over_panel(" " + _matrix_sql(VALIDATION, "Sales_Pred", "panel")))
def pivot_validation(spark, sf_dir):
    return forecast.horizon_matrix(delivered_predictions(spark, sf_dir), VALIDATION, LAST_DAY)


@register("pivot_evaluation", over_panel(" " + _matrix_sql(EVALUATION, "Sales_Pred", "panel")))
def pivot_evaluation(spark, sf_dir):
    return forecast.horizon_matrix(delivered_predictions(spark, sf_dir), EVALUATION, LAST_DAY)


@register("submission_matrix", over_panel(" " + _both_sql("Sales_Pred", "panel")))
def submission_matrix(spark, sf_dir):
    return forecast.forecast_table(delivered_predictions(spark, sf_dir), [VALIDATION, EVALUATION])


@register("union_horizons", over_panel(" " + _both_sql("Sales_Pred", "panel")))
def union_horizons(spark, sf_dir):
    predictions = delivered_predictions(spark, sf_dir)
    tables = [forecast.horizon_matrix(predictions, h, LAST_DAY) for h in (VALIDATION, EVALUATION)]
    return forecast.union_tables(tables).orderBy(F.col("id").endswith(f"_{EVALUATION.suffix}"), "id")


@register(
    "pivot_two_keys",
    over_panel(
        " SELECT item_id, store_id, "
        + ", ".join(f"SUM(Sales_Pred) FILTER (WHERE wday = {d}) AS F{d}" for d in range(1, 8))
        + " FROM panel GROUP BY item_id, store_id"
    ),
)
def pivot_two_keys(spark, sf_dir):
    return forecast.day_matrix(
        sales_panel(spark, sf_dir), ["item_id", "store_id"], "wday", "Sales_Pred", range(1, 8)
    )


@register(
    "submission_from_model",
    over_panel(
        f""", fit AS (
          SELECT regr_intercept(label, dn) AS a, regr_slope(label, dn) AS b FROM panel
          WHERE label IS NOT NULL AND NOT ({HELD_OUT_SQL})
        ), predicted AS (SELECT panel.*, a + b * dn AS prediction FROM panel, fit) """
        + _both_sql("prediction", "predicted")
    ),
)
def submission_from_model(spark, sf_dir):
    panel = stored_panel(spark, sf_dir)
    train, _ = train_and_test(clean.known(panel), PANEL_KEY)
    store = ModelStore(spark, fresh_path(spark, "models"))
    store.save(fitted_line(train.select("dn", "label"), "dn"), "line")
    predictions = store.load("line").transform(clean.to_predict(panel))
    return forecast.forecast_table(
        predictions.select("dn", "item_id", "store_id", "prediction"), [VALIDATION, EVALUATION]
    )
