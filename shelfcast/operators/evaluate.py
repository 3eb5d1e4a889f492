"""Scores of predictions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.functions.columns import squared_error


def rmse_of(predicted: str = "prediction", actual: str = "label") -> Column:
    """Root mean squared error as an aggregate."""
    return F.sqrt(F.avg(squared_error(predicted, actual)))


def accuracy_of(predicted: str = "prediction", actual: str = "label") -> Column:
    """Share of rows predicted exactly, as an aggregate."""
    return F.avg((F.col(predicted) == F.col(actual)).cast("double"))


def condensed_rmse() -> Column:
    """``rmse_of`` over condensed rows (see ``training.condensed``), which stand for ``weight``
    rows each, about whose mean label these have the squares ``spread``."""
    squares = F.col("weight") * squared_error("prediction", "label") + F.col("spread")
    return F.sqrt(F.sum(squares) / F.sum("weight"))


def rmse(predictions: DataFrame) -> float | None:
    """The error over rows, or over condensed rows."""
    if "weight" in predictions.columns:
        return predictions.agg(condensed_rmse()).first()[0]
    return predictions.agg(rmse_of()).first()[0]


def accuracy(predictions: DataFrame) -> float | None:
    return predictions.agg(accuracy_of()).first()[0]
