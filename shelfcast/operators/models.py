"""Small model builders shared by the queries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import LinearRegression
from pyspark.sql import DataFrame


def linear(inputs: Sequence[str], estimator: Estimator | None = None) -> Pipeline:
    """A regression on plain numeric columns."""
    assembler = VectorAssembler(inputCols=list(inputs), outputCol="features")
    return Pipeline(stages=[assembler, estimator or LinearRegression()])


def fitted_line(train: DataFrame, column: str) -> PipelineModel:
    """Least squares line of ``label`` on one column; one aggregation pass."""
    return linear([column], LinearRegression(solver="normal")).fit(train)


def predicted_unknown(model: Transformer, panel: DataFrame) -> DataFrame:
    """Predictions for the rows without a label."""
    return model.transform(panel.where("label is null"))
