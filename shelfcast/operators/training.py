"""Candidate models, training with and without a parameter search, leaderboard."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.ml import Estimator
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from shelfcast.operators.evaluate import rmse
from shelfcast.operators.sampling import SPLIT_SEED
from shelfcast.operators.store import ModelStore

# Fixed value: first hash byte (as hex) of the rows a search validates on; 205 of 256
# bytes, about 80 %, lie below it.
SEARCH_VALIDATE_FROM = "cd"

LEADERBOARD_SCHEMA = T.StructType(
    [
        T.StructField("model_id", T.StringType()),
        T.StructField("description", T.StringType()),
        T.StructField("rmse", T.DoubleType()),
        T.StructField("state", T.StringType()),
        T.StructField("message", T.StringType()),
    ]
)


# What the searches try, by parameter name.
LINEAR_GRID = {"regParam": [0.1, 0.01], "fitIntercept": [False, True]}
TREE_GRID = {"maxBins": [16, 32], "maxDepth": [5, 10]}


@dataclass(frozen=True)
class Candidate:
    """An estimator with its name in the leaderboard and the values its search tries, by
    parameter name; without values only its own parameters are tried."""

    model_id: str
    description: str
    estimator: Estimator
    tried: Mapping[str, Sequence] = field(default_factory=dict)

    def points(self) -> list[dict]:
        """Every combination of the tried values."""
        params = [self.estimator.getParam(name) for name in self.tried]
        return [dict(zip(params, values)) for values in product(*self.tried.values())]


@dataclass(frozen=True)
class Trained:
    """Outcome of one training; a failed one has no model and no score."""

    candidate: Candidate
    rmse: float | None
    state: str
    message: str | None = None
    model: Any = None


def standard_candidates() -> list[Candidate]:
    # Families, links and ids.
    return [
        Candidate("glrgi", "glr gaussian identity", GeneralizedLinearRegression(family="gaussian", link="identity"), LINEAR_GRID),
        Candidate("glrpi", "glr poisson identity", GeneralizedLinearRegression(family="poisson", link="identity"), LINEAR_GRID),
        Candidate("glrpl", "glr poisson log", GeneralizedLinearRegression(family="poisson", link="log"), LINEAR_GRID),
        Candidate("gbtr", "gradient boost regressor", GBTRegressor(seed=SPLIT_SEED), TREE_GRID),
    ]


def fit_persisted(estimator: Estimator, train: DataFrame):
    """Fit on rows kept for the passes of an iterative estimator; what a lost executor held
    is read again."""
    train = train.persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return estimator.fit(train)
    finally:
        train.unpersist()


def with_search_part(train: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Add ``search_part``: ``fit`` or ``validate``, by a hash of the row's key.

    The part goes with the row, so a task that runs again puts it on the same side; an
    unwritten random split can move it.
    """
    named = F.md5(F.concat_ws("|", F.lit("search"), *[F.col(k).cast("string") for k in keys]))
    is_fit = F.substring(named, 1, 2) < SEARCH_VALIDATE_FROM
    return train.withColumn("search_part", F.when(is_fit, "fit").otherwise("validate"))


def condensed(rows: DataFrame, inputs: Sequence[str]) -> DataFrame:
    """One row per combination of ``inputs``: ``weight`` (rows), their mean ``label`` and the
    sum of its squared deviations, ``spread``.

    Rows of equal inputs have equal predictions. Squared loss and the likelihoods of the
    linear models depend on their labels through count and mean only, so a weighted fit on
    condensed rows finds the same model, in passes that do not grow with the rows.
    """
    return rows.groupBy(*inputs).agg(
        F.count("*").cast("double").alias("weight"),
        F.avg("label").alias("label"),
        (F.var_pop("label") * F.count("*")).alias("spread"),
    )


def _fitted(estimator: Estimator, train: DataFrame, point: dict | None = None):
    params = dict(point or {})
    if "weight" in train.columns:
        params[estimator.getParam("weightCol")] = "weight"
    return estimator.fit(train, params)


def search_scores(candidate: Candidate, train: DataFrame, parallelism: int = 4) -> list[tuple[dict, float]]:
    """Every point of the candidate's grid with its error on the validation rows."""
    fit_rows = train.where(F.col("search_part") == "fit").drop("search_part")
    validate = train.where(F.col("search_part") == "validate").drop("search_part")

    def score(point: dict) -> tuple[dict, float]:
        model = _fitted(candidate.estimator, fit_rows, point)
        return point, rmse(model.transform(validate))

    pool = ThreadPool(parallelism)
    try:
        return pool.map(inheritable_thread_target(train.sparkSession)(score), candidate.points())
    finally:
        pool.close()


def _fit(candidate: Candidate, train: DataFrame, searched: bool, parallelism: int):
    if not searched:
        return _fitted(candidate.estimator, train)
    best, _ = min(search_scores(candidate, train, parallelism), key=lambda found: found[1])
    return _fitted(candidate.estimator, train, best)


def train_one(
    candidate: Candidate,
    train: DataFrame,
    test: DataFrame,
    store: ModelStore | None = None,
    searched: bool = False,
    parallelism: int = 4,
) -> Trained:
    """Fit, score on the held-out rows and store. A failure becomes state ERROR."""
    try:
        model = _fit(candidate, train, searched, parallelism)
        score = rmse(model.transform(test))
        if store is not None:
            store.save(model, candidate.model_id)
        return Trained(candidate, score, "OK", model=model)
    except Exception as error:  # the other candidates go on
        return Trained(candidate, None, "ERROR", message=str(error).splitlines()[0])


def train_all(
    candidates: Sequence[Candidate],
    train: DataFrame,
    test: DataFrame,
    store: ModelStore | None = None,
    searched: bool = False,
    parallelism: int = 4,
) -> list[Trained]:
    """Train the candidates side by side on shared, persisted rows.

    A search needs the ``search_part`` of ``with_search_part`` in ``train``. Rows with a
    ``weight`` are condensed ones.
    """
    ids = [c.model_id for c in candidates]
    if len(set(ids)) < len(ids):
        raise ValueError(f"model ids must differ: {ids}")
    columns = ["features", "label", *(["weight", "spread"] if "weight" in train.columns else [])]
    train = train.select(*columns, *(["search_part"] if searched else [])).persist(StorageLevel.MEMORY_AND_DISK)
    test = test.select(*columns).persist(StorageLevel.MEMORY_AND_DISK)
    pool = ThreadPool(min(parallelism, len(candidates)))
    try:
        run = inheritable_thread_target(train.sparkSession)(
            lambda c: train_one(c, train, test, store, searched, parallelism)
        )
        return pool.map(run, candidates)
    finally:
        pool.close()
        train.unpersist()
        test.unpersist()


def leaderboard(spark: SparkSession, results: Sequence[Trained]) -> DataFrame:
    """One row per candidate, best first, failed ones last."""
    rows = [
        (r.candidate.model_id, r.candidate.description, r.rmse, r.state, r.message) for r in results
    ]
    return spark.createDataFrame(rows, LEADERBOARD_SCHEMA).orderBy(F.asc_nulls_last("rmse"), "model_id")
