"""Models on codes of factors against Spark's on the vectors they stand for."""

import numpy as np
import pytest
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import functions as F, types as T

from shelfcast.operators import factored, training
from shelfcast.operators.factored import FactoredRegressor, Table
from shelfcast.operators.store import ModelStore
from shelfcast.plans import QUERIES, shared


@pytest.fixture(scope="module")
def sides(spark):
    """Rows as codes and as vectors, and the tables: three kinds and forty days, the inputs
    of the days beside and between those of the kinds."""
    kinds = Table(np.eye(3)[:, :2], np.array([1, 3]))
    days = Table(np.array([[float(d), 2000.0 + d // 10, float(d % 7 == 0)] for d in range(40)]), np.array([0, 2, 4]))
    draw = np.random.default_rng(3)
    rows = []
    for i in range(3000):
        kind, day = int(draw.integers(3)), int(draw.integers(39))
        vector = np.zeros(5)
        vector[kinds.slots], vector[days.slots] = kinds.values[kind], days.values[day]
        label = float(draw.poisson(3 + 2 * kind + 0.1 * day + 2 * (day % 7 == 0)))
        rows.append((i, [kind, day], Vectors.dense(vector), label, float(1 + i % 3)))
    schema = T.StructType.fromDDL("id int, codes array<int>, label double, weight double")
    schema = T.StructType([*schema[:2], T.StructField("vector", VectorUDT()), *schema[2:]])
    table = spark.createDataFrame(rows, schema).persist()
    own = [table.select("id", F.col(c).alias("features"), "label", "weight") for c in ("codes", "vector")]
    yield own[0], own[1], [kinds, days]
    table.unpersist()


def predictions(model, rows):
    return [r["prediction"] for r in model.transform(rows).orderBy("id").collect()]


@pytest.mark.parametrize("family, link", [("gaussian", "identity"), ("poisson", "identity"), ("poisson", "log")])
@pytest.mark.parametrize("penalty, intercept", [(0.0, True), (0.1, False)])
def test_linear_models_equal_those_of_spark(sides, family, link, penalty, intercept):
    codes, vectors, tables = sides
    like = GeneralizedLinearRegression(
        family=family, link=link, regParam=penalty, fitIntercept=intercept, weightCol="weight"
    )
    found, wanted = FactoredRegressor(like, tables).fit(codes), like.fit(vectors)
    assert found.parameters()["coefficients"] == pytest.approx(list(wanted.coefficients), rel=1e-4, abs=1e-5)
    assert found.parameters()["intercept"] == pytest.approx(wanted.intercept, rel=1e-4, abs=1e-5)
    assert predictions(found, codes) == pytest.approx(predictions(wanted, vectors), rel=1e-5)


@pytest.mark.parametrize("bins, depth, weighed", [(32, 5, False), (16, 4, True), (32, 10, False)])
def test_boosted_trees_equal_those_of_spark(sides, bins, depth, weighed):
    codes, vectors, tables = sides
    like = GBTRegressor(maxIter=3, maxBins=bins, maxDepth=depth, seed=1)
    if weighed:
        like.setWeightCol("weight")
    found = predictions(FactoredRegressor(like, tables).fit(codes), codes)
    assert found == pytest.approx(predictions(like.fit(vectors), vectors), rel=1e-9)
    assert len(set(found)) > 10


def test_blocks_and_tasks_change_nothing(sides, monkeypatch):
    codes, _, tables = sides
    for like in (GBTRegressor(maxIter=3), GeneralizedLinearRegression(family="poisson", link="log")):
        one = predictions(FactoredRegressor(like, tables).fit(codes.coalesce(1)), codes)
        monkeypatch.setattr(factored, "BLOCK_ROWS", 7)
        many = predictions(FactoredRegressor(like, tables).fit(codes.repartition(5).union(codes.limit(0))), codes)
        monkeypatch.undo()
        assert many == pytest.approx(one, rel=1e-9)


def test_other_models_are_refused(sides):
    codes, _, tables = sides
    for like in (GeneralizedLinearRegression(family="gamma", link="log"), GBTRegressor(subsamplingRate=0.5)):
        with pytest.raises(ValueError, match="factored"):
            FactoredRegressor(like, tables).fit(codes)


def test_a_search_runs_on_codes_and_its_model_is_stored(spark, sides, tmp_path):
    codes, vectors, tables = sides
    store = ModelStore(spark, str(tmp_path))
    keyed = training.with_search_part(codes, ["id"])
    trees = training.Candidate("trees", "", GBTRegressor(maxIter=2, seed=1), {"maxDepth": [2, 3]})
    for each in (training.standard_candidates()[0], trees):
        wanted = dict((tuple(p.values()), s) for p, s in training.search_scores(each, training.with_search_part(vectors, ["id"]).drop("weight")))
        own = training.Candidate(each.model_id, "", FactoredRegressor(each.estimator, tables), each.tried)
        found = dict((tuple(p.values()), s) for p, s in training.search_scores(own, keyed.drop("weight")))
        assert found == {point: pytest.approx(score, rel=1e-5) for point, score in wanted.items()}
        model = own.estimator.fit(codes)
        store.save(model, own.model_id)
        assert predictions(store.load(own.model_id), codes) == predictions(model, codes)


MODEL_QUERIES = ["glr_gaussian", "glr_poisson_log_equations", "gbt_regression", "gbt_holdout_rmse", "leaderboard"]


@pytest.mark.parametrize("name", MODEL_QUERIES)
def test_models_on_all_inputs_make_no_vector_per_row(spark, monkeypatch, name):
    monkeypatch.setattr(shared, "prepared_panel", lambda *a, **k: pytest.fail("vectors of all rows"))
    monkeypatch.setattr(GBTRegressor, "_fit", lambda *a: pytest.fail("dense rows"))
    rows = QUERIES[name](spark, "/root/testdata/sf0.001").collect()
    assert rows and all(r["state"] == "OK" for r in rows if name == "leaderboard")


def test_codes_stand_for_the_prepared_vectors(spark):
    """Inputs of the tables are those of the encoder, in its places."""
    sf_dir = "/root/testdata/sf0.001"
    panel = shared.stored_panel(spark, sf_dir)
    factors = shared.FactoredPanel(panel)
    for base_slot in (True, False):
        tables = factors.tables(base_slot)
        wanted = {(r["item_id"], r["store_id"], r["dn"]): r["features"].toArray() for r in shared.stored_prepared_panel(spark, sf_dir, base_slot).collect()}
        rows = factors.coded(factors.with_slot(panel)).collect()
        assert len(rows) == len(wanted)
        for r in rows:
            vector = np.zeros(factored.width(tables))
            for table, code in zip(tables, r["features"]):
                vector[table.slots] = table.values[code]
            assert (vector == wanted[r["item_id"], r["store_id"], r["dn"]]).all()
