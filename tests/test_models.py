"""Encoding, training, per-key models and the model store."""

from __future__ import annotations

import uuid

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
)
from pyspark.sql import functions as F

from shelfcast.functions.columns import padded_number
from shelfcast.operators import evaluate, encoding, forest, grouped, training
from shelfcast.operators.models import fitted_line, linear
from shelfcast.operators.sampling import with_part
from shelfcast.operators.store import ModelStore
from shelfcast.plans import QUERIES

# Seven rows to encode.
ROWS = [
    ("dummy 0", 0, "A", "X"),
    ("dummy 1", 1, "A", "X"),
    ("dummy 2", 2, "B", "Y"),
    ("dummy 3", 3, "A", "X"),
    ("dummy 4", 4, "D", "Y"),
    ("dummy 5", 5, "B", "X"),
    ("dummy 6", 6, "C", "Z"),
]
COLUMNS = ["dummy", "i", "avar", "xvar"]
FEATURES = {
    0: [1, 0, 0, 1, 0, 0],
    1: [1, 0, 0, 1, 0, 1],
    2: [0, 1, 0, 0, 1, 2],
    3: [1, 0, 0, 1, 0, 3],
    4: [0, 0, 0, 0, 1, 4],
    5: [0, 1, 0, 1, 0, 5],
    6: [0, 0, 1, 0, 0, 6],
}


def test_encoding(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    chain = encoding.encoder(["avar", "xvar"], ["vavar", "vxvar", "i"])
    done = encoding.encoded(chain.fit(df), df)
    assert done.columns == COLUMNS + ["features"]
    assert {r["i"]: list(r["features"].toArray()) for r in done.collect()} == FEATURES
    slots = encoding.active_slots(done, ["i"]).collect()
    assert {(r["i"], r["slot"], r["value"]) for r in slots} == {
        (i, s, float(v)) for i, row in FEATURES.items() for s, v in enumerate(row) if v
    }


def test_encoding_by_join(spark):
    df = spark.createDataFrame(ROWS, COLUMNS)
    hot = encoding.one_hot_by_join(df, ["i"], ["avar", "xvar"])
    joined = VectorAssembler(inputCols=["vavar", "vxvar", "i"], outputCol="features").transform(hot)
    assert {r["i"]: list(r["features"].toArray()) for r in joined.collect()} == FEATURES


@pytest.mark.parametrize("base_slot, slots", [(False, 64), (True, 63)])
def test_hashed_columns_mean_the_same_at_every_size(spark, base_slot, slots):
    def of(n):
        df = spark.range(n).select(
            padded_number("id", 6).alias("item"), (F.col("id") % 4).cast("string").alias("dept"), "id"
        )
        chain = encoding.encoder(
            ["item", "dept"], ["vitem", "vdept", "id"], hashed=["item"], hash_slots=64, base_slot=base_slot
        )
        model = chain.fit(df)
        done = encoding.encoded(model, df)
        assert encoding.vector_width(done).collect() == [(slots + 3 + 1, n)]
        names = [type(step).__name__ for step in model.stages]
        places = {r["id"]: r["slot"] for r in encoding.active_slots(done.where("id < 200"), ["id"]).where(f"slot < {slots}").collect()}
        return names, places

    assert of(200) == of(2000)


def test_prepared_panel_by_join_equals_the_fitted_chain(spark):
    rows = [(f"d{k % 3}", f"i{k % 7}", f"s{k % 2}", k % 5, k, 0, 1, 6, 2000) for k in range(60)]
    names = ["dept_id", "item_id", "store_id", "wday", "dn", "flag_ram", "snap", "month", "year"]
    df = spark.createDataFrame(rows, names)
    fitted = encoding.prepared_panel(df)[1]
    joined = encoding.prepared_panel_by_join(df, ["dn"])
    assert joined.columns == fitted.columns
    assert sorted(map(str, joined.collect())) == sorted(map(str, fitted.collect()))


@pytest.mark.parametrize("kinds", [(1, 2, 1, 2), (2, 3, 2, 3), (3, 4, 2, 2)])
def test_prepared_panel_by_join_is_dense_where_the_chain_is(spark, kinds):
    d, i, s, w = kinds
    rows = [(f"d{k % d}", f"i{k % i}", f"s{k % s}", k % w, k, k % 2, k % 3, 6, 2000) for k in range(30)]
    df = spark.createDataFrame(rows, ["dept_id", "item_id", "store_id", "wday", "dn", "flag_ram", "snap", "month", "year"])
    df = df.withColumn("dept_id", F.when(F.col("dn") != 0, F.col("dept_id")).otherwise("d0"))
    joined = encoding.prepared_panel_by_join(df, ["dn"])
    if min(kinds) > 1:
        fitted = encoding.prepared_panel(df)[1]
        assert sorted(map(str, joined.collect())) == sorted(map(str, fitted.collect()))
    assert encoding.vector_width(joined).collect() == [(sum(kinds) - 4 + 5, 30)]


def test_prepared_panel_by_join_names_no_slots(spark):
    """The metadata of the vectors are as small at any number of items."""

    def size(n):
        df = spark.range(n).selectExpr(
            "'d' AS dept_id", "CAST(id AS STRING) AS item_id", "'s' AS store_id", "id % 7 AS wday", "id AS dn",
            "0 AS flag_ram", "1 AS snap", "6 AS month", "2000 AS year",
        )
        done = encoding.prepared_panel_by_join(df, ["dn"])
        assert encoding.vector_width(done).collect() == [(n - 1 + 6 + 5, n)]
        return len(str(done.schema["features"].metadata))

    assert size(2000) < size(20) + 10


def test_prepared_panel_by_join_refuses_nulls(spark):
    df = spark.createDataFrame(
        [("d", "i", None, 1, 1, 0, 1, 6, 2000), ("e", "j", "s", 2, 2, 0, 1, 6, 2000)],
        "dept_id string, item_id string, store_id string, wday int, dn int, flag_ram int, snap int, month int, year int",
    )
    with pytest.raises(Exception, match="null"):
        encoding.prepared_panel_by_join(df, ["dn"]).collect()


def test_dummy_columns(spark):
    df = spark.createDataFrame([(1, "b"), (2, None), (3, "a")], "id int, c string")
    rows = encoding.dummy_columns(df, ["c"]).orderBy("id")
    assert rows.columns == ["id", "c_a", "c_b"]
    assert [tuple(r) for r in rows.collect()] == [(1, 0, 1), (2, 0, 0), (3, 1, 0)]
    with pytest.raises(ValueError, match="more than 1"):
        encoding.dummy_columns(df, ["c"], max_categories=1)


@pytest.fixture(scope="module")
def plane(spark):
    rng = np.random.default_rng(1)
    rows = [(float(x), float(z), float(3.0 + 2.0 * x - 0.5 * z)) for x, z in rng.integers(0, 50, (400, 2))]
    df = spark.createDataFrame(rows, "x double, z double, label double")
    features = VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(df)
    return features.withColumn("id", F.monotonically_increasing_id())


@pytest.mark.parametrize(
    "estimator",
    [LinearRegression, lambda: GeneralizedLinearRegression(family="gaussian", link="identity")],
)
def test_linear_models_find_the_plane(spark, plane, estimator):
    model = estimator().fit(plane)
    assert list(model.coefficients) == pytest.approx([2.0, -0.5], abs=1e-6)
    assert model.intercept == pytest.approx(3.0, abs=1e-5)


@pytest.mark.parametrize("link, inverse", [("identity", lambda v: v), ("log", np.exp)])
def test_poisson_models_find_the_rate(spark, link, inverse):
    rows = [(float(x), float(inverse(0.5 + 0.2 * x))) for x in range(1, 9) for _ in range(5)]
    df = spark.createDataFrame(rows, "x double, label double")
    model = linear(["x"], GeneralizedLinearRegression(family="poisson", link=link)).fit(df)
    assert list(model.stages[-1].coefficients) == pytest.approx([0.2], abs=1e-4)
    assert model.stages[-1].intercept == pytest.approx(0.5, abs=1e-3)


def test_train_all_scores_stores_and_survives_failures(spark, plane, tmp_path):
    class Broken(LinearRegression):
        def _fit(self, dataset):
            raise RuntimeError("no fit\nsecond line")

    store = ModelStore(spark, str(tmp_path))
    candidates = [
        training.Candidate("broken", "fails", Broken()),
        training.Candidate("lr", "plane", LinearRegression()),
        training.Candidate("gbt", "trees", GBTRegressor(maxIter=2, seed=1)),
    ]
    train, test = plane.where("id % 10 > 0"), plane.where("id % 10 = 0")
    results = training.train_all(candidates, train, test, store)
    board = training.leaderboard(spark, results).collect()
    assert [r["model_id"] for r in board] == ["lr", "gbt", "broken"]
    assert board[0]["rmse"] == pytest.approx(0.0, abs=1e-6)
    assert (board[2]["rmse"], board[2]["state"], board[2]["message"]) == (None, "ERROR", "no fit")
    assert store.names() == ["gbt", "lr"]
    with pytest.raises(ValueError, match="must differ"):
        training.train_all([candidates[0], candidates[0]], train, test)


def test_search_picks_the_unregularized_intercept(spark, plane):
    candidate = training.Candidate("glr", "plane", GeneralizedLinearRegression(), training.LINEAR_GRID)
    keyed = training.with_search_part(plane.withColumn("id", F.monotonically_increasing_id()), ["id"])
    result = training.train_one(candidate, keyed, plane, searched=True)
    assert result.state == "OK"
    assert result.model.getFitIntercept() and result.model.getRegParam() == 0.01
    assert len(candidate.points()) == 4
    trees = training.Candidate("t", "t", GBTRegressor(), training.TREE_GRID)
    assert len(trees.points()) == 4
    assert training.Candidate("own", "own", GBTRegressor()).points() == [{}]


def test_search_equals_a_loop_by_hand(spark, plane):
    """Every point's error is that of a model fitted and scored on rows picked on the driver."""
    keyed = training.with_search_part(plane.withColumn("id", F.monotonically_increasing_id()), ["id"]).persist()
    rows = keyed.select("features", "label", "search_part").collect()
    sides = {
        side: spark.createDataFrame([(r[0], r[1]) for r in rows if r[2] == side], ["features", "label"])
        for side in ("fit", "validate")
    }
    candidate = training.Candidate("glr", "plane", GeneralizedLinearRegression(), training.LINEAR_GRID)
    for point, score in training.search_scores(candidate, keyed):
        by_hand = {p.name: v for p, v in point.items()}
        model = GeneralizedLinearRegression(**by_hand).fit(sides["fit"])
        assert score == pytest.approx(evaluate.rmse(model.transform(sides["validate"])))
    again = training.with_search_part(keyed.drop("search_part").repartition(5), ["id"])
    assert {tuple(r) for r in again.select("id", "search_part").collect()} == {
        tuple(r) for r in keyed.select("id", "search_part").collect()
    }



def test_standard_candidates(spark):
    ids = [c.model_id for c in training.standard_candidates()]
    assert ids == ["glrgi", "glrpi", "glrpl", "gbtr"]


def test_model_store(spark, plane, tmp_path):
    store = ModelStore(spark, f"{tmp_path}/{uuid.uuid4().hex}")
    assert store.names() == []
    model = LinearRegression().fit(plane)
    path = store.save(model, "x1")
    assert path.endswith("x1.sm")
    store.save(model, "x1")
    store.save(LinearRegression(regParam=0.5, maxIter=10), "untrained")
    assert store.names() == ["untrained", "x1"]
    assert list(store.load("x1").coefficients) == list(model.coefficients)
    assert store.load("untrained").getRegParam() == 0.5
    assert store.stored_class("x1") is type(model)
    with pytest.raises(ValueError, match="stored as a LinearRegressionModel"):
        store.save(GBTRegressor(maxIter=1).fit(plane), "x1")
    for absent in ("1", "x", "ax1"):
        with pytest.raises(ValueError, match="no model"):
            store.load(absent)


def test_model_store_keeps_chains(spark, tmp_path):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0)], "x double, label double")
    store = ModelStore(spark, str(tmp_path))
    store.save(fitted_line(df, "x"), "chain")
    store.save(fitted_line(df, "x"), "chain")
    assert store.load("chain").transform(df).orderBy("x").first()["prediction"] == pytest.approx(2.0)


@pytest.fixture(scope="module")
def panel_rows(spark):
    """Key h holds a third of the rows; key s has a constant input; key t no test rows."""
    rng = np.random.default_rng(5)
    rows = []
    for key, count in [("h", 300), ("a", 150), ("b", 150), ("c", 270), ("s", 30)]:
        for i in range(count):
            dn = 7 if key == "s" else int(rng.integers(1, 2400))
            year = 1995 + dn // 365
            sales = float(rng.integers(0, 40))
            rows.append((key, i, year, 1 + (dn // 30) % 12, dn, 1 + dn % 7, dn % 2, 0, sales, "test" if i % 9 == 0 else "train"))
    rows.append(("t", 0, 1996, 2, 400, 3, 0, 0, 2.0, "train"))
    return spark.createDataFrame(
        rows,
        "item_id string, i int, year int, month int, dn int, wday int, snap int, flag_ram int, label double, part string",
    )


def test_lines_per_key(spark, panel_rows):
    local = panel_rows.toPandas()
    lines = {r["item_id"]: r for r in grouped.line_per_key(panel_rows, ["item_id"], "dn", "label").collect()}
    errors = {r["item_id"]: r for r in grouped.line_error_per_key(panel_rows, ["item_id"], "dn", "label").collect()}
    for key in ("h", "a", "b", "c"):
        train = local[(local.item_id == key) & (local.part == "train")]
        test = local[(local.item_id == key) & (local.part == "test")]
        slope, intercept = np.polyfit(train.dn, train.label, 1)
        assert lines[key]["slope"] == pytest.approx(slope)
        assert lines[key]["intercept"] == pytest.approx(intercept)
        error = np.sqrt(np.mean((test.label - slope * test.dn - intercept) ** 2))
        assert errors[key]["rmse"] == pytest.approx(error)
        assert errors[key]["n_test"] == len(test)
    assert lines["s"]["slope"] is None and lines["s"]["state"] == "SINGULAR"
    assert errors["t"]["rmse"] is None


def test_least_squares_per_key(spark, panel_rows):
    local = panel_rows.toPandas()
    found = grouped.least_squares_per_key(panel_rows, ["item_id"], grouped.panel_inputs(), "label")
    rows = {r["item_id"]: r for r in found.collect()}
    for key, group in local.groupby("item_id"):
        design = np.column_stack(
            [np.ones(len(group))]
            + [(group.wday == d).astype(float) for d in grouped.WEEKDAY_SLOTS]
            + [group[c].astype(float) for c in grouped.PLAIN_INPUTS]
        )
        train = (group.part == "train").to_numpy()
        weights = np.linalg.lstsq(design[train], group.label[train], rcond=1e-11)[0]
        row = rows[key]
        assert row["n_train"] == train.sum() and row["n_test"] == (~train).sum()
        if key == "t":
            assert (row["state"], row["rmse"]) == ("NO_TEST_ROWS", None)
            continue
        residual = group.label[~train] - design[~train] @ weights
        assert row["rmse"] == pytest.approx(np.sqrt(np.mean(residual**2)), rel=1e-6)
        assert row["state"] == "SINGULAR"  # flag_ram is constant here


def test_least_squares_leaves_out_incomplete_rows(spark, panel_rows):
    holes = panel_rows.withColumn("dn", F.when(F.col("i") % 4 > 0, F.col("dn")))
    whole = holes.where("dn is not null")
    fit = lambda df: grouped.least_squares_per_key(df, ["item_id"], {"dn": F.col("dn")}, "label")
    assert {tuple(r) for r in fit(holes).collect()} == {tuple(r) for r in fit(whole).collect()}


def test_split_keys_do_not_leak(spark, panel_rows):
    parted = with_part(panel_rows.drop("part"), ["item_id", "i"])
    assert parted.where(~F.col("part").isin("train", "test")).count() == 0


def test_forest_separates_classes(spark):
    df = spark.range(400).select((F.col("id") % 20).cast("double").alias("x"))
    df = df.withColumn("label", (F.col("x") >= 10).cast("double"))
    features = VectorAssembler(inputCols=["x"], outputCol="features").transform(df)
    model = forest.forest(max_depth=3, trees=5, seed=1).fit(features)
    assert evaluate.accuracy(model.transform(features)) == 1.0
    assert forest.forest(max_depth=500).getMaxDepth() == 30
    assert forest.forest(max_depth=None).getMaxDepth() == 30
    settings = [forest.Setting("max_depth", str(d), d, 1, str(d)) for d in (None, 1)]
    scores = forest.sweep(features.withColumn("id", F.monotonically_increasing_id()), ["id"], settings, 3).collect()
    assert len(scores) == 2 * 3
    assert all(r["score"] == 1.0 for r in scores)
    assert {r["setting"]: r["capped"] for r in scores} == {"None": True, "1": False}


def test_rank_and_weights_at_many_rows(spark):
    """Repetition counts stand for 3e10 rows per key: years far from 0 keep their variance."""
    rows = [
        (k, "train", 2000 + y, 700 * y + 31 * m, m, 5.0 + 2 * y - 0.5 * m, 1e9)
        for k in ("a", "b")
        for y in range(5)
        for m in range(6)
    ]
    rows += [("b", "train", 2004, 1, 3, 7.0, 1.0), ("b", "test", 2002, 1400, 0, 9.0, 1e9)]
    df = spark.createDataFrame(rows, "k string, part string, year int, dn int, month int, label double, copies double")
    inputs = {c: F.col(c) for c in ("year", "month")}
    fitted = grouped.weights_per_key(df, ["k"], inputs, "label", F.col("copies"))
    found = {r["k"]: r for r in fitted.collect()}
    assert found["a"]["n_train"] == 30_000_000_000 and found["a"]["rank"] == 3
    assert found["a"]["weights"] == pytest.approx([2.0, -0.5], abs=1e-9)
    assert found["a"]["intercept"] == pytest.approx(5.0 - 4000.0, abs=1e-5)
    assert found["b"]["rank"] == 3 and found["b"]["rmse"] == pytest.approx(0.0, abs=1e-6)
    # one row among 3e10 lies off the plane of the year: its direction is still seen
    lone = df.where("k = 'a'").select("k", "part", F.lit(2000).alias("year"), "month", "label", "copies")
    lone = lone.unionByName(lone.limit(1).withColumns({"year": F.lit(2001), "copies": F.lit(1.0)}))
    row = grouped.weights_per_key(lone, ["k"], inputs, "label", F.col("copies")).first()
    assert row["rank"] == 3


def test_hot_key_is_condensed_before_the_shuffle(spark, monkeypatch):
    """A key with nearly all rows reaches its task as one state per slice and part."""
    from shelfcast.operators import moments

    rows = spark.range(0, 50_000, 1, 4).select(
        F.when(F.col("id") % 100 > 0, "hot").otherwise(F.col("id").cast("string")).alias("k"),
        F.lit("train").alias("part"),
        (F.col("id") % 97).cast("double").alias("x"),
        (F.col("id") % 89).cast("double").alias("label"),
    )
    states = moments.row_states(rows, ["k"], [F.col("x"), F.col("label")])
    sent = states.mapInArrow(moments._condense(["k", "part"], 2), states.schema)
    counts = {r["k"]: r["count"] for r in sent.groupBy("k").count().collect()}
    assert counts.pop("hot") <= 8 and set(counts.values()) == {1}
    found = {r["k"]: r for r in grouped.weights_per_key(rows, ["k"], {"x": F.col("x")}, "label").collect()}
    local = rows.where("k = 'hot'").toPandas()
    slope, intercept = np.polyfit(local.x, local.label, 1)
    assert found["hot"]["weights"][0] == pytest.approx(slope)
    assert found["hot"]["intercept"] == pytest.approx(intercept)
    assert len(found) == 501


def test_levels_come_from_one_pass(spark, panel_rows):
    """Rolled-up models equal models fitted on the rows themselves; null keys are a group."""
    rows = panel_rows.withColumns(
        {
            "store_id": F.when(F.col("i") % 3 > 0, F.concat(F.lit("s"), F.col("i") % 3)),
            "dept_id": F.when(F.col("item_id") > "a", "p").otherwise("q"),
        }
    )
    levels = {"fine": ["item_id", "store_id"], "item": ["item_id"], "top": ["dept_id"]}
    inputs = grouped.panel_inputs()
    found = grouped.weights_by_level(rows, levels, inputs, "label").collect()
    for name, keys in levels.items():
        direct = grouped.weights_per_key(rows, keys, inputs, "label").collect()
        rolled = {tuple(r[k] for k in keys): r for r in found if r["level"] == name}
        assert len(direct) == len(rolled)
        for r in direct:
            other = rolled[tuple(r[k] for k in keys)]
            assert (r["n_train"], r["n_test"], r["rank"], r["state"]) == tuple(
                other[c] for c in ("n_train", "n_test", "rank", "state")
            )
            if r["rmse"] is not None:
                assert other["rmse"] == pytest.approx(r["rmse"], rel=1e-6, abs=1e-9)
    empty = grouped.weights_by_level(rows.limit(0), levels, inputs, "label")
    assert empty.count() == 0


def test_predictions_spread_a_frequent_key(spark, panel_rows, monkeypatch):
    from shelfcast.operators import skew

    day = {"dn": F.col("dn")}
    models = grouped.weights_per_key(panel_rows, ["item_id"], day, "label")
    rows = panel_rows.select("item_id", "i", "dn").unionByName(
        spark.createDataFrame([("new", -1, 5), ("h", -2, None)], "item_id string, i long, dn int")
    )
    plain = {(r["item_id"], r["i"]): r["prediction"] for r in grouped.predictions_per_key(rows, models, ["item_id"], day, ["i"]).collect()}
    monkeypatch.setattr(skew, "PLAIN_LOOKUP_ROWS", 0)
    split = {(r["item_id"], r["i"]): r["prediction"] for r in grouped.predictions_per_key(rows, models, ["item_id"], day, ["i"]).collect()}
    assert plain == split and plain["new", -1] is None and plain["h", -2] is None


def test_condensed_rows_give_the_same_models_and_scores(spark):
    rows = [(float(x), float(z), float((7 * k) % 5 + 2 * x + z)) for k, (x, z) in enumerate(np.ndindex(3, 40)) for z in (z % 2,)]
    df = spark.createDataFrame(rows, "x double, z double, label double")
    few = training.condensed(df, ["x", "z"])
    assert few.count() == 6
    whole, few = (VectorAssembler(inputCols=["x", "z"], outputCol="features").transform(d) for d in (df, few))
    for each in training.standard_candidates():
        a, b = (training.train_one(each, d, d) for d in (whole, few))
        assert (a.state, b.state) == ("OK", "OK")
        assert b.rmse == pytest.approx(a.rmse, abs=1e-6)


@pytest.mark.parametrize("name", ["leaderboard_by_flag", "tuned_trees_by_flag", "gbt_by_flag"])
def test_models_of_a_flag_train_on_condensed_rows(spark, sf_dir, monkeypatch, name):
    sizes = []

    def fit(self, dataset, params=None):
        sizes.append(dataset.count())
        return plain(self, dataset, params)

    plain = GBTRegressor.fit
    monkeypatch.setattr(GBTRegressor, "fit", fit)
    assert QUERIES[name](spark, sf_dir).count() > 0
    assert sizes and max(sizes) <= 4


def test_few_inputs_need_no_states_of_rows(spark, panel_rows, monkeypatch):
    """Spark's aggregates give the models of merged states; no row passes through Python."""
    rows = panel_rows.withColumns({"dept_id": F.lit("d"), "label": F.when(F.col("i") % 7 > 0, F.col("label"))})
    day = {"dn": F.col("dn")}
    rows = rows.withColumn("item_id", F.when(F.col("i") % 11 > 0, F.col("item_id")))

    def found():
        table = grouped.weights_by_level(rows, {"item": ["item_id", "dept_id"], "top": ["dept_id"]}, day, "label")
        return {(r["level"], r["item_id"], r["dept_id"]): r for r in table.collect()}

    native = found()
    monkeypatch.setattr(grouped, "FEW_INPUTS", 0)
    merged = found()
    assert native.keys() == merged.keys() and len(native) > 2
    for key, a in native.items():
        b = merged[key]
        assert [a[c] for c in ("n_train", "n_test", "rank", "state")] == [b[c] for c in ("n_train", "n_test", "rank", "state")]
        for c in ("rmse", "intercept"):
            assert a[c] == pytest.approx(b[c], rel=1e-6, abs=1e-6)
        assert a["weights"] == (None if b["weights"] is None else pytest.approx(b["weights"], rel=1e-6, abs=1e-9))
    monkeypatch.undo()
    monkeypatch.setattr(grouped.moments, "row_states", lambda *a: pytest.fail("rows became states"))
    assert grouped.weights_per_key(rows, ["item_id"], day, "label").count() == len(native) - 1


def test_models_are_solved_where_states_merge(spark, panel_rows):
    """No co-moments are written for a level, and rows reach Python as plain columns."""
    rows = panel_rows.withColumns({"store_id": F.concat(F.lit("s"), F.col("i") % 3), "dept_id": F.lit("p")})
    inputs = grouped.panel_inputs()
    found = grouped.weights_per_key(rows, ["item_id"], inputs, "label")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange") == 1 and "max_by" not in plan
    states = grouped.value_states(rows, ["item_id", "store_id", "dept_id"], inputs, "label")
    below = grouped.solved_states(states, [["item_id", "store_id", "dept_id"], ["item_id", "dept_id"]], list(inputs), ["dept_id"])
    table = below.where("comoments IS NOT NULL")
    assert table.where("level >= 0").count() == 0 and table.where("level = -1").count() > 0


def test_models_of_single_rows(spark):
    """A key of one row is its mean, without inputs."""
    rows = spark.createDataFrame([("a", "train", 3, 5.0, 2.0), ("b", "test", 4, 1.0, 1.0)], "k string, part string, x int, z double, label double")
    inputs = {c: F.col(c) for c in ("x", "z")} | {"w": F.lit(1.0)}
    found = {r["k"]: r for r in grouped.weights_per_key(rows, ["k"], inputs, "label").collect()}
    assert (found["a"]["weights"], found["a"]["intercept"], found["a"]["rank"]) == ([0.0] * 3, 2.0, 1)
    assert (found["b"]["weights"], found["b"]["state"]) == (None, "NO_TRAIN_ROWS")
