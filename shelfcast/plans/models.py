"""Queries for training, prediction and scores."""

from __future__ import annotations

from dataclasses import replace

from pyspark.ml import Pipeline
from pyspark.ml.feature import OneHotEncoder, StringIndexer, VectorAssembler
from pyspark.ml.regression import GBTRegressor, GeneralizedLinearRegression
from pyspark.sql import functions as F

from shelfcast.operators import clean, encoding, forest, grouped, training
from shelfcast.operators.boxstats import box_statistics
from shelfcast.operators.evaluate import condensed_rmse
from shelfcast.operators.factored import FactoredRegressor
from shelfcast.operators.forecast import union_tables
from shelfcast.operators.models import fitted_line, predicted_unknown
from shelfcast.operators.sampling import SPLIT_SEED, with_part, with_random_part
from shelfcast.operators.store import ModelStore
from shelfcast.plans.registry import HELD_OUT_SQL, PANEL_KEY, over_panel, over_rated, register
from shelfcast.plans.shared import factored_panel, stored_condensed, stored_panel
from shelfcast.scratch import fresh_path, stage
from shelfcast.sources.panel import DAY_ZERO, known_rows, rated_documents
from shelfcast.sources.scans import read_named

_LINE_SQL = over_panel(
    """, fit AS (SELECT regr_intercept(label, dn) AS a, regr_slope(label, dn) AS b FROM panel WHERE label IS NOT NULL)
    SELECT item_id, store_id, dn, round(a + b * dn, 6) AS prediction FROM panel, fit WHERE label IS NULL"""
)


def _line(spark, sf_dir):
    return fitted_line(clean.known(stored_panel(spark, sf_dir)).select("dn", "label"), "dn")


def _line_predictions(model, spark, sf_dir):
    predicted = model.transform(clean.to_predict(stored_panel(spark, sf_dir)))
    return predicted.select("item_id", "store_id", "dn", F.round("prediction", 6).alias("prediction"))


@register("linear_regression", _LINE_SQL)
def linear_regression(spark, sf_dir):
    return _line_predictions(_line(spark, sf_dir), spark, sf_dir)


@register("model_store_roundtrip", _LINE_SQL)
def model_store_roundtrip(spark, sf_dir):
    store = ModelStore(spark, fresh_path(spark, "models"))
    store.save(_line(spark, sf_dir), "line")
    return _line_predictions(store.load("line"), spark, sf_dir)


def _glr(family: str, link: str) -> GeneralizedLinearRegression:
    return GeneralizedLinearRegression(family=family, link=link)


def _factored(estimator, factors, linear: bool) -> FactoredRegressor:
    """The model that ``estimator`` describes, for condensed rows with codes."""
    return FactoredRegressor(estimator.copy({estimator.weightCol: "weight"}), factors.tables(base_slot=linear))


def _register_regression(name: str, new_estimator, linear: bool = True) -> None:
    @register(name)
    def query(spark, sf_dir):
        factors = factored_panel(spark, sf_dir)
        model = _factored(new_estimator(), factors, linear).fit(stored_condensed(spark, sf_dir, factors))
        rows = factors.with_slot(clean.to_predict(stored_panel(spark, sf_dir)))
        return model.transform(factors.coded(rows).select(*PANEL_KEY, "features")).drop("features")


_register_regression("glr_gaussian", lambda: _glr("gaussian", "identity"))
_register_regression("glr_poisson_identity", lambda: _glr("poisson", "identity"))
_register_regression("glr_poisson_log", lambda: _glr("poisson", "log"))
_register_regression("gbt_regression", lambda: GBTRegressor(maxIter=10, seed=SPLIT_SEED), linear=False)


# Columns whose categories are inputs of the registered models, besides the hashed items.
_CATEGORIES = ["dept_id", "store_id", "wday"]


def _register_equations(name: str, family: str, link: str, weighed: bool) -> None:
    """The score equations of a fit on all inputs, which fix it without fitting it again.

    With a canonical link the fitted values of every category sum to its labels. With the
    poisson family and the identity link the ratios of label and fitted value sum to the
    number of rows.
    """
    expected = "count(*)" if weighed else "sum(label)"
    parts = " UNION ALL ".join(
        f"""SELECT '{c}' AS column_name, CAST({c} AS VARCHAR) AS value, count(*) AS n_train,
        round(CAST({expected} AS DOUBLE), 0) AS total FROM panel WHERE label IS NOT NULL GROUP BY {c}"""
        for c in _CATEGORIES
    )

    @register(name, over_panel(f" SELECT * FROM ({parts})"))
    def query(spark, sf_dir):
        factors = factored_panel(spark, sf_dir)
        train = stored_condensed(spark, sf_dir, factors)
        wday = F.weekday(F.date_add(F.lit(DAY_ZERO), F.col("dn"))) + 1
        fitted = _factored(_glr(family, link), factors, True).fit(train).transform(train).withColumn("wday", wday)
        term = F.col("label") / F.col("prediction") if weighed else F.col("prediction")
        named = [F.struct(F.lit(c).alias("column_name"), F.col(c).cast("string").alias("value")) for c in _CATEGORIES]
        terms = fitted.select(F.inline(F.array(*named)), "weight", (F.col("weight") * term).alias("term"))
        return terms.groupBy("column_name", "value").agg(
            F.sum("weight").cast("long").alias("n_train"), F.round(F.sum("term"), 0).alias("total")
        )


_register_equations("glr_gaussian_equations", "gaussian", "identity", weighed=False)
_register_equations("glr_poisson_log_equations", "poisson", "log", weighed=False)
_register_equations("glr_poisson_identity_equations", "poisson", "identity", weighed=True)


def _register_by_store(name: str, family: str, link: str) -> None:
    """With the store as only input, every family and link predicts the store's mean."""

    @register(
        name,
        over_panel(
            """ SELECT store_id, round(avg(label), 4) AS prediction, count(*) AS n_train
            FROM panel WHERE label IS NOT NULL GROUP BY store_id"""
        ),
    )
    def query(spark, sf_dir):
        known = clean.known(stored_panel(spark, sf_dir)).select("store_id", "label")
        steps = Pipeline(
            stages=[
                StringIndexer(inputCol="store_id", outputCol="istore_id"),
                OneHotEncoder(inputCols=["istore_id"], outputCols=["vstore_id"]),
                VectorAssembler(inputCols=["vstore_id"], outputCol="features"),
                _glr(family, link),
            ]
        )
        predicted = training.fit_persisted(steps, known).transform(known)
        return predicted.groupBy("store_id").agg(
            F.round(F.avg("prediction"), 4).alias("prediction"), F.count("*").alias("n_train")
        )


_register_by_store("glr_gaussian_by_store", "gaussian", "identity")
_register_by_store("glr_poisson_identity_by_store", "poisson", "identity")
_register_by_store("glr_poisson_log_by_store", "poisson", "log")


@register(
    "per_key_regression",
    over_panel(
        f""" SELECT item_id, count(label) AS n_train, round(regr_slope(label, dn), 6) AS slope,
        round(regr_intercept(label, dn), 6) AS intercept,
        CASE WHEN regr_slope(label, dn) IS NULL THEN 'SINGULAR' ELSE 'OK' END AS state
        FROM panel WHERE label IS NOT NULL AND NOT ({HELD_OUT_SQL}) GROUP BY item_id"""
    ),
)
def per_key_regression(spark, sf_dir):
    parted = with_part(known_rows(spark, sf_dir), PANEL_KEY)
    lines = grouped.line_per_key(parted, ["item_id"], "dn", "label")
    return lines.withColumns({c: F.round(c, 6) for c in ("slope", "intercept")})


@register(
    "per_key_rmse",
    over_panel(
        f""", fit AS (
          SELECT item_id, regr_slope(label, dn) AS a, regr_intercept(label, dn) AS b
          FROM panel WHERE label IS NOT NULL AND NOT ({HELD_OUT_SQL}) GROUP BY item_id
        )
        SELECT p.item_id, count(*) FILTER (WHERE {HELD_OUT_SQL.replace('item_id', 'p.item_id')}) AS n_test,
               round(sqrt(avg(pow(label - a * dn - b, 2))
                          FILTER (WHERE {HELD_OUT_SQL.replace('item_id', 'p.item_id')})), 6) AS rmse
        FROM panel p LEFT JOIN fit ON fit.item_id = p.item_id
        WHERE label IS NOT NULL GROUP BY p.item_id"""
    ),
)
def per_key_rmse(spark, sf_dir):
    parted = with_part(known_rows(spark, sf_dir), PANEL_KEY)
    errors = grouped.line_error_per_key(parted, ["item_id"], "dn", "label")
    return errors.withColumn("rmse", F.round("rmse", 6))


@register(
    "per_key_rmse_by_moments",
    over_panel(
        f""", fit AS (
          SELECT item_id, regr_slope(label, dn) AS a, regr_intercept(label, dn) AS b
          FROM panel WHERE label IS NOT NULL AND NOT ({HELD_OUT_SQL}) GROUP BY item_id
        )
        SELECT fit.item_id, round(sqrt(avg(pow(label - a * dn - b, 2))), 6) AS rmse
        FROM panel p JOIN fit ON fit.item_id = p.item_id
        WHERE label IS NOT NULL AND a IS NOT NULL AND {HELD_OUT_SQL.replace('item_id', 'p.item_id')}
        GROUP BY fit.item_id"""
    ),
)
def per_key_rmse_by_moments(spark, sf_dir):
    """The general solver with the day as only input finds the same lines."""
    parted = with_part(clean.known(stored_panel(spark, sf_dir)), PANEL_KEY)
    fitted = grouped.least_squares_per_key(parted, ["item_id"], {"dn": F.col("dn")}, "label")
    return fitted.where(F.col("state") == "OK").select("item_id", F.round("rmse", 6).alias("rmse"))


@register("per_key_least_squares")
def per_key_least_squares(spark, sf_dir):
    parted = with_part(clean.known(stored_panel(spark, sf_dir)), PANEL_KEY)
    return grouped.least_squares_per_key(parted, ["item_id", "store_id"], grouped.panel_inputs(), "label")


@register("per_department_least_squares")
def per_department_least_squares(spark, sf_dir):
    parted = with_part(clean.known(stored_panel(spark, sf_dir)), PANEL_KEY)
    return grouped.least_squares_per_key(parted, ["dept_id"], grouped.panel_inputs(), "label")


@register(
    "per_key_weights",
    over_panel(
        """, fit AS (
          SELECT item_id, count(*) AS n, CASE WHEN count(DISTINCT dn) > 1 THEN regr_slope(label, dn) ELSE 0 END AS a,
                 avg(label) AS y, avg(dn) AS x, CAST(1 + CAST(count(DISTINCT dn) > 1 AS INTEGER) AS INTEGER) AS rank
          FROM panel WHERE label IS NOT NULL GROUP BY item_id
        )
        SELECT item_id, n AS n_train, round(a, 6) AS slope, round(y - a * x, 6) AS intercept, rank FROM fit"""
    ),
)
def per_key_weights(spark, sf_dir):
    """The table of models with the day as only input, fitted on all known rows."""
    known = clean.known(stored_panel(spark, sf_dir)).withColumn("part", F.lit("train"))
    models = grouped.weights_per_key(known, ["item_id"], {"dn": F.col("dn")}, "label")
    return models.select(
        "item_id",
        "n_train",
        F.round(F.col("weights")[0], 6).alias("slope"),
        F.round("intercept", 6).alias("intercept"),
        "rank",
    )


@register(
    "per_key_predictions",
    over_panel(
        """, fit AS (
          SELECT item_id, CASE WHEN count(DISTINCT dn) > 1 THEN regr_slope(label, dn) ELSE 0 END AS a, avg(label) AS y, avg(dn) AS x
          FROM panel WHERE label IS NOT NULL GROUP BY item_id
        )
        SELECT p.item_id, store_id, dn, round(y + a * (dn - x), 4) AS prediction
        FROM panel p LEFT JOIN fit ON fit.item_id = p.item_id WHERE label IS NULL"""
    ),
)
def per_key_predictions(spark, sf_dir):
    panel = stored_panel(spark, sf_dir)
    known = clean.known(panel).withColumn("part", F.lit("train"))
    day = {"dn": F.col("dn")}
    models = grouped.weights_per_key(known, ["item_id"], day, "label")
    rows = clean.to_predict(panel).select("item_id", "store_id", "dn")
    predicted = grouped.predictions_per_key(rows, models, ["item_id"], day, PANEL_KEY)
    return predicted.select("item_id", "store_id", "dn", F.round("prediction", 4).alias("prediction"))


# Levels whose errors are published, from fine to coarse.
LEVELS = {"item_store": ["item_id", "store_id"], "item": ["item_id"], "department": ["dept_id"]}


def _level_sql(name: str, keys: list[str]) -> str:
    held_out = HELD_OUT_SQL.replace("item_id", "p.item_id").replace("store_id", "p.store_id")
    own = ", ".join(f"p.{c}" if c in keys else f"NULL AS {c}" for c in ("item_id", "store_id", "dept_id"))
    same = " AND ".join(f"fit.{k} = p.{k}" for k in keys)
    return f"""SELECT '{name}' AS level, {own}, count(*) FILTER (WHERE NOT ({held_out})) AS n_train,
        count(*) FILTER (WHERE {held_out}) AS n_test,
        round(sqrt(avg(pow(label - y - a * (dn - x), 2)) FILTER (WHERE {held_out})), 4) AS rmse
      FROM panel p LEFT JOIN (
        SELECT {', '.join(keys)}, CASE WHEN count(DISTINCT dn) > 1 THEN regr_slope(label, dn) ELSE 0 END AS a, avg(label) AS y, avg(dn) AS x
        FROM panel WHERE label IS NOT NULL AND NOT ({HELD_OUT_SQL}) GROUP BY ALL
      ) fit ON {same} WHERE label IS NOT NULL GROUP BY {', '.join(f'p.{k}' for k in keys)}"""


@register(
    "errors_by_level",
    over_panel(" SELECT * FROM (" + " UNION ALL ".join(_level_sql(n, k) for n, k in LEVELS.items()) + ")"),
)
def errors_by_level(spark, sf_dir):
    """Errors of models per item and store, item, and department from one pass, with the
    day as only input."""
    parted = with_part(clean.known(stored_panel(spark, sf_dir)), PANEL_KEY)
    found = grouped.weights_by_level(parted, LEVELS, {"dn": F.col("dn")}, "label")
    return found.select(
        "level", "item_id", "store_id", "dept_id", "n_train", "n_test", F.round("rmse", 4).alias("rmse")
    )


_INPUT_SQL = {f"wday_{d}": f"CAST(wday = {d} AS INTEGER)" for d in grouped.WEEKDAY_SLOTS} | {
    c: c for c in grouped.PLAIN_INPUTS
}


@register(
    "normal_equations_by_level",
    over_panel(
        " SELECT * FROM ("
        + " UNION ALL ".join(
            f"""SELECT '{name}' AS level, {', '.join(c if c in keys else f"NULL AS {c}" for c in ("item_id", "store_id", "dept_id"))},
            round(sum(label), 2) AS sum_one, {', '.join(f"round(sum(label * {x}), 2) AS sum_{c}" for c, x in _INPUT_SQL.items())}
            FROM panel WHERE label IS NOT NULL GROUP BY {', '.join(keys)}"""
            for name, keys in LEVELS.items()
        )
        + ")"
    ),
)
def normal_equations_by_level(spark, sf_dir):
    """Fitted values of the full models, summed against every input: least squares makes
    these sums equal to those of the labels, and nothing else in its span does."""
    known = stage(clean.known(stored_panel(spark, sf_dir)).withColumn("part", F.lit("train")), "known")
    inputs = grouped.panel_inputs()
    models = stage(grouped.weights_by_level(known, LEVELS, inputs, "label"), "weights")
    tables = []
    for name, keys in LEVELS.items():
        own = models.where(F.col("level") == name).select(*keys, "weights", "intercept")
        fitted = grouped.predictions_per_key(known, own, keys, inputs, PANEL_KEY)
        sums = fitted.groupBy(*keys).agg(
            F.round(F.sum("prediction"), 2).alias("sum_one"),
            *[F.round(F.sum(F.col("prediction") * x), 2).alias(f"sum_{c}") for c, x in inputs.items()],
        )
        own_keys = [F.col(c) if c in keys else F.lit(None).cast("string").alias(c) for c in ("item_id", "store_id", "dept_id")]
        tables.append(sums.select(F.lit(name).alias("level"), *own_keys, *[c for c in sums.columns if c not in keys]))
    return union_tables(tables)


def _board(spark, sf_dir, searched: bool):
    store = ModelStore(spark, fresh_path(spark, "models"))
    factors = factored_panel(spark, sf_dir)
    parted = with_part(clean.known(stored_panel(spark, sf_dir)), PANEL_KEY)
    parts = ["part"]
    if searched:
        parted = training.with_search_part(parted, PANEL_KEY)
        parts.append("search_part")
    rows = stage(factors.condensed(parted, parts), "condensed")
    train, test = (rows.where(F.col("part") == part) for part in ("train", "test"))
    candidates = [replace(c, estimator=_factored(c.estimator, factors, True)) for c in training.standard_candidates()]
    results = training.train_all(candidates, train, test, store, searched=searched)
    return training.leaderboard(spark, results)


@register("leaderboard")
def leaderboard(spark, sf_dir):
    return _board(spark, sf_dir, searched=False)


@register("tuned_training")
def tuned_training(spark, sf_dir):
    return _board(spark, sf_dir, searched=True)


# With one 0/1 input every family, link and tree predicts the mean of its side, so the
# errors on the held-out rows are known.
_FLAG_SCORES = f""", side AS (
  SELECT snap, avg(label) AS mean FROM panel WHERE label IS NOT NULL AND NOT ({HELD_OUT_SQL}) GROUP BY snap
),
score AS (
  SELECT round(sqrt(avg(pow(label - mean, 2))), 4) AS rmse FROM panel JOIN side USING (snap)
  WHERE label IS NOT NULL AND {HELD_OUT_SQL}
)"""


def _flag_scores(spark, sf_dir, candidates, searched=False):
    known = clean.known(stored_panel(spark, sf_dir)).select(*PANEL_KEY, "snap", "label")
    parted = training.with_search_part(with_part(known, PANEL_KEY), PANEL_KEY)
    sides = stage(training.condensed(parted, ["snap", "part", "search_part"]), "condensed")
    flagged = VectorAssembler(inputCols=["snap"], outputCol="features").transform(sides)
    store = ModelStore(spark, fresh_path(spark, "models"))
    train, test = (flagged.where(F.col("part") == part) for part in ("train", "test"))
    results = training.train_all(candidates, train, test, store, searched=searched)
    return training.leaderboard(spark, results).select("model_id", F.round("rmse", 4).alias("rmse"), "state")


@register(
    "leaderboard_by_flag",
    over_panel(
        f"""{_FLAG_SCORES} SELECT model_id, rmse, 'OK' AS state
        FROM score, (VALUES ('glrgi'), ('glrpi'), ('glrpl'), ('gbtr')) ids (model_id)"""
    ),
)
def leaderboard_by_flag(spark, sf_dir):
    return _flag_scores(spark, sf_dir, training.standard_candidates())


@register(
    "tuned_trees_by_flag",
    over_panel(f"{_FLAG_SCORES} SELECT 'gbtr' AS model_id, rmse, 'OK' AS state FROM score"),
)
def tuned_trees_by_flag(spark, sf_dir):
    """Every point of the tree grid finds the two means."""
    trees = [c for c in training.standard_candidates() if c.model_id == "gbtr"]
    return _flag_scores(spark, sf_dir, trees, searched=True)


@register(
    "gbt_by_flag",
    over_panel(
        """ SELECT snap, round(avg(label), 4) AS prediction, count(*) AS n_train
        FROM panel WHERE label IS NOT NULL GROUP BY snap"""
    ),
)
def gbt_by_flag(spark, sf_dir):
    known = clean.known(stored_panel(spark, sf_dir)).select("snap", "label")
    sides = stage(training.condensed(known, ["snap"]), "condensed")
    flagged = VectorAssembler(inputCols=["snap"], outputCol="features").transform(sides)
    model = training.fit_persisted(GBTRegressor(maxIter=10, seed=SPLIT_SEED, weightCol="weight"), flagged)
    return model.transform(flagged).select(
        "snap", F.round("prediction", 4).alias("prediction"), F.col("weight").cast("long").alias("n_train")
    )


@register("gbt_holdout_rmse")
def gbt_holdout_rmse(spark, sf_dir):
    factors = factored_panel(spark, sf_dir)
    known = clean.known(stored_panel(spark, sf_dir)).select(*PANEL_KEY, "dept_id", "label")
    rows = stage(factors.condensed(with_random_part(known, 0.7), ["part"]), "condensed")
    chain = Pipeline(stages=[_factored(GBTRegressor(maxIter=10, seed=SPLIT_SEED), factors, False)])
    held_out = chain.fit(rows.where(F.col("part") == "train")).transform(rows.where(F.col("part") == "test"))
    return held_out.agg(condensed_rmse().alias("rmse"), F.sum("weight").cast("long").alias("n_test"))


def _rated_features(spark, sf_dir):
    """Documents with features for the rating; fitted on rated and unrated ones."""
    rated = rated_documents(spark, sf_dir).withColumn("label", F.col("quality").cast("double"))
    chain = encoding.encoder(["lang", "source"], ["vlang", "vsource", "n_chars"])
    return encoding.encoded(chain.fit(rated), rated)


@register("random_forest_classifier")
def random_forest_classifier(spark, sf_dir):
    documents = _rated_features(spark, sf_dir)
    rated = documents.where(F.col("label").isNotNull()).select("features", "label")
    model = forest.forest(max_depth=10, trees=20, seed=SPLIT_SEED).fit(rated)
    predicted = predicted_unknown(model, documents)
    return predicted.select("doc_id", F.col("prediction").cast("int").alias("quality"))


# Lengths in characters: the input says which documents pass the first, the label the second.
LONG_FROM = (1000, 1500)

_BOXED = ["parameter", "setting", "capped"]


@register("forest_sweep")
def forest_sweep(spark, sf_dir):
    rated = _rated_features(spark, sf_dir).where(F.col("label").isNotNull())
    scores = forest.sweep(rated, ["doc_id"], seed=SPLIT_SEED)
    return box_statistics(scores, _BOXED, "score").orderBy("parameter", "setting")


def _sweep_by_length_sql() -> str:
    """With one 0/1 input every forest says the commoner class of either side, so all
    repeats of a setting have the accuracy of that rule on the setting's hold-out."""
    rows = ", ".join(
        f"('{s.parameter}', '{s.value}', {s.capped}, '{s.split}')" for s in forest.standard_settings()
    )
    return f"""WITH settings (parameter, setting, capped, split) AS (VALUES {rows}),
    parted AS (
      SELECT s.*, n_chars > {LONG_FROM[0]} AS flag, n_chars > {LONG_FROM[1]} AS label,
             substr(md5(split || '|' || doc_id), 1, 3) >= '{forest.HOLD_OUT_FROM}' AS held_out
      FROM documents, settings s
    ),
    side AS (
      SELECT parameter, setting, flag, avg(CAST(label AS INTEGER)) > 0.5 AS guess
      FROM parted WHERE NOT held_out GROUP BY ALL
    ),
    scored AS (
      SELECT p.parameter, p.setting, p.capped, round(avg(CAST(label = guess AS INTEGER)), 6) AS score
      FROM parted p JOIN side USING (parameter, setting, flag) WHERE held_out GROUP BY ALL
    )
    SELECT parameter, setting, capped, CAST(100 AS BIGINT) AS n_values, score AS q1, score AS median,
           score AS q3, score AS whisker_low, score AS whisker_high, CAST(0 AS BIGINT) AS n_outliers
    FROM scored"""


_SPLITS = sorted({s.split for s in forest.standard_settings()})


@register(
    "forest_hold_outs",
    over_rated(
        f""", named (split) AS (VALUES {', '.join(f"('{s}')" for s in _SPLITS)}),
        parted AS (
          SELECT doc_id, split, substr(md5(split || '|' || doc_id), 1, 3) >= '{forest.HOLD_OUT_FROM}' AS held_out
          FROM rated, named WHERE quality IS NOT NULL
        )
        SELECT doc_id, COALESCE(string_agg(split, ',' ORDER BY split) FILTER (WHERE held_out), '') AS held_out_of,
               CAST(count(*) FILTER (WHERE held_out) AS INTEGER) AS n_held_out FROM parted GROUP BY doc_id"""
    ),
)
def forest_hold_outs(spark, sf_dir):
    """The splits of the sweep that hold out each rated document; it trains in the others."""
    rated = rated_documents(spark, sf_dir).where(F.col("quality").isNotNull())
    named = rated.select("doc_id", forest.held_out_of(["doc_id"], _SPLITS).alias("named"))
    return named.select(
        "doc_id", F.array_join("named", ",").alias("held_out_of"), F.size("named").alias("n_held_out")
    )


@register("forest_sweep_by_length", _sweep_by_length_sql())
def forest_sweep_by_length(spark, sf_dir):
    lengths = read_named(spark, sf_dir, "documents").select(
        "doc_id",
        (F.col("n_chars") > LONG_FROM[0]).cast("int").alias("flag"),
        (F.col("n_chars") > LONG_FROM[1]).cast("double").alias("label"),
    )
    flagged = VectorAssembler(inputCols=["flag"], outputCol="features").transform(lengths)
    scores = forest.sweep(flagged, ["doc_id"], seed=SPLIT_SEED)
    boxes = box_statistics(scores.withColumn("score", F.round("score", 6)), _BOXED, "score")
    return boxes.orderBy("parameter", "setting")
