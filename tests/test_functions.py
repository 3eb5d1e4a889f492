"""Column rules and worked examples."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from shelfcast.functions import arrays, columns as fn
from shelfcast.operators import aggregate, clean, forecast

PREDICTION_SCHEMA = "dn int, item_id string, store_id string, prediction double"

# Several rows per cell, a cell of nulls only, cells without rows.
FORECAST_ROWS = [
    (1, "A", "north", 1.5), (1, "A", "north", 2.0), (1, "A", "north", None), (3, "A", "north", 4.0),
    (2, "A", "south", None), (2, "A", "south", None), (4, "A", "south", 0.25),
    (1, "B", "north", -1.0), (1, "B", "north", 1.0), (4, "B", "north", 7.0), (4, "B", "north", 0.5),
]
FORECAST_TABLE = {
    ("A", "north"): (3.5, None, 4.0, None),
    ("A", "south"): (None, None, None, 0.25),
    ("B", "north"): (0.0, None, None, 7.5),
}


def test_day_matrix_of_two_keys(spark):
    rows = spark.createDataFrame(FORECAST_ROWS, PREDICTION_SCHEMA)
    wide = forecast.day_matrix(rows, ["item_id", "store_id"], "dn", "prediction", range(1, 5))
    assert wide.columns == ["item_id", "store_id", "F1", "F2", "F3", "F4"]
    assert {(r[0], r[1]): tuple(r)[2:] for r in wide.collect()} == FORECAST_TABLE


def test_days_after_the_last_horizon_raise(spark):
    horizons = [forecast.Horizon("validation", 0), forecast.Horizon("evaluation", 28)]
    late = spark.createDataFrame([(3, "A", "north", 1.0), (57, "A", "north", 1.0)], PREDICTION_SCHEMA)
    with pytest.raises(Exception, match="no horizon holds day 57"):
        forecast.forecast_table(late, horizons).collect()


def test_horizon_matrix_raises_after_the_last_day(spark):
    horizon = forecast.Horizon("v", 10)
    rows = spark.createDataFrame([("i", "s", 39, 2.0)], "item_id string, store_id string, dn int, prediction double")
    with pytest.raises(Exception, match="no horizon holds day 39"):
        forecast.horizon_matrix(rows, horizon).collect()
    # a later horizon's day is left to that horizon
    assert forecast.horizon_matrix(rows, horizon, last_day=66).collect() == []


def test_wide_days_from_sparse_vectors(spark):
    rows = [("a", 1, 5.0), ("a", 4, 7.0), ("b", 3, None), ("c", 1, 1.0), ("c", 2, 2.0), ("c", 4, 0.0)]
    df = spark.createDataFrame(rows, "k string, dn int, v double").repartition(3)
    wide = forecast.wide_days(forecast.day_vectors(df, ["k"], "dn", "v"), 1, 5)
    assert wide.columns == ["k", "d_1", "d_2", "d_3", "d_4", "d_5"]
    assert sorted(map(tuple, wide.collect())) == [
        ("a", 5.0, None, None, 7.0, None),
        ("b", None, None, None, None, None),
        ("c", 1.0, 2.0, None, 0.0, None),
    ]
    with pytest.raises(Exception, match="a day lies outside 2..5"):
        forecast.wide_days(forecast.day_vectors(df, ["k"], "dn", "v"), 2, 5).collect()


def test_day_matrix_equals_pivot(spark):
    rows = spark.createDataFrame(FORECAST_ROWS * 3, PREDICTION_SCHEMA)
    keys = ["item_id", "store_id"]
    wide = forecast.day_matrix(rows, keys, "dn", "prediction", [1, 2, 3, 4])
    pivoted = fn.prefixed(rows.groupBy(*keys).pivot("dn").sum("prediction"), "F", keys)
    assert {tuple(r) for r in wide.collect()} == {tuple(r) for r in pivoted.collect()}


def test_forecast_table_equals_union_of_horizons(spark):
    rows = [(d, f"I{d % 3}", "S", d / 3 - 5) for d in range(1, 57)] + [(5, None, "S", 1.0)]
    predictions = spark.createDataFrame(rows, PREDICTION_SCHEMA)
    horizons = [forecast.Horizon("validation", 0), forecast.Horizon("evaluation", 28)]
    together = forecast.forecast_table(predictions, horizons)
    apart = forecast.union_tables([forecast.horizon_matrix(predictions, h, last_day=56) for h in horizons])
    assert together.columns == apart.columns
    assert {tuple(r) for r in together.collect()} == {tuple(r) for r in apart.collect()}
    total = sum(sum(v for v in r[1:] if v is not None) for r in together.collect() if r[0])
    assert total == sum(max(int(p), 0) for d, i, s, p in rows if i and d <= 56)


def test_forecast_table_fill(spark):
    predictions = spark.createDataFrame([(1, "I", "S", 4.7)], PREDICTION_SCHEMA)
    row = forecast.forecast_table(predictions, [forecast.Horizon("validation", 0)], fill=0).first()
    assert row["id"] == "I_S_validation" and row["F1"] == 4 and row["F28"] == 0


@pytest.mark.parametrize(
    "a, b, expected", [(1, "hallo", 0), (None, "hallo", 1), (2, None, 1), (None, None, 2)]
)
def test_null_count(spark, a, b, expected):
    df = spark.createDataFrame([(a, b)], "a int, b string")
    assert clean.with_null_count(df).first()["nullcnt"] == expected
    assert clean.rows_with_nulls(df).first()["n_rows"] == int(expected > 0)


@pytest.mark.parametrize(
    "predicted, actual, expected",
    [(None, 3.0, 0.0), (2.0, None, 4.0), (5.0, 3.0, 4.0), (None, None, 0.0)],
)
def test_squared_error_rules(spark, predicted, actual, expected):
    df = spark.createDataFrame([(predicted, actual)], "p double, a double")
    assert df.select(fn.squared_error_or_default("p", "a")).first()[0] == expected
    plain = df.select(fn.squared_error("p", "a")).first()[0]
    assert plain == (None if predicted is None or actual is None else expected)


@pytest.mark.parametrize("value, expected", [(-3, 0), (0, 0), (4, 4), (None, None)])
def test_non_negative(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v int")
    assert df.select(fn.non_negative("v")).first()[0] == expected


@pytest.mark.parametrize("value, expected", [(2.9, 2), (-0.7, 0), (-2.9, -2), (1e12, None)])
def test_truncated_int(spark, value, expected):
    df = spark.createDataFrame([(value,)], "v double")
    assert df.select(fn.truncated_int("v")).first()[0] == expected


def test_ids_and_keys(spark):
    df = spark.createDataFrame([("a", None), ("a", "b")], "x string, y string").orderBy(F.col("y"))
    ids = df.select(fn.joined_id(["x", "y"], "validation"), fn.text_key(["x", "y"])).collect()
    assert [tuple(r) for r in ids] == [(None, "a_None"), ("a_b_validation", "a_b")]


def test_padded_number(spark):
    df = spark.createDataFrame([(3, 1995), (12, 12345)], "m int, y int")
    found = df.select(fn.padded_number("m", 2), fn.padded_number("y", 4)).collect()
    assert [tuple(r) for r in found] == [("03", "1995"), ("12", "12345")]


@pytest.mark.parametrize(
    "pixels, left, right",
    [([0.0, 0.0, 0.5, 0.1, 0.2], 2, 0), ([0.0, 0.0], 0, 0), ([-1.0, 3.0, 0.0, 0.0], 1, 2)],
)
def test_first_positive(spark, pixels, left, right):
    df = spark.createDataFrame([(pixels,)], "p array<double>")
    assert tuple(df.select(arrays.first_positive("p"), arrays.last_positive("p")).first()) == (left, right)


def test_square_rows(spark):
    pixels = [float(i) for i in range(28 * 28)]
    df = spark.createDataFrame([(pixels,)], "p array<double>")
    rows = df.select(arrays.square_rows("p", 28)).first()[0]
    assert rows == [pixels[i * 28 : i * 28 + 28] for i in range(28)]
    assert df.select(arrays.scaled("p")).first()[0] == [p / 255.0 for p in pixels]
    assert df.select(arrays.sliced("p", 2, 3)).first()[0] == [2.0, 3.0, 4.0]


def test_square_rows_of_wrong_size(spark):
    df = spark.createDataFrame([([1.0, 2.0, 3.0, 4.0, 5.0],)], "p array<double>")
    with pytest.raises(Exception, match="4 elements expected, found 5"):
        df.select(arrays.square_rows("p", 2)).collect()
    empty = spark.createDataFrame([(None,)], "p array<double>")
    assert empty.select(arrays.square_rows("p", 2)).first()[0] is None


def test_value_lists_hold_every_value(spark):
    rows = [("b", 2.0), ("a", 1.0), ("a", 1.0), ("a", 0.5)]
    lists = aggregate.value_lists(spark.createDataFrame(rows, "k string, v double"), "k", "v")
    assert [tuple(r) for r in lists.collect()] == [("a", 0.5, 1), ("a", 1.0, 2), ("b", 2.0, 1)]


def test_top_cells_keep_the_total(spark, sf_dir):
    from shelfcast.sources.panel import known_rows

    known = known_rows(spark, sf_dir)
    total = known.agg(F.sum("label")).first()[0]
    assert aggregate.top_cells(known).agg(F.sum("sum_label")).first()[0] == total
