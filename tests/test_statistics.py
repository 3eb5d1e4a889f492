"""Quantiles, positions, samples: checked against brute force, with a hot key."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.ml.feature import StringIndexer
from pyspark.sql import functions as F

from shelfcast.operators import sampling, skew
from shelfcast.operators.boxstats import box_statistics, quantiles, value_counts
from shelfcast.operators.indexing import category_index, with_category_numbers, with_position
from shelfcast.operators.skew import measured_join, spread_join


@pytest.fixture(scope="module")
def skewed():
    """One key holds a third of the rows; heavy tail, ties, nulls, a single-row key."""
    rng = random.Random(7)
    rows = [("hot", round(rng.expovariate(0.01), 1)) for _ in range(1000)]
    rows += [(f"k{i % 40}", float(rng.randint(-5, 5))) for i in range(2000)]
    return rows + [("one", 4.0), ("hot", None)]


def _groups(rows):
    groups = {}
    for k, v in rows:
        if v is not None:
            groups.setdefault(k, []).append(v)
    return groups


@pytest.mark.parametrize("in_memory", [1_000_000, 50, 3])
def test_box_statistics(spark, skewed, in_memory):
    df = spark.createDataFrame(skewed, "k string, v double")
    found = {r["k"]: r for r in box_statistics(df, ["k"], "v", in_memory).collect()}
    groups = _groups(skewed)
    assert set(found) == set(groups)
    for key, values in groups.items():
        q1, median, q3 = np.quantile(values, [0.25, 0.5, 0.75])
        inside = [v for v in values if q1 - 1.5 * (q3 - q1) <= v <= q3 + 1.5 * (q3 - q1)]
        row = found[key]
        assert row["n_values"] == len(values)
        assert [row["q1"], row["median"], row["q3"]] == pytest.approx([q1, median, q3])
        assert (row["whisker_low"], row["whisker_high"]) == (min(inside), max(inside))
        assert row["n_outliers"] == len(values) - len(inside)


@pytest.mark.parametrize("in_memory", [1_000_000, 5])
def test_quantiles_of_any_probability(spark, skewed, in_memory):
    df = spark.createDataFrame(skewed, "k string, v double")
    wanted = [0.0, 0.01, 0.333, 0.9, 1.0]
    counts = value_counts(df, ["k"], "v")
    for row in quantiles(counts, ["k"], wanted, in_memory).collect():
        expected = np.quantile(_groups(skewed)[row["k"]], wanted)
        assert list(row)[1:] == pytest.approx(list(expected))


def test_position_is_the_global_order(spark):
    values = random.Random(3).sample(range(10_000), 5000)
    df = spark.createDataFrame([(v,) for v in values], "v int").repartition(7)
    found = with_position(df, [F.desc("v")]).collect()
    assert {r["v"]: r["position"] for r in found} == {
        v: i for i, v in enumerate(sorted(values, reverse=True))
    }


def test_category_index_equals_string_indexer(spark):
    words = ["b", "a", "a", "c", "b", "d", "é", "Z", "a", None]
    df = spark.createDataFrame([(w, i % 3) for i, w in enumerate(words)], "w string, n int")
    index = category_index(df, ["w", "n"])
    for column in ("w", "n"):
        rows = index.where(F.col("column_name") == column).orderBy("idx").collect()
        model = StringIndexer(inputCol=column, outputCol="i", handleInvalid="skip").fit(df)
        assert [r["value"] for r in rows] == list(model.labels)
        assert [r["idx"] for r in rows] == list(range(len(rows)))
    numbered = with_category_numbers(df, index, ["w"], ["n"]).collect()
    labels = [r["value"] for r in index.where("column_name = 'w'").orderBy("idx").collect()]
    assert len(numbered) == len(words)
    assert all((labels[int(r["iw"])] if r["w"] is not None else None) == r["w"] for r in numbered)


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("lookup_rows", [3, 10**9])
def test_spread_join_equals_join(spark, skewed, how, lookup_rows):
    rows = spark.createDataFrame(skewed, "k string, v double")
    lookup = spark.createDataFrame([("hot", 1), ("k3", 2), ("absent", 3)], "k string, n int")
    spread = spread_join(rows, lookup, ["k"], ["v"], lookup_rows, how)
    plain = rows.join(lookup, "k", how)
    order = lambda df: sorted(map(str, df.select("k", "v", "n").collect()))
    assert order(spread) == order(plain)


@pytest.mark.parametrize("how", ["inner", "left"])
def test_measured_join_repeats_hot_keys_only(spark, skewed, how):
    rows = spark.createDataFrame([*skewed, *[(None, float(v)) for v in range(500)]], "k string, v double")
    lookup = spark.createDataFrame([("hot", 1), ("k3", 2), ("absent", 3), (None, 4)], "k string, n int")
    order = lambda df: sorted(map(str, df.select("k", "v", "n").collect()))
    plain = order(rows.join(lookup, "k", how))
    for share in (0.5, 0.1):
        assert order(measured_join(rows, lookup, ["k"], ["v"], hot_share=share, plain_rows=0, how=how)) == plain


def test_category_numbers_do_not_repeat_a_large_index(spark, monkeypatch):
    """Evenly frequent categories: the index is joined as it is, not once a salt."""
    df = spark.range(6000).select(F.col("id").alias("n"), (F.col("id") % 2000).cast("string").alias("w"))
    index = category_index(df, ["w"]).cache()
    monkeypatch.setattr(skew, "PLAIN_LOOKUP_ROWS", 0)
    numbered = with_category_numbers(df, index, ["w"], ["n"])
    assert "Generate" not in numbered._jdf.queryExecution().executedPlan().toString()
    assert numbered.where("iw IS NOT NULL").count() == 6000


def test_large_lookups_are_merged_in_parts(spark, skewed, monkeypatch):
    df = spark.createDataFrame(skewed, "k string, v double")
    plain = box_statistics(df, ["k"], "v").orderBy("k").collect()
    monkeypatch.setattr(skew, "PLAIN_LOOKUP_ROWS", 0)
    spread = box_statistics(df, ["k"], "v", in_memory=5)
    plan = spread._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert [tuple(r) for r in spread.orderBy("k").collect()] == [tuple(r) for r in plain]


def test_hash_split_is_disjoint_and_complete(spark):
    df = spark.range(20_000)
    train, test = sampling.train_and_test(df, ["id"])
    assert train.count() + test.count() == 20_000
    assert train.join(test, "id", "left_semi").count() == 0
    assert 0.88 < train.count() / 20_000 < 0.92


def test_random_split_is_disjoint_and_complete(spark):
    parted = sampling.with_random_part(spark.range(10_000), 0.7, seed=5)
    assert parted.select("id").distinct().count() == parted.count() == 10_000
    assert 0.67 < parted.where("part = 'train'").count() / 10_000 < 0.73


def test_large_sample_equals_small_sample(spark):
    df = spark.range(5000).repartition(9)
    picked = sampling.hash_sample(df, ["id"], 700)
    spread = sampling.hash_sample(df, ["id"], 700, in_one_task=10)
    assert {r["id"] for r in picked.collect()} == {r["id"] for r in spread.collect()}
    assert spread.columns == ["id"] and spread.count() == 700


def test_stratified_samples(spark):
    panel = spark.range(3000).withColumn("label", F.when(F.col("id") % 3 > 0, 1.0))
    sample = sampling.stratified_sample(panel, ["id"], 200, 50)
    assert sample.where("label is not null").count() == 200
    assert sample.where("label is null").count() == 50
    again = sampling.stratified_sample(panel.repartition(13), ["id"], 200, 50)
    assert {r["id"] for r in sample.collect()} == {r["id"] for r in again.collect()}
    whole = sampling.stratified_sample(panel, ["id"], 10_000, 10_000)
    assert whole.count() == 3000
    fraction = sampling.stratified_fraction(panel, 10_000, 100)
    assert fraction.where("label is not null").count() == 2000
    assert 60 < fraction.where("label is null").count() < 140
