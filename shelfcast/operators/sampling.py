"""Samples and splits. The hash forms pick the same rows on every engine and cluster."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from shelfcast.operators.indexing import with_position
from shelfcast.scratch import stage

# Fixed value: first hash byte (as hex) of the held-out rows; below it lie 230 of 256
# bytes, about 90 %.
HOLD_OUT_FROM = "e6"

# Largest sample that is picked in one task.
ROWS_IN_ONE_TASK = 100_000

# Fixed value: seed of the random splits.
SPLIT_SEED = 12345


def row_hash(keys: Sequence[str]) -> Column:
    """MD5 of the row's key fields."""
    return F.md5(F.concat_ws("|", *[F.col(k).cast("string") for k in keys]))


def with_part(df: DataFrame, keys: Sequence[str], hold_out_from: str = HOLD_OUT_FROM) -> DataFrame:
    """Add ``part``: ``train`` or ``test``, decided by the hash of the row's key. No shuffle."""
    is_train = F.substring(row_hash(keys), 1, 2) < F.lit(hold_out_from)
    return df.withColumn("part", F.when(is_train, "train").otherwise("test"))


def train_and_test(df: DataFrame, keys: Sequence[str], hold_out_from: str = HOLD_OUT_FROM) -> tuple[DataFrame, DataFrame]:
    parted = with_part(df, keys, hold_out_from)
    return (
        parted.where(F.col("part") == "train").drop("part"),
        parted.where(F.col("part") == "test").drop("part"),
    )


def with_random_part(df: DataFrame, train_share: float, seed: int = SPLIT_SEED) -> DataFrame:
    """Add ``part`` by a seeded random draw.

    The draw is written with its row. Two readings of an unwritten draw could see the
    rows in another order and put one into both parts or into neither.
    """
    drawn = stage(df.withColumn("_draw", F.rand(seed)), "drawn")
    part = F.when(F.col("_draw") < train_share, "train").otherwise("test")
    return drawn.withColumn("part", part).drop("_draw")


def hash_sample(
    df: DataFrame, keys: Sequence[str], size: int, in_one_task: int = ROWS_IN_ONE_TASK
) -> DataFrame:
    """``size`` rows, the first in hash order.

    For a small sample every task keeps its own first rows and one task picks among
    those. A large one is cut from the global order, which stays spread over the tasks.
    """
    hashed = df.withColumn("_hash", row_hash(keys))
    if size <= in_one_task:
        return hashed.orderBy("_hash", *keys).limit(size).drop("_hash")
    placed = with_position(hashed, ["_hash", *keys], "_position")
    return placed.where(F.col("_position") < size).drop("_hash", "_position")


def stratified_sample(panel: DataFrame, keys: Sequence[str], known_size: int, predict_size: int) -> DataFrame:
    """Sample of rows with a label and of rows to predict, in one table."""
    known = hash_sample(panel.where(F.col("label").isNotNull()), keys, known_size)
    unknown = hash_sample(panel.where(F.col("label").isNull()), keys, predict_size)
    return known.unionByName(unknown)


def stratified_fraction(panel: DataFrame, known_size: int, predict_size: int, seed: int = SPLIT_SEED) -> DataFrame:
    """Random sample of about the given sizes; the shares come from the stratum sizes."""
    marked = panel.withColumn("_known", F.col("label").isNotNull())
    sizes = {row["_known"]: row["n"] for row in marked.groupBy("_known").agg(F.count("*").alias("n")).collect()}
    wanted = {True: known_size, False: predict_size}
    shares = {known: min(1.0, wanted[known] / n) for known, n in sizes.items()}
    return marked.sampleBy("_known", shares, seed).drop("_known")
