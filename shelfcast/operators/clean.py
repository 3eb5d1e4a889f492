"""Missing values."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from shelfcast.functions.columns import null_count


def known(df: DataFrame, column: str = "label") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def to_predict(df: DataFrame, column: str = "label") -> DataFrame:
    return df.where(F.col(column).isNull())


def filled(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    return df.fillna(value, subset=list(columns))


def with_null_count(df: DataFrame, name: str = "nullcnt") -> DataFrame:
    """Add the number of null columns of each row."""
    return df.withColumn(name, null_count(df.columns))


def rows_with_nulls(df: DataFrame) -> DataFrame:
    """One row: how many rows have at least one null."""
    return df.where(null_count(df.columns) > 0).agg(F.count("*").alias("n_rows"))


def per_column(df: DataFrame, measures: dict[str, dict]) -> DataFrame:
    """Long table from one wide aggregate row.

    ``measures`` maps an output name to {column: aggregate}; every output name has the
    same columns. The table is read once whatever the number of columns.
    """
    columns = list(next(iter(measures.values())))
    wide = df.agg(
        *[
            by_column[c].alias(f"_{name}_{i}")
            for name, by_column in measures.items()
            for i, c in enumerate(columns)
        ]
    )
    rows = [
        F.struct(
            F.lit(c).alias("column_name"), *[F.col(f"_{name}_{i}").alias(name) for name in measures]
        )
        for i, c in enumerate(columns)
    ]
    return wide.select(F.inline(F.array(*rows)))


def missing_by_column(df: DataFrame) -> DataFrame:
    """Rows and missing values of every column."""
    return per_column(
        df,
        {
            "n_rows": {c: F.count("*") for c in df.columns},
            "n_missing": {c: F.count_if(F.col(c).isNull()) for c in df.columns},
        },
    )
