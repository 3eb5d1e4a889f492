"""Column expressions over panel fields."""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def truncated_int(c: Column | str) -> Column:
    """Integer part of a number; null when it does not fit an int."""
    return _column(c).try_cast("int")


def non_negative(c: Column | str) -> Column:
    """Negative values become 0; null stays null (``greatest`` would make it 0)."""
    value = _column(c)
    return F.when(value < 0, F.lit(0)).otherwise(value)


def horizon_offset(day: Column | str, cut: int) -> Column:
    """Days since the last day before the horizon: 1 is its first day."""
    return _column(day) - F.lit(cut)


def joined_id(parts: Sequence[Column | str], suffix: str | None = None) -> Column:
    """Parts joined by ``_``; null when a part is null."""
    pieces: list[Column] = []
    for part in parts:
        pieces += [_column(part), F.lit("_")]
    pieces = pieces[:-1] if suffix is None else pieces + [F.lit(suffix)]
    return F.concat(*pieces)


def text_key(parts: Sequence[Column | str]) -> Column:
    """Parts joined by ``_``; a null part is written as ``None``."""
    return F.concat_ws("_", *[F.coalesce(_column(p).cast("string"), F.lit("None")) for p in parts])


def padded_number(c: Column | str, width: int) -> Column:
    """Number as text with leading zeros; longer numbers are not cut."""
    value = _column(c)
    text = value.cast("string")
    return F.when(F.length(text) < width, F.lpad(text, width, "0")).otherwise(text)


def box_labels() -> dict[str, Column]:
    """Grouping name -> label text, for each grouping the distributions are drawn by."""
    return {
        "month": padded_number("month", 2),
        "year": padded_number("year", 4),
        "store_snap": F.concat_ws(" ", "store_id", F.col("snap").cast("string")),
        "store_ram": F.concat_ws(" ", "store_id", F.col("flag_ram").cast("string")),
        "store": F.col("store_id"),
        "wday": padded_number("wday", 2),
        "dept": F.col("dept_id"),
        "dept_snap": F.concat_ws(" ", "dept_id", F.col("snap").cast("string")),
        "dept_ram": F.concat_ws(" ", "dept_id", F.col("flag_ram").cast("string")),
    }


def squared_error(predicted: Column | str, actual: Column | str) -> Column:
    """Squared error; null when either side is null."""
    return F.pow(_column(predicted) - _column(actual), F.lit(2))


def squared_error_or_default(predicted: Column | str, actual: Column | str) -> Column:
    """Squared error where no prediction costs nothing and a missing actual counts as 0."""
    p, a = _column(predicted), _column(actual)
    return F.when(p.isNull(), F.lit(0.0)).otherwise(F.pow(p - F.coalesce(a, F.lit(0.0)), F.lit(2)))


def null_count(columns: Iterable[str]) -> Column:
    """How many of the columns are null in the row."""
    return reduce(lambda a, b: a + b, [F.col(c).isNull().cast("int") for c in columns])


def row_values(columns: Iterable[str]) -> Column:
    """The row's values as an array of text."""
    return F.array(*[F.col(c).cast("string") for c in columns])


def scaled_class(c: Column | str, factor: int = 10) -> Column:
    """Class number of a measured value: scaled, then truncated."""
    return truncated_int(_column(c) * F.lit(factor))


def prefixed(df: DataFrame, prefix: str, keep: Iterable[str]) -> DataFrame:
    """Put ``prefix`` before every column name that is not in ``keep``."""
    kept = set(keep)
    return df.withColumnsRenamed({c: f"{prefix}{c}" for c in df.columns if c not in kept})
