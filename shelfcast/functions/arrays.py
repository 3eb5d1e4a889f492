"""Image rows held as arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column, functions as F


def scaled(pixels: Column | str, divisor: float = 255.0) -> Column:
    """Every element divided by ``divisor``."""
    return F.transform(pixels, lambda v: v / F.lit(divisor))


def sliced(pixels: Column | str, start: int, length: int) -> Column:
    """``length`` elements from 0-based position ``start``."""
    return F.slice(pixels, start + 1, length)


def square_rows(pixels: Column | str, side: int) -> Column:
    """Array of side*side elements as an array of ``side`` rows.

    Another number of elements raises an error; a null array stays null.
    """
    rows = F.transform(
        F.sequence(F.lit(0), F.lit(side - 1)),
        lambda r: F.slice(pixels, r * side + 1, side),
    )
    size = F.array_size(pixels)
    wrong = F.concat(F.lit(f"{side * side} elements expected, found "), size.cast("string"))
    return F.when(size == side * side, rows).when(size.isNotNull(), F.raise_error(wrong))


def first_positive(pixels: Column | str) -> Column:
    """0-based position of the first element above zero; 0 when there is none."""
    lit = F.transform(pixels, lambda v: v > 0)
    return F.greatest(F.array_position(lit, True) - 1, F.lit(0))


def last_positive(pixels: Column | str) -> Column:
    """Like ``first_positive``, counted from the right end."""
    return first_positive(F.reverse(pixels))
