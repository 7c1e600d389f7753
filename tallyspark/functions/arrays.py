"""Arrays and numbers: caps that say what they left out, roundings, quotients and logarithms of zero."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def capped(array: Column, most: int) -> Column:
    """struct(kept, left_out): the first ``most`` distinct elements, and how many more there are."""
    each = F.array_distinct(array)
    return F.struct(F.slice(each, 1, most).alias("kept"), F.greatest(F.size(each) - most, F.lit(0)).alias("left_out"))


def rounded(value: Column, places: int = 2, half_even: bool = False) -> Column:
    """A decimal to ``places``, halves away from zero or to the even neighbour, as a double; exact before that."""
    exact = value.cast("decimal(18,4)")
    return (F.bround(exact, places) if half_even else F.round(exact, places)).cast("double")


def quotient(a: Column, b: Column) -> Column:
    """``a / b`` of doubles as IEEE and DuckDB have it, where Spark's ``/`` raises on zero: infinite, or NaN for 0 / 0; null if either is."""
    sign = F.when(F.isnan(a) | (a == 0), "nan").when(a > 0, "inf").when(a < 0, "-inf").cast("double")
    return F.when(b != 0, a / b).when(b == 0, sign)


def logarithm(x: Column) -> Column:
    """The natural logarithm of a double as IEEE and DuckDB have it, where Spark's is null: minus infinity of zero, NaN below."""
    return F.when(x > 0, F.log(x)).when(x == 0, F.lit(float("-inf"))).when(x < 0, F.lit(float("nan")))


def scaled_round(x: Column, places: int) -> Column:
    """A double times a power of ten, rounded with halves away from zero and divided again, as DuckDB rounds; Spark's ``round`` goes by the printed digits."""
    return F.round(x * 10.0**places, 0) / 10.0**places
