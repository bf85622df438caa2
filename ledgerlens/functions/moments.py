"""Means and deviations that do not depend on the order of the rows.

A sum of doubles changes in its last digits with the partitions and with the
task that ends first.  Here values become DECIMAL first, whose sums are exact
however they are merged; only the last step, from the sums to the mean and
the deviation, is in doubles, and sees the same numbers every time.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

DIGITS = 12  #: decimal places kept of a value that is a ratio


def fixed(c: Column | str, places: int = DIGITS, digits: int = 30) -> Column:
    """``c`` with ``places`` decimal places; NULL stays NULL, and so does a
    value without a decimal form (NaN)."""
    return (F.col(c) if isinstance(c, str) else c).try_cast(f"decimal({digits},{places})")


def exact_avg(c: Column | str, places: int = DIGITS) -> Column:
    """Aggregate expression: the mean of ``c`` from an exact sum (double)."""
    return F.try_divide(F.sum(fixed(c, places)).cast("double"), F.count(fixed(c, places)))


def spread(n: Column, total: Column, squares: Column) -> tuple[Column, Column]:
    """Mean and population deviation from a count, a sum and a sum of squares.

    The difference of the two terms loses digits only where the deviation
    is far below the mean (from about a millionth of it)."""
    n, total, squares = n.cast("double"), total.cast("double"), squares.cast("double")
    mean = F.try_divide(total, n)
    return mean, F.sqrt(F.when(n > 0, F.greatest(squares / n - mean * mean, F.lit(0.0))))


def scalar_spread(df: DataFrame, cols: Sequence[Column | str], places: int = 6) -> list[tuple[Column, Column]]:
    """(mean, deviation) of each of ``cols`` over all of ``df``, as scalar
    subqueries; Spark merges them into one aggregate over ``df``."""
    out = []
    for c in cols:
        value = fixed(c, places, 22)
        one = lambda agg: df.agg(agg).scalar()
        out.append(spread(one(F.count(value)), one(F.sum(value)), one(F.sum(value * value))))
    return out
