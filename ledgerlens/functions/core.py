"""Scalar and predicate helpers.

All helpers return native ``Column`` expressions, so they stay inside
whole-stage codegen.  No Python UDF is involved.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

__all__ = [
    "not_cancelled", "bin_right",
    "label_order", "clamp", "week_w", "year_week", "weekday_name", "month_label",
    "ym", "month_offset", "month_number", "days_between", "sigmoid",
]


def not_cancelled(orders: DataFrame, nulls: str = "drop") -> DataFrame:
    """FLT1 ``status != 'Cancelled'``.

    ``nulls='drop'`` is the SQL rule (NULL status is dropped), ``'keep'`` the
    pandas rule (NULL status is kept).
    """
    cond = F.col("status") != "Cancelled"
    if nulls == "keep":
        cond = cond | F.col("status").isNull()
    elif nulls != "drop":
        raise ValueError("nulls must be 'drop' or 'keep'")
    return orders.filter(cond)


def bin_right(c: Column, edges: Sequence[float], labels: Sequence[str]) -> Column:
    """``pd.cut(c, edges, labels)``: right-closed bins ``(lo, hi]``.

    Values outside every bin and NULLs get NULL.  (ML ``Bucketizer`` is
    left-closed, so it is not used.)
    """
    if len(edges) != len(labels) + 1:
        raise ValueError("need len(labels) + 1 edges")
    out = None
    for lo, hi, lab in zip(edges[:-1], edges[1:], labels):
        cond = (c > F.lit(lo)) & (c <= F.lit(hi))
        out = F.when(cond, F.lit(lab)) if out is None else out.when(cond, F.lit(lab))
    return out


def label_order(c: Column, labels: Sequence[str]) -> Column:
    """Ordinal (1-based) of a label in a fixed label order, for sorting;
    NULL for a label outside the list."""
    pos = F.array_position(F.array(*[F.lit(x) for x in labels]), c).cast("int")
    return F.when(pos > 0, pos)


def clamp(c: Column, lower=None, upper=None) -> Column:
    """``clip(lower, upper)``; NULL stays NULL."""
    out = c
    if lower is not None:
        out = F.when(out.isNull(), None).otherwise(F.greatest(out, F.lit(lower)))
    if upper is not None:
        out = F.when(out.isNull(), None).otherwise(F.least(out, F.lit(upper)))
    return out


def week_w(d: Column) -> Column:
    """``strftime('%W', d)``: Monday-based week of year, ``00``-``53``.

    Days before the first Monday of the year are week 00.  ``weekday`` is
    0 for Monday.
    """
    n = F.floor((F.dayofyear(d) + F.lit(6) - F.weekday(d)) / F.lit(7)).cast("int")
    return F.lpad(n.cast("string"), 2, "0")


def year_week(d: Column) -> Column:
    """``strftime('%Y-W%W', d)`` (a week is split at New Year)."""
    return F.concat(F.date_format(d, "yyyy"), F.lit("-W"), week_w(d))


def weekday_name(d: Column) -> Column:
    return F.date_format(d, "EEEE")


def month_label(d: Column) -> Column:
    """``strftime('%b %Y')``, e.g. ``Jan 2024``."""
    return F.date_format(d, "MMM yyyy")


def ym(d: Column) -> Column:
    """``strftime('%Y-%m')``."""
    return F.date_format(d, "yyyy-MM")


def month_offset(later: Column, earlier: Column) -> Column:
    """Whole calendar months between two dates: (Y2-Y1)*12 + (M2-M1)."""
    return ((F.year(later) - F.year(earlier)) * 12 + (F.month(later) - F.month(earlier))).cast("int")


def month_number(d: Column, base_year: int) -> Column:
    """Running month number ``(year - base_year) * 12 + month``."""
    return ((F.year(d) - F.lit(base_year)) * 12 + F.month(d)).cast("int")


def days_between(later: Column, earlier: Column) -> Column:
    return F.datediff(later, earlier)


def sigmoid(z: Column) -> Column:
    """``1 / (1 + exp(-clip(z, -500, 500)))``."""
    return F.lit(1.0) / (F.lit(1.0) + F.exp(-F.greatest(F.least(z, F.lit(500.0)), F.lit(-500.0))))


def rnd(c: Column | str, places: int = 2) -> Column:
    """Round half-up to ``places`` and return double.

    The value first goes through DECIMAL(38,6), so doubles and decimals are
    rounded the same way (exact half-up on the decimal digits).  A value that
    has no decimal form (NaN, infinity, overflow) becomes NULL instead of
    failing the job under ANSI casts."""
    c = F.col(c) if isinstance(c, str) else c
    return F.round(c.try_cast("decimal(38,6)"), places).cast("double")


__all__.append("rnd")
