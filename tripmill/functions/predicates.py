"""The row conditions of the trip rules."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def positive(name: str) -> Column:
    """Strictly above zero. NULL is dropped; NaN sorts above all numbers and stays."""
    return F.col(name) > 0


def non_negative(name: str) -> Column:
    return F.col(name) >= 0


def within_closed(name: str, low: float, high: float) -> Column:
    """``low <= name <= high``, both ends kept."""
    return F.col(name).between(F.lit(low), F.lit(high))


def within_open(name: str, low: float, high: float) -> Column:
    """``low < name < high``, both ends dropped."""
    return (F.col(name) > F.lit(low)) & (F.col(name) < F.lit(high))


def standard_trip(
    distance: str = "trip_distance",
    amount: str = "total_amount",
    max_distance: float = 100.0,
    max_amount: float = 200.0,
) -> Column:
    """The trips without outliers: the same rule for scatter samples and training."""
    return within_open(distance, 0.0, max_distance) & within_open(amount, 0.0, max_amount)


def is_missing(name: str, floating: bool) -> Column:
    """NULL, or NaN where the type has one."""
    col = F.col(name)
    return (col.isNull() | F.isnan(col)) if floating else col.isNull()
