"""Bins, labels, even grids, lines and number formats."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F


def bin_index(value: Column, low: float, high: float, bins: int) -> Column:
    """Index 0..bins-1 of the equal-width bin of ``value``; ``high`` falls in the
    last one. Values outside [low, high], NaN and NULL have no bin (NULL)."""
    width = (high - low) / bins
    index = F.least(F.floor((value - F.lit(low)) / F.lit(width)), F.lit(bins - 1).cast("long"))
    return F.when(value.between(F.lit(low), F.lit(high)), index)


def bin_edge(index: Column, low: float, high: float, bins: int) -> Column:
    """Lower edge of a bin."""
    return F.lit(low) + index * F.lit((high - low) / bins)


# Steps of a readable scale within a power of ten, and into the next.
NICE_STEPS = (1, 2, 5, 10, 20, 50)


def nice_width(low: Column, high: Column, most: int) -> Column:
    """The smallest width of 1, 2 or 5 times a power of ten for which bins that begin at its
    multiples cover [low, high] with at most ``most`` of them. 1 if the range is one value."""
    if most < 1:
        raise ValueError("there is one bin at least")
    span = high - low
    power = F.floor(F.log10(span / F.lit(float(most))))
    # Divided by a power of ten, a width below 1 is the double closest to it.
    widths = F.transform(
        F.array(*[F.lit(float(step)) for step in NICE_STEPS]),
        lambda step: F.when(power >= 0, step * F.pow(F.lit(10.0), power)).otherwise(step / F.pow(F.lit(10.0), -power)),
    )
    fitting = F.filter(widths, lambda width: F.floor(high / width) - F.floor(low / width) < F.lit(most))
    return F.when(span > 0, F.get(fitting, F.lit(0))).when(span == 0, F.lit(1.0))


def label(code: Column, labels: Mapping[int, str], default: str) -> Column:
    """The text of a code; ``default`` for any other code and for NULL."""
    out = F.when(F.lit(False), F.lit(default))
    for key, text in labels.items():
        out = out.when(code == F.lit(key), F.lit(text))
    return out.otherwise(F.lit(default))


def grid_point(index: Column, low: float, high: float, points: int) -> Column:
    """The ``index``-th of ``points`` evenly spaced values, both ends included."""
    return F.lit(low) + index * F.lit((high - low) / (points - 1))


def line(x: Column, coef: Column, intercept: Column) -> Column:
    return coef * x + intercept


def money_text(value: Column) -> Column:
    """``$1,234.50``"""
    return F.concat(F.lit("$"), F.format_number(value, 2))


def miles_text(value: Column) -> Column:
    """``14.50 miles``"""
    return F.format_string("%.2f miles", value)


def count_text(value: Column) -> Column:
    """``8,576``"""
    return F.format_number(value, 0)
