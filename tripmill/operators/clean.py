"""Row-level cleaning."""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripmill.functions import predicates as P


def fill_missing(df: DataFrame, column: str, value: float) -> DataFrame:
    """Replace NULL, and NaN in a floating column, by ``value``."""
    return df.na.fill(value, subset=[column])


def clean_trips(
    df: DataFrame,
    distance: str = "trip_distance",
    amount: str = "total_amount",
    passengers: str = "passenger_count",
) -> DataFrame:
    """Trips with a positive distance, no negative amount and at least one
    passenger, where an unknown passenger count means one.

    The fill comes before the last filter, so unknown counts survive it and zero
    does not. Narrow: no shuffle, and the first two filters reach the scan.
    """
    kept = df.filter(P.positive(distance)).filter(P.non_negative(amount))
    return fill_missing(kept, passengers, 1).filter(P.positive(passengers))
