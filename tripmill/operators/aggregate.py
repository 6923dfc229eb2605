"""Grouped and global reports.

Every group-by here is combined before its shuffle, so a key that holds a third
of the rows sends one row per task like any other key.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripmill.functions import expressions as X

# The chart's labels; they differ from the dimension's texts.
CHART_LABELS: dict[int, str] = {
    1: "Credit Card",
    2: "Cash",
    3: "No Charge",
    4: "Dispute",
    0: "Unknown",
    5: "Unknown",
}
CHART_DEFAULT = "Autre"


def kpi(df: DataFrame, amount: str = "total_amount", distance: str = "trip_distance") -> DataFrame:
    """One row: total_revenue, avg_distance, total_trips."""
    return df.agg(
        F.sum(amount).alias("total_revenue"),
        F.avg(distance).alias("avg_distance"),
        F.count(F.lit(1)).alias("total_trips"),
    )


def kpi_text(kpis: DataFrame) -> DataFrame:
    """The KPI row as the texts a report shows."""
    return kpis.select(
        X.money_text(F.col("total_revenue")).alias("total_revenue"),
        X.miles_text(F.col("avg_distance")).alias("avg_distance"),
        X.count_text(F.col("total_trips")).alias("total_trips"),
    )


def hour_of_day(ts: str) -> Column:
    return F.hour(ts).cast("long")


def hourly_counts(df: DataFrame, ts: str = "tpep_pickup_datetime") -> DataFrame:
    """Rows per hour of day, in order: hour, counts."""
    return df.groupBy(hour_of_day(ts).alias("hour")).agg(
        F.count(F.lit(1)).alias("counts")
    ).orderBy("hour")


def counts_by(df: DataFrame, *columns: str) -> DataFrame:
    """Rows per value; NULL is a value of its own."""
    return df.groupBy(*columns).agg(F.count(F.lit(1)).alias("counts"))


def label_counts(
    counts: DataFrame,
    code: str = "payment_type_id",
    name: str = "payment_name",
    labels: Mapping[int, str] = CHART_LABELS,
    default: str = CHART_DEFAULT,
) -> DataFrame:
    """Add the label of each code to a counts table."""
    return counts.withColumn(name, X.label(F.col(code), labels, default))


def roll_up(counts: DataFrame, name: str = "payment_name") -> DataFrame:
    """Sum a counts table per label: codes that share a label become one row."""
    return counts.groupBy(name).agg(F.sum("counts").alias("counts"))


def share_of_total(counts: DataFrame) -> DataFrame:
    """Add each row's share of all counts.

    The total is a scalar subquery over the same counts, whose shuffle Spark
    reuses: the source is read once and nothing is joined.
    """
    total = counts.agg(F.sum("counts")).scalar()
    return counts.withColumn("share", F.col("counts") / total)


def histogram(df: DataFrame, column: str, low: float, high: float, bins: int) -> DataFrame:
    """Rows per equal-width bin of [low, high]: bin, bin_low, counts.

    Every bin has a row, also an empty one. Values outside the range are left
    out; ``high`` itself is in the last bin.
    """
    found = (
        df.select(X.bin_index(F.col(column), low, high, bins).alias("bin"))
        .filter(F.col("bin").isNotNull())
        .groupBy("bin")
        .agg(F.count(F.lit(1)).alias("counts"))
    )
    return fill_bins(found, low, high, bins)


def fill_bins(found: DataFrame, low: float, high: float, bins: int) -> DataFrame:
    """Complete a (bin, counts) table to all ``bins`` bins, in order."""
    every = found.sparkSession.range(bins).withColumnRenamed("id", "bin")
    return (
        every.join(found, "bin", "left")
        .select(
            "bin",
            X.bin_edge(F.col("bin"), low, high, bins).alias("bin_low"),
            F.coalesce("counts", F.lit(0).cast("long")).alias("counts"),
        )
        .orderBy("bin")
    )


def nice_histogram(df: DataFrame, column: str, most_bins: int = 50) -> DataFrame:
    """Rows per bin of a readable width, at most ``most_bins`` of them: bin, bin_low, bin_high,
    counts, in order, empty bins too.

    The range is the column's own and the width follows from it (1, 2 or 5 times a power of
    ten); bins begin at multiples of the width and hold their lower edge. NULL and NaN are
    left out; no value at all gives no bin. Two passes over one column: its ends are a scalar
    subquery of the count.
    """
    value = F.col(column).cast("double")
    values = df.select(value.alias("value")).filter(~F.isnan("value"))
    ends = values.agg(F.min("value").alias("low"), F.max("value").alias("high"))
    scale = ends.select(
        "low", "high", X.nice_width(F.col("low"), F.col("high"), most_bins).alias("width")
    ).select(
        "width", F.floor(F.col("low") / F.col("width")).alias("first"), F.floor(F.col("high") / F.col("width")).alias("last")
    )
    width = scale.select("width").scalar()
    found = values.groupBy(F.floor(F.col("value") / width).alias("place")).agg(F.count(F.lit(1)).alias("counts"))
    every = scale.filter("width IS NOT NULL").select(
        "width", "first", F.explode(F.sequence("first", "last")).alias("place")
    )
    return (
        every.join(found, "place", "left")
        .select(
            (F.col("place") - F.col("first")).alias("bin"),
            (F.col("place") * F.col("width")).alias("bin_low"),
            ((F.col("place") + 1) * F.col("width")).alias("bin_high"),
            F.coalesce("counts", F.lit(0).cast("long")).alias("counts"),
        )
        .orderBy("bin")
    )


def preview(df: DataFrame, n: int = 5, order_by: str | None = None) -> DataFrame:
    """A few whole rows; any ones, or the first by ``order_by``."""
    return (df.orderBy(order_by) if order_by else df).limit(n)
