"""Trips derived from the ``events`` table, row by row.

The expressions are SQL that Spark and DuckDB both read, so the queries and their
SQL start from the same rows. ``TRIPS`` has the warehouse's names and unclean
values of every kind; ``RAW`` is a monthly file's layout with the same values.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

EVENT_COLUMNS = ["event_id", "ts", "user_id", "value"]

_AMOUNT = (
    "CASE WHEN event_id % 37 = 0 THEN CAST(-5 AS DOUBLE)"
    " WHEN event_id % 43 = 0 THEN CAST(0 AS DOUBLE)"
    " WHEN event_id % 47 = 0 THEN CAST(200 AS DOUBLE)"
    " ELSE CAST(3 AS DOUBLE) + CAST(0.75 AS DOUBLE) * value"
    " + CAST((7 * event_id) % 11 - 5 AS DOUBLE) END"
)
_DISTANCE = (
    "CASE WHEN event_id % 29 = 0 THEN CAST(0 AS DOUBLE)"
    " WHEN event_id % 31 = 0 THEN CAST(-1 AS DOUBLE)"
    " WHEN event_id % 53 = 0 THEN CAST(120 AS DOUBLE)"
    " ELSE value / CAST(4 AS DOUBLE) END"
)
_PASSENGERS = (
    "CASE WHEN event_id % 23 = 0 THEN NULL"
    " WHEN event_id % 19 = 0 THEN CAST(0 AS DOUBLE)"
    " ELSE CAST(event_id % 6 + 1 AS DOUBLE) END"
)
_RATE = (
    "CASE WHEN event_id % 41 = 0 THEN NULL"
    " WHEN event_id % 101 = 0 THEN CAST(42 AS DOUBLE)"
    " WHEN event_id % 103 = 0 THEN CAST(99 AS DOUBLE)"
    " ELSE CAST(event_id % 6 + 1 AS DOUBLE) END"
)
_PAYMENT = (
    "CASE WHEN event_id % 89 = 0 THEN NULL"
    " WHEN event_id % 97 = 0 THEN CAST(9 AS BIGINT)"
    " ELSE event_id % 7 END"
)

TRIPS: dict[str, str] = {
    "trip_id": "event_id",
    "vendor_id": "event_id % 2 + 1",
    "tpep_pickup_datetime": "ts",
    "passenger_count": _PASSENGERS,
    "trip_distance": _DISTANCE,
    "rate_code_id": _RATE,
    "payment_type_id": _PAYMENT,
    "total_amount": _AMOUNT,
}

RAW: dict[str, str] = {
    "VendorID": "event_id % 2 + 1",
    "tpep_pickup_datetime": "ts",
    "tpep_dropoff_datetime": "ts + (event_id % 50 + 5) * INTERVAL '1' MINUTE",
    "passenger_count": _PASSENGERS,
    "trip_distance": _DISTANCE,
    "RatecodeID": _RATE,
    "store_and_fwd_flag": (
        "CASE WHEN event_id % 59 = 0 THEN NULL WHEN event_id % 7 = 0 THEN 'Y' ELSE 'N' END"
    ),
    "PULocationID": "event_id % 263 + 1",
    "DOLocationID": "user_id % 263 + 1",
    "payment_type": _PAYMENT,
    "fare_amount": "CAST(0.5 AS DOUBLE) * value",
    "extra": "CAST(event_id % 3 AS DOUBLE)",
    "mta_tax": "CAST(0.5 AS DOUBLE)",
    "tip_amount": "CASE WHEN event_id % 61 = 0 THEN NULL ELSE CAST(0.25 AS DOUBLE) * value END",
    "tolls_amount": "CASE WHEN event_id % 13 = 0 THEN CAST(6.5 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
    "improvement_surcharge": "CAST(1 AS DOUBLE)",
    "total_amount": _AMOUNT,
    "congestion_surcharge": "CAST(2.5 AS DOUBLE)",
    "airport_fee": "CASE WHEN event_id % 17 = 0 THEN CAST(1.25 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END",
}

# Days on which the second, third and fourth of the monthly files begin.
STARTS = ("2024-01-08", "2024-01-15", "2024-01-22")


def sql(columns: dict[str, str]) -> str:
    return ", ".join(f"{text} AS {name}" for name, text in columns.items())


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _select(frame: DataFrame, columns: dict[str, str]) -> DataFrame:
    return frame.selectExpr(*[f"{text} AS {name}" for name, text in columns.items()])


def trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _select(table(spark, sf_dir, "events"), TRIPS)


def raw_trips(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events in a monthly file's layout, with their own key."""
    return _select(table(spark, sf_dir, "events"), {"trip_id": "event_id", **RAW})


def _month(events: DataFrame, number: int) -> DataFrame:
    ts = F.col("ts")
    bounds = [F.to_timestamp_ntz(F.lit(day)) for day in STARTS]
    kept: Column | None = None
    if number > 0:
        kept = ts >= bounds[number - 1]
    if number < len(bounds):
        below = ts < bounds[number]
        kept = below if kept is None else kept & below
    return _select(events.filter(kept), RAW)


def raw_months(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The events as four monthly files, each in its own layout."""
    events = table(spark, sf_dir, "events").select(*EVENT_COLUMNS)
    first, second, third, fourth = (_month(events, number) for number in range(4))
    second = (
        second.withColumn("VendorID", F.col("VendorID").cast("int"))
        .withColumn("passenger_count", F.col("passenger_count").cast("long"))
        .withColumnRenamed("airport_fee", "Airport_fee")
    )
    second = second.select(*reversed(second.columns))
    third = third.drop("airport_fee").withColumns(
        {name: F.concat(F.col(name).cast("string"), F.lit(".0")) for name in ("VendorID", "PULocationID")}
    )
    fourth = fourth.withColumnRenamed("airport_fee", "AIRPORT_FEE").withColumn(
        "tip_amount", F.coalesce(F.col("tip_amount").cast("string"), F.lit("n/a"))
    )
    return [first, second, third, fourth]


def write_raw_months(months: list[DataFrame], root: str) -> list[str]:
    """Write the monthly files below ``root``; returns their paths."""
    paths = [f"{root}/trips-{number}.parquet" for number in range(1, len(months) + 1)]
    for month, path in zip(months, paths):
        month.write.parquet(path)
    return paths
