"""The seed rows of the dimensions.

They are built as SQL VALUES, so that the optimizer knows their exact size and
decides itself to broadcast them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schema import DIM_PAYMENT_TYPE, DIM_RATE_CODE, DIM_VENDOR

# The codes and texts of the three dimensions.
PAYMENT_TYPES: list[tuple[int, str]] = [
    (0, "Unknown / System Error"),
    (1, "Credit card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]
RATE_CODES: list[tuple[int, str]] = [
    (0, "Unknown"),
    (1, "Standard rate"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated fare"),
    (6, "Group ride"),
    (99, "Unknown"),
]
VENDORS: list[tuple[int, str]] = [
    (1, "Creative Mobile Technologies, LLC"),
    (2, "VeriFone Inc."),
]


def seed(spark: SparkSession, rows: Sequence[tuple], schema: T.StructType) -> DataFrame:
    """A small constant table of exactly known size."""
    args = {f"v{i}_{j}": value for i, row in enumerate(rows) for j, value in enumerate(row)}
    tuples = ["(" + ", ".join(f":v{i}_{j}" for j in range(len(row))) + ")" for i, row in enumerate(rows)]
    values = spark.sql(
        f"SELECT * FROM VALUES {', '.join(tuples)} AS seed({', '.join(schema.names)})", args=args
    )
    return values.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])


def dim_payment_type(spark: SparkSession) -> DataFrame:
    return seed(spark, PAYMENT_TYPES, DIM_PAYMENT_TYPE)


def dim_rate_code(spark: SparkSession) -> DataFrame:
    return seed(spark, RATE_CODES, DIM_RATE_CODE)


def dim_vendor(spark: SparkSession) -> DataFrame:
    return seed(spark, VENDORS, DIM_VENDOR)


def status_row(spark: SparkSession, text: str) -> DataFrame:
    """A one-row message: status."""
    return spark.range(1).select(F.lit(text).alias("status"))
