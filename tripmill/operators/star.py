"""From lake rows to the star schema and back to readable rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schema import FACT_TRIPS, WAREHOUSE_NAMES


def to_warehouse(
    df: DataFrame,
    names: Mapping[str, str] = WAREHOUSE_NAMES,
    schema: T.StructType = FACT_TRIPS,
    keep: Sequence[str] = (),
) -> DataFrame:
    """Rename to the warehouse's names and types, in the order of its table.

    A fractional value going to an integer column is rounded to the nearest even,
    as the database does on insert; an overflow is an error under ANSI mode.
    A generated key that the frame lacks is left to the sink. ``keep`` passes
    further columns through.
    """
    renamed = df.withColumnsRenamed(dict(names))
    types = {field.name.lower(): field.dataType for field in renamed.schema.fields}
    columns = []
    for field in schema.fields:
        source = types.get(field.name.lower())
        if source is None:
            if field.nullable:
                raise ValueError(f"column {field.name} is missing")
            continue
        column = field.name
        if source != field.dataType:
            if isinstance(field.dataType, T.IntegralType) and isinstance(source, T.FractionalType):
                column = f"rint({column})"
            column = f"CAST({column} AS {field.dataType.simpleString()})"
        columns.append(f"{column} AS {field.name}")
    return renamed.selectExpr(*columns, *[f"`{name}`" for name in keep])


def with_surrogate_key(df: DataFrame, name: str = "trip_id", start: int = 0) -> DataFrame:
    """Add a unique, not dense, key in front: ``start`` plus partition and row number.

    No shuffle and no single task. When appending, pass one more than the largest
    key already there.
    """
    key = F.monotonically_increasing_id() + F.lit(start).cast("long")
    return df.select(key.alias(name), "*")


def enrich_trips(
    fact: DataFrame, payment_types: DataFrame, rate_codes: DataFrame, vendors: DataFrame
) -> DataFrame:
    """Add the text of the three dimensions; unknown and NULL codes get NULL.

    The seed dimensions carry their exact size, so Spark broadcasts them and the
    fact is not shuffled; a dimension too large for that gets a shuffled join.
    """
    return (
        fact.join(payment_types, "payment_type_id", "left")
        .join(rate_codes, "rate_code_id", "left")
        .join(vendors, "vendor_id", "left")
    )
