"""Column names and types of the trip files and of the star schema."""

from __future__ import annotations

from pyspark.sql import types as T

# The columns of a monthly trip file that are brought to one type.
TRIP_CASTS: dict[str, T.DataType] = {
    "VendorID": T.LongType(),
    "passenger_count": T.DoubleType(),
    "trip_distance": T.DoubleType(),
    "RatecodeID": T.DoubleType(),
    "PULocationID": T.LongType(),
    "DOLocationID": T.LongType(),
    "payment_type": T.LongType(),
    "fare_amount": T.DoubleType(),
    "extra": T.DoubleType(),
    "mta_tax": T.DoubleType(),
    "tip_amount": T.DoubleType(),
    "tolls_amount": T.DoubleType(),
    "improvement_surcharge": T.DoubleType(),
    "total_amount": T.DoubleType(),
    "congestion_surcharge": T.DoubleType(),
    "airport_fee": T.DoubleType(),
}

# Columns that older files lack, with the value they get there.
TRIP_DEFAULTS: dict[str, float] = {"airport_fee": 0.0}

# Lake name -> warehouse name.
WAREHOUSE_NAMES: dict[str, str] = {
    "VendorID": "vendor_id",
    "RatecodeID": "rate_code_id",
    "PULocationID": "pulocationid",
    "DOLocationID": "dolocationid",
    "payment_type": "payment_type_id",
}

# The fact table and its three dimensions.
FACT_TRIPS = T.StructType(
    [
        T.StructField("trip_id", T.LongType(), False),
        T.StructField("vendor_id", T.IntegerType()),
        T.StructField("tpep_pickup_datetime", T.TimestampNTZType()),
        T.StructField("tpep_dropoff_datetime", T.TimestampNTZType()),
        T.StructField("passenger_count", T.IntegerType()),
        T.StructField("trip_distance", T.DoubleType()),
        T.StructField("rate_code_id", T.IntegerType()),
        T.StructField("store_and_fwd_flag", T.StringType()),
        T.StructField("pulocationid", T.IntegerType()),
        T.StructField("dolocationid", T.IntegerType()),
        T.StructField("payment_type_id", T.IntegerType()),
        T.StructField("fare_amount", T.DoubleType()),
        T.StructField("extra", T.DoubleType()),
        T.StructField("mta_tax", T.DoubleType()),
        T.StructField("tip_amount", T.DoubleType()),
        T.StructField("tolls_amount", T.DoubleType()),
        T.StructField("improvement_surcharge", T.DoubleType()),
        T.StructField("total_amount", T.DoubleType()),
        T.StructField("congestion_surcharge", T.DoubleType()),
        T.StructField("airport_fee", T.DoubleType()),
    ]
)

DIM_PAYMENT_TYPE = T.StructType(
    [
        T.StructField("payment_type_id", T.IntegerType(), False),
        T.StructField("payment_name", T.StringType()),
    ]
)
DIM_RATE_CODE = T.StructType(
    [
        T.StructField("rate_code_id", T.IntegerType(), False),
        T.StructField("rate_description", T.StringType()),
    ]
)
DIM_VENDOR = T.StructType(
    [
        T.StructField("vendor_id", T.IntegerType(), False),
        T.StructField("vendor_name", T.StringType()),
    ]
)

# Bounds of the VARCHAR columns above.
TEXT_BOUNDS: dict[str, int] = {
    "payment_name": 50,
    "rate_description": 100,
    "vendor_name": 100,
    "store_and_fwd_flag": 5,
}
