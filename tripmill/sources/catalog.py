"""The star schema as tables of the session catalog, and the report panels as SQL.

Tables are declared with their types, keys as NOT NULL and texts as VARCHAR, whose bounds
Spark checks on insert; dimensions are seeded with ``INSERT ... VALUES``. A session without a
metastore keeps the declarations in memory, and the rows in the database's folder.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from tripmill.schema import DIM_PAYMENT_TYPE, DIM_RATE_CODE, DIM_VENDOR, FACT_TRIPS, TEXT_BOUNDS
from tripmill.sources.dimensions import PAYMENT_TYPES, RATE_CODES, VENDORS

TABLES: dict[str, T.StructType] = {
    "dim_payment_type": DIM_PAYMENT_TYPE,
    "dim_rate_code": DIM_RATE_CODE,
    "dim_vendor": DIM_VENDOR,
    "fact_trips": FACT_TRIPS,
}
SEEDS: dict[str, list[tuple]] = {
    "dim_payment_type": PAYMENT_TYPES,
    "dim_rate_code": RATE_CODES,
    "dim_vendor": VENDORS,
}

# The panels, over the tables of the current database.
PANELS: dict[str, str] = {
    "kpi": """
        SELECT sum(total_amount) AS total_revenue, avg(trip_distance) AS avg_distance, count(*) AS total_trips
        FROM fact_trips""",
    "hourly_counts": """
        SELECT CAST(hour(tpep_pickup_datetime) AS BIGINT) AS hour, count(*) AS counts
        FROM fact_trips GROUP BY 1 ORDER BY 1""",
    "payment_counts": """
        SELECT f.payment_type_id, d.payment_name, count(*) AS counts
        FROM fact_trips f LEFT JOIN dim_payment_type d USING (payment_type_id)
        GROUP BY f.payment_type_id, d.payment_name""",
    "rate_counts": """
        SELECT f.rate_code_id, d.rate_description, count(*) AS counts, avg(f.total_amount) AS avg_amount
        FROM fact_trips f LEFT JOIN dim_rate_code d USING (rate_code_id)
        GROUP BY f.rate_code_id, d.rate_description""",
    "vendor_counts": """
        SELECT v.vendor_name, count(f.trip_id) AS counts
        FROM dim_vendor v LEFT JOIN fact_trips f USING (vendor_id)
        GROUP BY v.vendor_name""",
    "amount_histogram": """
        SELECT b.bin, count(f.total_amount) AS counts
        FROM (SELECT explode(sequence(0L, 49L)) AS bin) b
        LEFT JOIN (
            SELECT total_amount, CAST(least(floor(total_amount / 4), 49) AS BIGINT) AS bin
            FROM fact_trips WHERE total_amount BETWEEN 0 AND 200
        ) f USING (bin)
        GROUP BY b.bin""",
    "scatter": """
        SELECT trip_distance, total_amount FROM fact_trips
        WHERE trip_distance > 0 AND trip_distance < 100 AND total_amount > 0 AND total_amount < 200""",
    "unknown_codes": """
        SELECT count_if(p.payment_type_id IS NULL AND f.payment_type_id IS NOT NULL) AS payment,
            count_if(r.rate_code_id IS NULL AND f.rate_code_id IS NOT NULL) AS rate
        FROM fact_trips f
        LEFT JOIN dim_payment_type p USING (payment_type_id)
        LEFT JOIN dim_rate_code r USING (rate_code_id)""",
}


def _name(name: str) -> str:
    if not re.fullmatch(r"\w+", name):
        raise ValueError(f"not usable as a database name: {name}")
    return name


def table_ddl(database: str, table: str) -> str:
    """The statement that declares a table of the star schema."""
    columns = []
    for field in TABLES[table].fields:
        kind = f"VARCHAR({TEXT_BOUNDS[field.name]})" if field.name in TEXT_BOUNDS else field.dataType.simpleString()
        columns.append(f"{field.name} {kind}{'' if field.nullable else ' NOT NULL'}")
    return f"CREATE TABLE IF NOT EXISTS {_name(database)}.{table} ({', '.join(columns)}) USING parquet"


def create_star_schema(spark: SparkSession, database: str, location: str) -> DataFrame:
    """Create the database in the folder ``location``, its tables, and the dimensions' rows
    where there are none yet; returns the status row. Can be run again."""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {_name(database)} LOCATION '{location}'")
    for table in TABLES:
        spark.sql(table_ddl(database, table))
    for table, rows in SEEDS.items():
        if spark.table(f"{database}.{table}").isEmpty():
            args = {f"v{i}_{j}": value for i, row in enumerate(rows) for j, value in enumerate(row)}
            values = ", ".join(
                "(" + ", ".join(f":v{i}_{j}" for j in range(len(row))) + ")" for i, row in enumerate(rows)
            )
            spark.sql(f"INSERT INTO {database}.{table} VALUES {values}", args=args)
    return spark.sql("SELECT 'Star schema ready; code 0 is present.' AS status")


def insert_fact(df: DataFrame, database: str, overwrite: bool = False) -> None:
    """Insert warehouse rows (:func:`tripmill.operators.star.to_warehouse`, with their key)
    by column name. A text longer than its column, or a NULL key, stops the insert."""
    verb = "INSERT OVERWRITE" if overwrite else "INSERT INTO"
    columns = ", ".join(FACT_TRIPS.names)
    df.sparkSession.sql(
        f"{verb} {_name(database)}.fact_trips ({columns}) SELECT {columns} FROM {{rows}}", rows=df
    )


def panel(spark: SparkSession, database: str, name: str) -> DataFrame:
    """A panel's SQL, over this database's tables."""
    text = PANELS[name]
    for table in TABLES:
        text = re.sub(rf"\b{table}\b", f"{_name(database)}.{table}", text)
    return spark.sql(text)


def drop_star_schema(spark: SparkSession, database: str) -> None:
    """Forget the tables and remove their rows."""
    spark.sql(f"DROP DATABASE IF EXISTS {_name(database)} CASCADE")
