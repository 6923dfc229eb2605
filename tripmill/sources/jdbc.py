"""A warehouse behind JDBC: Spark's own source and sink with bounded connections."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession

from tripmill.sources.warehouse import FACT, require_constraints


@dataclass(frozen=True)
class JdbcTarget:
    """Where the warehouse is. Take ``password`` from the environment or a secret
    store; it is kept out of ``repr``."""

    url: str
    user: str | None = None
    password: str | None = field(default=None, repr=False)
    driver: str | None = None

    def options(self) -> dict[str, str]:
        given = {
            "url": self.url,
            "user": self.user,
            "password": self.password,
            "driver": self.driver,
        }
        return {key: value for key, value in given.items() if value is not None}


def append_fact(
    df: DataFrame,
    target: JdbcTarget,
    table: str = FACT,
    connections: int = 16,
    batch_size: int = 10_000,
    mode: str = "append",
) -> None:
    """Write the fact over JDBC; the database numbers its rows. Eager.

    The constraints are checked first. ``append`` is not idempotent; ``overwrite``
    empties the table and keeps its definition.
    """
    require_constraints(df)
    (
        df.write.format("jdbc")
        .options(**target.options())
        .option("dbtable", table)
        .option("numPartitions", connections)
        .option("batchsize", batch_size)
        .option("truncate", "true")
        .mode(mode)
        .save()
    )


def read_table(
    spark: SparkSession,
    target: JdbcTarget,
    table: str = FACT,
    partition_column: str | None = None,
    lower: int | None = None,
    upper: int | None = None,
    partitions: int = 16,
    fetch_size: int = 10_000,
) -> DataFrame:
    """A table; filters and columns are pushed to the database.

    Without ``partition_column`` the whole table comes through one task, which is
    right for a dimension; for the fact it is refused. Without bounds the database
    is asked for the column's least and largest value.
    """
    if partition_column is None and table == FACT:
        raise ValueError(f"name a partition_column to read {FACT}: one task would read it all")
    reader = (
        spark.read.format("jdbc")
        .options(**target.options())
        .option("dbtable", table)
        .option("fetchsize", fetch_size)
    )
    if partition_column:
        if lower is None or upper is None:
            found = read_query(spark, target, bounds_query(table, partition_column)).first()
            lower, upper = _bounds(lower, upper, found[0], found[1])
        reader = reader.options(**partition_options(partition_column, lower, upper, partitions))
    return reader.load()


def bounds_query(table: str, column: str) -> str:
    return f"SELECT min({column}) AS lower_bound, max({column}) AS upper_bound FROM {table}"


def _bounds(lower: int | None, upper: int | None, least: int | None, most: int | None) -> tuple[int, int]:
    """What the caller gave, or else what the table has; an empty table has 0 and 1."""
    lower = lower if lower is not None else (least if least is not None else 0)
    upper = upper if upper is not None else (most if most is not None else lower + 1)
    return lower, max(upper, lower + 1)


def partition_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(partitions),
    }


def read_query(spark: SparkSession, target: JdbcTarget, query: str) -> DataFrame:
    """The result of a query the database runs, e.g. an aggregate."""
    return spark.read.format("jdbc").options(**target.options()).option("query", query).load()
