"""The star schema as parquet tables."""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial, reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.errors import ConstraintError, MissingInputError
from tripmill.operators.quality import constraint_report, pk_report, require, text_report
from tripmill.operators.star import with_surrogate_key
from tripmill.schema import TEXT_BOUNDS
from tripmill.sources import dimensions as D
from tripmill.sources.parquet import at_once, read_file, replace_batches, write_lake
from tripmill.sources.versioned import is_versioned, read_version, replace_version

FACT = "fact_trips"
KEY = "trip_id"
FACT_KEYS = "fact_trips_keys"
DIMENSIONS = {
    "dim_payment_type": ("payment_type_id", D.dim_payment_type),
    "dim_rate_code": ("rate_code_id", D.dim_rate_code),
    "dim_vendor": ("vendor_id", D.dim_vendor),
}


def table_path(root: str, table: str) -> str:
    return f"{root.rstrip('/')}/{table}"


def _bounds(df: DataFrame) -> dict[str, int]:
    return {name: bound for name, bound in TEXT_BOUNDS.items() if name in df.columns}


def create_dimensions(spark: SparkSession, root: str) -> DataFrame:
    """Write the seeded dimensions, after checking their keys; returns the status row."""
    frames = {table: make(spark) for table, (_, make) in DIMENSIONS.items()}
    reports = []
    for table, (key, _) in DIMENSIONS.items():
        reports.append(pk_report(frames[table], key, rule=f"{table}.{key} is a key"))
        reports.append(text_report(frames[table], _bounds(frames[table])))
    require(reduce(DataFrame.unionByName, reports), ConstraintError)
    at_once(
        *[
            partial(write_lake, frame.coalesce(1), table_path(root, table))
            for table, frame in frames.items()
        ]
    )
    return D.status_row(spark, "Star schema ready; code 0 is present.")


def read_table(spark: SparkSession, root: str, table: str) -> DataFrame:
    """A table, as of its newest version if it has versions."""
    path = table_path(root, table)
    return read_version(spark, path) if is_versioned(spark, path) else read_file(spark, path)


def register_views(spark: SparkSession, root: str) -> None:
    """Temp views over the tables that exist, for SQL."""
    for table in [FACT, *DIMENSIONS]:
        try:
            read_table(spark, root, table).createOrReplaceTempView(table)
        except MissingInputError:
            continue


def foreign_keys(fact: DataFrame) -> list[tuple[str, DataFrame, str, DataFrame, str]]:
    """The two foreign keys of the fact; there is none to the vendors."""
    spark = fact.sparkSession
    return [
        ("fk_payment", fact, "payment_type_id", D.dim_payment_type(spark), "payment_type_id"),
        ("fk_rate", fact, "rate_code_id", D.dim_rate_code(spark), "rate_code_id"),
    ]


def require_constraints(fact: DataFrame, stored: DataFrame | None = None) -> None:
    """Raise before anything is written if a foreign key has orphans, a text is too long,
    or a key that the rows bring with them is NULL, repeated or ``stored`` already. A
    database would reject single partitions and keep the others.

    Foreign keys and texts take one pass over the fact, and a source key one more.
    """
    foreign = [(rule, fk, dim, pk) for rule, _, fk, dim, pk in foreign_keys(fact)]
    report = constraint_report(fact, foreign, _bounds(fact))
    if KEY in fact.columns:
        report = report.unionByName(pk_report(fact, KEY, rule=f"{FACT}.{KEY} is a key"))
        if stored is not None:
            known = stored.select(KEY).join(fact.select(KEY).distinct(), KEY, "left_semi")
            bad = known.agg(F.count(F.lit(1)).alias("bad_rows"))
            report = report.unionByName(
                bad.select(
                    F.lit(f"{FACT}.{KEY} is new").alias("rule"),
                    (F.col("bad_rows") == 0).alias("ok"),
                    "bad_rows",
                )
            )
    require(report, ConstraintError)


def next_trip_id(spark: SparkSession, root: str) -> int:
    """One more than the largest key of the stored fact, 0 if there is none.

    The first key of the last write is on record, and keys only grow: row groups
    of earlier writes are skipped by their statistics. Without a record all keys
    are read.
    """
    try:
        fact = read_table(spark, root, FACT)
    except MissingInputError:
        return 0
    try:
        last = read_table(spark, root, FACT_KEYS).agg(F.max("start")).first()[0]
    except MissingInputError:
        last = 0
    largest = fact.filter(F.col("trip_id") >= last).agg(F.max("trip_id")).first()[0]
    return last if largest is None else largest + 1


def _number(df: DataFrame, root: str, start: int) -> DataFrame:
    """Record ``start`` and number the rows from it."""
    record = df.sparkSession.range(start, start + 1, numPartitions=1).withColumnRenamed("id", "start")
    write_lake(record, table_path(root, FACT_KEYS))
    return with_surrogate_key(df, start=start)


def write_fact(
    df: DataFrame,
    root: str,
    mode: str = "append",
    batch_column: str | None = None,
    batches: Sequence[str] = (),
    versioned: bool = False,
) -> None:
    """Check the constraints, number the rows and write the fact. Eager.

    ``append`` adds rows each time it runs; ``overwrite`` replaces the table. With
    ``batch_column`` the table is partitioned by it and only ``batches`` are
    replaced, so a job can be run again for the months it failed on. Rows that bring
    their key (``trip_id``) keep it.

    A ``versioned`` fact is replaced, as a whole or the batches at hand, in one step after
    everything is written: a job that dies leaves the fact as it was.
    """
    if versioned and mode == "append" and not batch_column:
        raise ValueError("a versioned fact is replaced, as a whole or by batches")
    spark = df.sparkSession
    path = table_path(root, FACT)
    keyed = KEY in df.columns
    stored = None
    if keyed and (mode == "append" or batch_column):
        try:
            stored = read_table(spark, root, FACT)
        except MissingInputError:
            stored = None
        if stored is not None and batch_column:
            stored = stored.filter(~F.col(batch_column).isin(list(batches)))
    require_constraints(df, stored)
    if batch_column:
        numbered = df if keyed else _number(df, root, next_trip_id(spark, root))
        if versioned:
            replace_version(numbered, path, batch_column, batches)
        else:
            replace_batches(numbered, path, batch_column, batches)
        return
    if not keyed:
        df = _number(df, root, next_trip_id(spark, root) if mode == "append" else 0)
    if versioned:
        replace_version(df, path)
    else:
        write_lake(df, path, mode=mode)
