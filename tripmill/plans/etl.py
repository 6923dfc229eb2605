"""Raw months -> clean lake -> warehouse."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripmill.operators.clean import clean_trips
from tripmill.operators.star import to_warehouse
from tripmill.sources.parquet import (
    base_name,
    read_months,
    read_written,
    replace_batches,
    write_lake,
)
from tripmill.sources.versioned import read_version, replace_version


def run_etl(
    spark: SparkSession,
    paths: Sequence[str],
    lake: str,
    warehouse: Callable[[DataFrame], None] | None = None,
    batch_column: str | None = None,
    versioned: bool = False,
) -> int:
    """Read, standardise, union and clean the months, write them to ``lake`` and
    hand the warehouse rows to ``warehouse``. Returns the number of clean rows.

    The lake is replaced as a whole, or with ``batch_column`` only the parts that
    came from files of the same names, so that single months can be run again. A
    ``versioned`` lake is replaced in one step when everything is written.

    The first half is one narrow job. The two sinks do not share a cache: the
    lake table itself feeds the warehouse, so a lost executor costs no rework and
    the clean rows need not fit in memory. The count reads its footers.
    """
    months = clean_trips(read_months(spark, paths, batch_column=batch_column))
    names = [base_name(path) for path in paths]
    if versioned:
        replace_version(months, lake, batch_column, names if batch_column else ())
        clean = read_version(spark, lake, batches=names if batch_column else None)
        keep = [batch_column] if batch_column else []
    elif batch_column is None:
        write_lake(months, lake)
        clean, keep = read_written(months, lake), []
    else:
        replace_batches(months, lake, batch_column, names)
        clean = read_written(months, lake).filter(F.col(batch_column).isin(names))
        keep = [batch_column]
    rows = clean.count()
    if warehouse is not None:
        warehouse(to_warehouse(clean, keep=keep))
    return rows
