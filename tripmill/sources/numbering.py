"""Dense keys: 0, 1, 2, ... in a stated order, without one task seeing all rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.sources.parquet import read_written, write_lake
from tripmill.sources.scratch import scratch_dir

# A generated id has the number of its partition above this bit, its row's below.
_ROW_BITS = 33


def with_dense_key(
    df: DataFrame, order_by: Sequence[str | Column], name: str = "trip_id", start: int = 0
) -> DataFrame:
    """Add ``name`` in front: ``start`` and up, without gaps, in the order of ``order_by``.
    Eager: the ordered rows are written to the shared scratch folder once.

    Rows are dealt to ranges of the order and sorted there; a row's key is its place in its
    range and the sizes of the ranges before. Only these sizes, one per range, meet in one
    task. Rows equal in ``order_by`` are told apart by a hash of all their columns and come in
    its order; rows equal in everything are dealt to several ranges, in any order.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, "numbered")
    order = [F.col(part) if isinstance(part, str) else part for part in order_by]
    order = [*order, F.xxhash64(*[F.col(f"`{column}`") for column in df.columns]), F.col("__any")]
    placed = (
        df.withColumn("__any", F.monotonically_increasing_id())
        .repartitionByRange(*order)
        .sortWithinPartitions(*order)
        .drop("__any")
        .withColumn("__id", F.monotonically_increasing_id())
    )
    write_lake(placed, path)
    rows = read_written(placed, path)
    part = F.shiftright("__id", _ROW_BITS)
    # Of the ranges written, their sizes: a pass over one column.
    sizes = rows.groupBy(part.alias("__part")).agg(F.count(F.lit(1)).alias("__size"))
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("__part", F.coalesce(F.sum("__size").over(before), F.lit(0)).alias("__before"))
    place = F.col("__id").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    joined = rows.withColumn("__part", part).join(offsets, "__part")
    key = (F.lit(start) + F.col("__before") + place).cast("long")
    return joined.select(key.alias(name), *[F.col(f"`{column}`") for column in df.columns])
