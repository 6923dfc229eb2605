"""Records on weighted shards by rendezvous hashing, with a place on their shard.

Every shard draws a number for the record's key; the shard with the best draw, in relation
to its weight, gets it. A new shard only takes records whose best draw is now its own, and
no record moves between old shards.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.llm.common import column, packed, unpacked, written

# Hexadecimal digits of the draw: as many as a double holds exactly.
DIGITS = 13


def draws(key: Column, weights: Sequence[float]) -> Column:
    """(cost, shard) of every shard; the least cost wins, of equal ones the lower shard.

    The draw u is between 0 and 1, and -ln(u) / weight is distributed so that each shard
    wins in proportion to its weight. A NULL key counts as empty text.
    """
    if not weights or any(weight <= 0 for weight in weights):
        raise ValueError("every shard needs a positive weight")
    name = F.coalesce(key.cast("string"), F.lit(""))
    shards = F.array(
        *[F.struct(F.lit(i).alias("shard"), F.lit(float(w)).alias("weight")) for i, w in enumerate(weights)]
    )

    def draw(s: Column) -> Column:
        digits = F.substring(F.md5(F.concat_ws(":", name, s.shard).cast("binary")), 1, DIGITS)
        u = (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**DIGITS)
        return F.struct((-F.log(u) / s.weight).alias("cost"), s.shard.alias("shard"))

    return F.transform(shards, draw)


def assign_shards(
    docs: DataFrame, weights: Sequence[float], added: float | None = None, key: str = "doc_id",
    order: Sequence[str] = (),
) -> DataFrame:
    """Add ``shard``, ``grown_shard`` and ``slot`` to every row. Eager: writes the rows to
    the shared scratch folder, so select narrow columns first.

    ``shard`` depends on the key and the weights alone. ``grown_shard`` is where the row
    goes once a shard of weight ``added`` joins (NULL without one): the same shard or the
    new one. ``slot`` numbers the rows of a shard from 0 without gaps, by key and then the
    columns of ``order``. The numbering takes one range partitioning: rows are numbered
    within each part of a shard, and the parts' sizes, a few rows, give the offsets, so no
    task holds a shard.

    NULL keys count as empty text and come first. Rows with one key share its shard; they
    are still split between tasks, by a last key that is theirs alone, and rows equal in
    key and ``order`` get their slots in no fixed order. Extra columns pass through; ones
    named like an added one are replaced. An empty table gives an empty one.
    """
    count = len(weights)
    every = [*weights, *([added] if added is not None else [])]
    sorting = [f"by_{i}" for i in range(len(order))]
    drawn = packed(
        docs,
        key=column(key),
        **{name: column(own) for name, own in zip(sorting, order)},
        draws=draws(column(key), every),
    )
    grown = F.array_min("draws").shard if added is not None else F.lit(None).cast("int")
    placed = drawn.withColumns(
        {"shard": F.array_min(F.slice("draws", 1, count)).shard, "grown": grown}
    ).drop("draws")
    parted = written(
        placed.withColumn("own", F.monotonically_increasing_id())
        .repartitionByRange("shard", "key", *sorting, "own")
        .withColumn("part", F.spark_partition_id())
        .drop("own"),
        "shards",
    )
    sizes = parted.groupBy("shard", "part").agg(F.count(F.lit(1)).alias("size"))
    earlier = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(
        "shard", "part", F.coalesce(F.sum("size").over(earlier), F.lit(0)).alias("offset")
    )
    within = Window.partitionBy("shard", "part").orderBy("key", *sorting)
    numbered = parted.withColumn("number", F.row_number().over(within)).join(offsets, ["shard", "part"])
    return unpacked(
        numbered,
        docs,
        shard=F.col("shard"),
        grown_shard=F.col("grown"),
        slot=(F.col("number") - 1 + F.col("offset")).cast("long"),
    )
