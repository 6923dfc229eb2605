"""Connected components of a graph given as a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripmill.llm.common import written


def components(links: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node of a link: ``root`` is the smallest node reachable.

    Links are rewired in rounds until they are stars: every node's larger neighbours, then
    its smaller ones, are tied to its smallest neighbour. Rounds number about the logarithm
    of the longest path. Each is written to the shared scratch folder, which cuts the
    lineage. Sums per node combine before their shuffle, and the joins with a node of many
    links are plain sort-merge joins that adaptive execution splits. Links of a node to
    itself and NULL ends are ignored; without links the result is empty.
    """
    edges = links.select(
        F.greatest(a, b).alias("high"), F.least(a, b).alias("low")
    ).filter(F.col(a) != F.col(b))
    edges = edges.distinct()
    while True:
        either = edges.unionByName(
            edges.select(F.col("low").alias("high"), F.col("high").alias("low"))
        ).select(F.col("high").alias("node"), F.col("low").alias("other"))
        least = either.groupBy("node").agg(F.min("other").alias("least"))
        least = least.select("node", F.least("node", "least").alias("least"))
        large = (
            either.filter(F.col("other") > F.col("node"))
            .join(least, "node")
            .select(F.col("other").alias("high"), F.col("least").alias("low"))
            .distinct()
        )
        root = large.groupBy("high").agg(F.min("low").alias("least"))
        small = (
            large.join(root, "high")
            .filter(F.col("low") != F.col("least"))
            .select(F.col("low").alias("high"), F.col("least").alias("low"))
        )
        tied = root.select("high", F.col("least").alias("low"))
        edges = written(small.unionByName(tied).distinct(), "links")
        doubtful = (
            edges.select(F.col("high").alias("node"))
            .unionByName(edges.select(F.col("low").alias("node")).distinct())
            .groupBy("node")
            .count()
            .filter("count > 1")
        )
        roots_or_once = doubtful.join(edges.select(F.col("high").alias("node")), "node", "left_semi")
        if roots_or_once.isEmpty():
            return edges.select(F.col("high").alias("node"), F.col("low").alias("root")).unionByName(
                edges.select(F.col("low").alias("node"), F.col("low").alias("root")).distinct()
            )
