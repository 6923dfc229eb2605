"""Which rules a row breaks, and what becomes of it.

Every row gets the names of all the rules it breaks, foreign keys among them, in one narrow
pass; accepted and rejected rows are written by one write, apart, and counted by it.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from tripmill.functions import predicates as P
from tripmill.sources.versioned import read_version, replace_version

BROKEN = "broken"
ACCEPTED = "accepted"


def trip_rules(bounds: Mapping[str, int] = {}) -> dict[str, Column]:
    """What has to hold for a trip whose unknown passenger counts are filled: the rules of
    :func:`tripmill.operators.clean.clean_trips`, and texts that fit their column."""
    rules = {
        "distance": P.positive("trip_distance"),
        "amount": P.non_negative("total_amount"),
        "passengers": P.positive("passenger_count"),
    }
    for name, bound in bounds.items():
        rules[f"length:{name}"] = F.col(name).isNull() | (F.length(name) <= bound)
    return rules


def label_rows(
    df: DataFrame,
    rules: Mapping[str, Column],
    foreign: Sequence[tuple[str, str, DataFrame, str]] = (),
) -> DataFrame:
    """Add ``broken``: the names of the rules that do not hold, in the order given.

    A rule that is neither true nor false (NULL) does not hold. A foreign key is
    (rule, fk, dim, pk): it holds if NULL or in the dimension. Dimensions are joined on their
    distinct keys, so that no row is lost or doubled; small ones are broadcast, by Spark.
    """
    out, holds = df, dict(rules)
    for i, (rule, fk, dim, pk) in enumerate(foreign):
        keys = dim.select(F.col(pk).alias(f"__pk_{i}")).distinct().withColumn(f"__known_{i}", F.lit(True))
        out = out.join(keys, F.col(fk) == F.col(f"__pk_{i}"), "left")
        holds[rule] = F.col(fk).isNull() | F.col(f"__known_{i}")
    names = [
        F.when(~F.coalesce(condition, F.lit(False)), F.lit(rule)) for rule, condition in holds.items()
    ]
    broken = F.array_compact(F.array(*names)) if names else F.array().cast("array<string>")
    return out.select(*[F.col(f"`{name}`") for name in df.columns], broken.alias(BROKEN))


def write_judged(labelled: DataFrame, path: str, rules: Sequence[str]) -> DataFrame:
    """Write labelled rows, accepted and rejected ones apart, as the next version of the
    table at ``path``. Eager; one write, which also counts.

    Returns the report: rule, rows (that break it); rows that break several count for each.
    Its last rows, ``accepted`` and ``rejected``, count every row once.
    """
    kept = F.size(BROKEN) == 0
    counted = Observation()
    counts = [F.count_if(F.array_contains(BROKEN, rule)).alias(f"rule_{i}") for i, rule in enumerate(rules)]
    watched = labelled.observe(counted, *counts, F.count_if(kept).alias(ACCEPTED), F.count_if(~kept).alias("rejected"))
    replace_version(watched.withColumn(ACCEPTED, kept.cast("string")), path, ACCEPTED, ["true", "false"])
    found = counted.get
    report = [(rule, found[f"rule_{i}"]) for i, rule in enumerate(rules)]
    report += [(name, found[name]) for name in (ACCEPTED, "rejected")]
    return labelled.sparkSession.createDataFrame(report, "rule string, rows long")


def read_accepted(spark, path: str) -> DataFrame:
    return read_version(spark, path, batches=["true"]).drop(BROKEN, ACCEPTED)


def read_rejected(spark, path: str) -> DataFrame:
    """The rejected rows, with the rules they broke; the accepted ones are not opened."""
    return read_version(spark, path, batches=["false"]).drop(ACCEPTED)


def broken_counts(labelled: DataFrame) -> DataFrame:
    """Rows per combination of broken rules: broken (comma-joined), rows."""
    return labelled.groupBy(F.array_join(BROKEN, ",").alias(BROKEN)).agg(F.count(F.lit(1)).alias("rows"))
