"""Random samples of an exact size.

A sample is the ``n`` rows with the smallest rank of their key (then the smallest
key, then the smallest columns), so it depends on the data alone. With ``xxhash64`` the
rank is that of key and columns together, so that rows which share a key, but not their
columns, are spread as well; ``md5`` ranks by the key alone, which should tell rows apart.

A plain top-n hands up to ``n`` rows of *every* task to one reducer, which at a
hundred thousand tasks is most of the table. Here a first pass counts the rows
per magnitude class of the rank (41 classes), and a second one lets through only
the classes needed to reach ``n``: about ``2 * n`` rows, whatever the size of the
input. Copies of a row share its rank, so there may be any number of them; they
are counted, not carried, up to the last step. The result is exact; ``n`` rows
have to fit one task.

Samples can be merged: the lowest ``n`` ranks of a union are among the lowest ``n`` of its
parts. :func:`batch_samples` keeps those of every batch, with their copies, and
:func:`merge_samples` makes of any batches' kept rows the exact sample of all their rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripmill.functions import keys as K


def sample_candidates(
    df: DataFrame,
    wanted: Sequence[tuple[int, Column]],
    key: Sequence[str],
    columns: Sequence[str],
    seed: int = 42,
    method: str = "md5",
    copies: str | None = None,
) -> DataFrame:
    """Rows that hold, for each ``(n, condition)``, the sample of ``n`` rows that
    meet the condition, and few others. All samples share the two passes. A row stands
    for as many as its column ``copies`` says, if there is one."""
    rank = K.rank(_ranked_by(key, columns, method), seed, method)
    rows = df.select(*dict.fromkeys([*key, *columns, *([copies] if copies else [])]))
    ranked = rows.withColumn("__rank", rank)
    weight = F.col(copies) if copies else F.lit(1)
    classes = ranked.groupBy(K.magnitude("__rank", method).alias("class")).agg(
        *[F.sum(F.when(condition, weight).otherwise(0)).alias(f"rows_{i}") for i, (_, condition) in enumerate(wanted)]
    )
    # The window runs over those 41 rows. A sum that never reaches n keeps all.
    upward = Window.orderBy("class")
    running = classes.select(
        "class", *[F.sum(f"rows_{i}").over(upward).alias(f"rows_{i}") for i in range(len(wanted))]
    )
    bounds = running.agg(_bounds(wanted, method))
    bounded = ranked.withColumn("__bounds", bounds.scalar())
    return bounded.filter(_needed(wanted)).drop("__rank", "__bounds")


def _bounds(wanted: Sequence[tuple[int, Column]], method: str) -> Column:
    """The rank that no sample reaches, for each, from the running counts per class."""
    return F.struct(
        *[
            K.ceiling(
                F.coalesce(F.min(F.when(F.col(f"rows_{i}") >= n, F.col("class"))), F.lit(K.CLASSES)),
                method,
            ).alias(f"bound_{i}")
            for i, (n, _) in enumerate(wanted)
        ]
    )


def _needed(wanted: Sequence[tuple[int, Column]]) -> Column:
    needed = F.lit(False)
    for i, (_, condition) in enumerate(wanted):
        needed = needed | (condition & (F.col("__rank") < F.col(f"__bounds.bound_{i}")))
    return needed


def _ranked_by(key: Sequence[str], columns: Sequence[str], method: str) -> list[str]:
    return list(dict.fromkeys([*key, *columns] if method == "xxhash64" else key))


def take_sample(
    candidates: DataFrame,
    n: int,
    key: Sequence[str],
    columns: Sequence[str],
    seed: int = 42,
    method: str = "md5",
    ranked_by: Sequence[str] | None = None,
    copies: str | None = None,
) -> DataFrame:
    """``columns`` of the first ``n`` candidates in rank order. ``ranked_by`` names the
    columns of :func:`sample_candidates` if those were more, and ``copies`` the column that
    says for how many rows each stands."""
    names = list(dict.fromkeys([*key, *columns]))
    order = ["__rank", *names]
    ranked = _ranked_by(key, ranked_by or columns, method)
    distinct = candidates.groupBy(*dict.fromkeys([*names, *ranked])).agg(
        (F.sum(copies) if copies else F.count(F.lit(1))).alias("__copies")
    )
    first = distinct.select("*", K.rank(ranked, seed, method).alias("__rank")).orderBy(*order).limit(n)
    # The window runs over those n rows.
    before = F.sum("__copies").over(
        Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    )
    room = F.lit(n) - F.coalesce(before, F.lit(0))
    return (
        first.withColumn("__taken", F.least(F.col("__copies"), room).cast("int"))
        .filter(F.col("__taken") > 0)
        .select(*columns, F.explode(F.array_repeat(F.lit(1), F.col("__taken"))))
        .select(*columns)
    )


def batch_samples(
    df: DataFrame,
    batch: str,
    wanted: Sequence[tuple[int, Column]],
    key: Sequence[str],
    columns: Sequence[str],
    seed: int = 42,
    method: str = "md5",
) -> DataFrame:
    """Of every batch the rows of its own samples, for each ``(n, condition)``: ``batch``,
    key, columns and ``__copies``. Two passes over all batches together; what is kept of a
    batch has at most ``n`` rows per sample, and passes through one task."""
    names = list(dict.fromkeys([*key, *columns]))
    ranked = df.select(batch, *names).withColumn(
        "__rank", K.rank(_ranked_by(key, columns, method), seed, method)
    )
    classes = ranked.groupBy(batch, K.magnitude("__rank", method).alias("class")).agg(
        *[F.count_if(condition).alias(f"rows_{i}") for i, (_, condition) in enumerate(wanted)]
    )
    upward = Window.partitionBy(batch).orderBy("class")
    running = classes.select(
        batch, "class", *[F.sum(f"rows_{i}").over(upward).alias(f"rows_{i}") for i in range(len(wanted))]
    )
    bounds = running.groupBy(batch).agg(_bounds(wanted, method).alias("__bounds"))
    # One row per batch, of which a run has as many as it was told to.
    bounded = ranked.join(F.broadcast(bounds), batch).filter(_needed(wanted))
    distinct = bounded.groupBy(batch, *names, "__rank").agg(F.count(F.lit(1)).alias("__copies"))
    before = Window.partitionBy(batch).orderBy("__rank", *names).rowsBetween(Window.unboundedPreceding, -1)
    kept = F.lit(False)
    for n, condition in wanted:
        earlier = F.sum(F.when(condition, F.col("__copies")).otherwise(0)).over(before)
        kept = kept | (condition & (F.coalesce(earlier, F.lit(0)) < n))
    return distinct.withColumn("__kept", kept).filter("__kept").drop("__kept", "__rank")


def merge_samples(
    kept: DataFrame,
    n: int,
    condition: Column,
    key: Sequence[str],
    columns: Sequence[str],
    taken: Sequence[str] | None = None,
    seed: int = 42,
    method: str = "md5",
) -> DataFrame:
    """The exact sample of ``n`` rows over all batches, from what :func:`batch_samples` kept
    of each (with the same key, columns and seed): ``taken``, or all of ``columns``."""
    few = sample_candidates(kept.filter(condition), [(n, F.lit(True))], key, columns, seed, method, "__copies")
    return take_sample(few, n, key, taken or columns, seed, method, ranked_by=columns, copies="__copies")


def sample_n(
    df: DataFrame,
    n: int,
    key: Sequence[str],
    columns: Sequence[str],
    seed: int = 42,
    method: str = "md5",
) -> DataFrame:
    """``columns`` of ``n`` random rows, or of all rows if there are fewer."""
    candidates = sample_candidates(df, [(n, F.lit(True))], key, columns, seed, method)
    return take_sample(candidates, n, key, columns, seed, method)


def sample_fraction(
    df: DataFrame, fraction: float, key: Sequence[str], seed: int = 42, method: str = "md5"
) -> DataFrame:
    """About ``fraction`` of the rows in one pass, without a shuffle."""
    return df.filter(K.in_fraction(key, fraction, seed, method))
