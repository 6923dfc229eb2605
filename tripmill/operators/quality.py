"""Validation rules and key constraints, as report tables.

A report has one row per rule; :func:`require` turns a failing one into an error.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.errors import QualityError
from tripmill.functions import predicates as P


def validation_metrics(df: DataFrame, required: Sequence[str]) -> list[Column]:
    """The aggregates behind :func:`validate`, for use in any global aggregation."""
    fields = {field.name.lower(): field for field in df.schema.fields}
    metrics = [F.count(F.lit(1)).alias("n_rows")]
    for name in required:
        field = fields.get(name.lower())
        if field is not None:
            floating = isinstance(field.dataType, (T.DoubleType, T.FloatType))
            metrics.append(F.count_if(P.is_missing(name, floating)).alias(f"missing_{name}"))
    return metrics


def validation_rules(df: DataFrame, required: Sequence[str]) -> list[tuple[str, Column, Column]]:
    """(rule, ok, bad_rows) over a row of :func:`validation_metrics`, in the order
    in which a failing rule stops the job."""
    fields = {field.name.lower(): field for field in df.schema.fields}
    zero = F.lit(0).cast("long")
    every = F.col("n_rows")
    rules = [("not_empty", every > 0, zero)]
    for name in required:
        found = F.lit(name.lower() in fields)
        rules.append((f"present:{name}", found, F.when(found, zero).otherwise(every)))
    known = [name for name in required if name.lower() in fields]
    for name in known:
        bad = F.col(f"missing_{name}")
        rules.append((f"not_null:{name}", bad == 0, bad))
    for name in known:
        numeric = F.lit(isinstance(fields[name.lower()].dataType, T.NumericType))
        rules.append((f"numeric:{name}", numeric, F.when(numeric, zero).otherwise(every)))
    return rules


def rules_as_rows(metrics: DataFrame, rules: Sequence[tuple[str, Column, Column]]) -> DataFrame:
    """A one-row metrics frame as report rows: rule, ok, bad_rows."""
    rows = [
        F.struct(F.lit(rule).alias("rule"), ok.alias("ok"), bad.alias("bad_rows"))
        for rule, ok, bad in rules
    ]
    return metrics.select(F.inline(F.array(*rows)))


def validate(df: DataFrame, required: Sequence[str]) -> DataFrame:
    """Check that the frame has rows, has the required columns, and that those
    hold numbers without NULL or NaN, in one pass: rule, ok, bad_rows."""
    metrics = df.agg(*validation_metrics(df, required))
    return rules_as_rows(metrics, validation_rules(df, required))


def text_report(df: DataFrame, bounds: Mapping[str, int]) -> DataFrame:
    """Texts longer than their column allows, in one pass: rule, ok, bad_rows."""
    metrics = df.agg(
        *[F.count_if(F.length(name) > bound).alias(name) for name, bound in bounds.items()]
    )
    rules = [
        (f"max_length:{name}<={bound}", F.col(name) == 0, F.col(name))
        for name, bound in bounds.items()
    ]
    return rules_as_rows(metrics, rules)


def require(report: DataFrame, error: type[Exception] = QualityError) -> None:
    """Raise on the first rule that does not hold. Runs the report, a few rows."""
    for row in report.collect():
        if not row["ok"]:
            raise error(f"{row['rule']} does not hold ({row['bad_rows']} rows)")


def fk_orphans(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """The fact rows whose key is not NULL and not in the dimension."""
    keys = dim.select(F.col(pk).alias(fk))
    return fact.filter(F.col(fk).isNotNull()).join(keys, fk, "left_anti")


def fk_accepted(fact: DataFrame, fk: str, dim: DataFrame, pk: str) -> DataFrame:
    """The fact rows whose key is NULL or in the dimension.

    NULL is one more key of the dimension, and the join is null-safe: one
    semi-join in one pass, which Spark can broadcast or, with skew, split.
    """
    keys = dim.select(F.col(pk).alias("__key"))
    none = keys.sparkSession.range(1).select(F.lit(None).cast(keys.schema[0].dataType).alias("__key"))
    return fact.join(keys.unionByName(none), F.col(fk).eqNullSafe(F.col("__key")), "left_semi")


def fk_report(checks: Sequence[tuple[str, DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Orphans per foreign key: rule, ok, bad_rows.

    A check is (rule, fact, fk, dim, pk). The keys are counted before the join,
    so what is shuffled is distinct keys and not fact rows, however skewed.
    """
    report = None
    for rule, fact, fk, dim, pk in checks:
        keys = fact.filter(F.col(fk).isNotNull()).groupBy(fk).agg(F.count(F.lit(1)).alias("rows"))
        bad = fk_orphans(keys, fk, dim, pk).agg(
            F.coalesce(F.sum("rows"), F.lit(0).cast("long")).alias("bad_rows")
        )
        row = bad.select(
            F.lit(rule).alias("rule"), (F.col("bad_rows") == 0).alias("ok"), "bad_rows"
        )
        report = row if report is None else report.unionByName(row)
    if report is None:
        raise ValueError("no foreign key to check")
    return report


def constraint_report(
    fact: DataFrame,
    foreign: Sequence[tuple[str, str, DataFrame, str]],
    bounds: Mapping[str, int] = {},
) -> DataFrame:
    """Foreign keys to small dimensions, and text bounds, in one pass over the fact:
    rule, ok, bad_rows.

    A check is (rule, fk, dim, pk). The pass counts rows per distinct key, a grouping set
    for each foreign key; only those few counts are joined with the dimensions' keys. For
    two tables that both are large, :func:`fk_report` joins key by key.
    """
    if not foreign:
        return text_report(fact, bounds)
    known, keys = None, []
    for i, (rule, fk, dim, pk) in enumerate(foreign):
        ours, theirs = fact.schema[fk].dataType, dim.schema[pk].dataType
        common = _key_type(ours, theirs)
        keys.append(F.col(fk).cast(common).cast("string").alias(f"key_{i}"))
        part = dim.select(F.lit(rule).alias("rule"), F.col(pk).cast(common).cast("string").alias("key"))
        known = part if known is None else known.unionByName(part)
    too_long = [(F.length(name) > bound).alias(f"long_{j}") for j, (name, bound) in enumerate(bounds.items())]
    narrow = fact.select(*keys, *too_long)
    names = [f"key_{i}" for i in range(len(keys))]
    label = F.lit(None).cast("string")
    for i, (rule, *_) in enumerate(foreign):
        label = F.when(F.grouping(f"key_{i}") == 0, F.lit(rule)).otherwise(label)
    counted = narrow.groupingSets([[F.col(name)] for name in names], *map(F.col, names)).agg(
        label.alias("rule"),
        F.count(F.lit(1)).alias("rows"),
        *[F.count_if(f"long_{j}").alias(f"long_{j}") for j in range(len(bounds))],
    )
    counted = counted.withColumn("key", F.coalesce(*names))
    known = known.distinct().withColumn("known", F.lit(True))
    joined = counted.join(known, ["rule", "key"], "left")
    orphan = F.col("key").isNotNull() & F.col("known").isNull()
    first = F.col("rule") == foreign[0][0]
    zero = F.lit(0).cast("long")
    metrics = joined.agg(
        *[
            F.coalesce(F.sum(F.when(orphan & (F.col("rule") == rule), F.col("rows"))), zero).alias(f"fk_{i}")
            for i, (rule, *_) in enumerate(foreign)
        ],
        *[
            F.coalesce(F.sum(F.when(first, F.col(f"long_{j}"))), zero).alias(f"text_{j}")
            for j in range(len(bounds))
        ],
    )
    rules = [(rule, F.col(f"fk_{i}") == 0, F.col(f"fk_{i}")) for i, (rule, *_) in enumerate(foreign)]
    rules += [
        (f"max_length:{name}<={bound}", F.col(f"text_{j}") == 0, F.col(f"text_{j}"))
        for j, (name, bound) in enumerate(bounds.items())
    ]
    return rules_as_rows(metrics, rules)


def _key_type(one: T.DataType, other: T.DataType) -> T.DataType:
    """A type in which two keys are equal as texts if they are equal."""
    if one == other:
        return one
    if isinstance(one, T.IntegralType) and isinstance(other, T.IntegralType):
        return T.LongType()
    if isinstance(one, T.NumericType) and isinstance(other, T.NumericType):
        return T.DoubleType()
    return T.StringType()


def pk_duplicates(df: DataFrame, *key: str) -> DataFrame:
    """The keys that occur more than once, with their number of rows."""
    return df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies")).filter(F.col("copies") > 1)


def pk_report(df: DataFrame, *key: str, rule: str = "primary_key") -> DataFrame:
    """Rows that share their key, or have NULL in it: rule, ok, bad_rows."""
    no_null = F.lit(True)
    for name in key:
        no_null = no_null & F.col(name).isNotNull()
    copies = df.groupBy(*key).agg(F.count(F.lit(1)).alias("copies"))
    bad = copies.agg(
        F.coalesce(
            F.sum(F.when((F.col("copies") > 1) | ~no_null, F.col("copies"))), F.lit(0).cast("long")
        ).alias("bad_rows")
    )
    return bad.select(F.lit(rule).alias("rule"), (F.col("bad_rows") == 0).alias("ok"), "bad_rows")
