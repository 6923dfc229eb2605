"""One schema for files whose column names and types drift."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripmill.schema import TRIP_CASTS, TRIP_DEFAULTS


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def standardize(
    df: DataFrame,
    casts: Mapping[str, T.DataType] = TRIP_CASTS,
    defaults: Mapping[str, object] = TRIP_DEFAULTS,
) -> DataFrame:
    """Bring the columns named in ``casts`` to their type, in one projection.

    Names are matched without regard to case and get the spelling of ``casts``.
    A column of ``defaults`` that is absent is added; any other absent column
    stays absent, so that the union reports it. Columns not named pass through.

    A value that does not convert becomes NULL, whether or not ANSI mode is on.
    Columns that already have their type are left as they are, which keeps
    filters on them pushable to the scan.
    """
    spelling = {name.lower(): name for name in [*casts, *defaults]}
    present: set[str] = set()
    columns: list[str] = []
    for field in df.schema.fields:
        name = spelling.get(field.name.lower(), field.name)
        if name.lower() in present:
            raise ValueError(f"two columns differ only by case: {name}")
        present.add(name.lower())
        column = _quoted(field.name)
        target = casts.get(name)
        if target is not None and field.dataType != target:
            if isinstance(target, T.IntegralType) and isinstance(field.dataType, T.StringType):
                # "1.0" is a whole number too; the fraction of others is cut off.
                column = f"try_cast({column} AS DECIMAL(38, 18))"
            column = f"try_cast({column} AS {target.simpleString()})"
        columns.append(f"{column} AS {_quoted(name)}")
    absent = {
        name: F.lit(value).cast(casts[name]) if name in casts else F.lit(value)
        for name, value in defaults.items()
        if name.lower() not in present
    }
    out = df.selectExpr(*columns)
    return out.withColumns(absent) if absent else out


def union_by_name(frames: Sequence[DataFrame], allow_missing: bool = False) -> DataFrame:
    """All rows of all frames, columns matched by name, duplicates kept.

    Strict by default: a column that one frame lacks is an AnalysisException.
    ``allow_missing`` fills it with NULL instead.
    """
    if not frames:
        raise ValueError("nothing to union")
    return reduce(
        lambda left, right: left.unionByName(right, allowMissingColumns=allow_missing), frames
    )
