"""Reproducible pseudo-random ranks.

``rand(seed)`` depends on how the rows are partitioned; a hash of the row's key
does not, so samples and splits stay the same after a repartition or a retry on
another executor. Two hashes:

``md5``       of ``seed:key1:key2...``, as hex text: the same in any engine
``xxhash64``  of the typed values, as a number: several times cheaper
"""

from __future__ import annotations

from collections.abc import Sequence
from fractions import Fraction

from pyspark.sql import Column
from pyspark.sql import functions as F

# Classes of magnitude below the largest one. The smallest class of a table with
# 2**40 rows holds about one row.
CLASSES = 40

# Bits kept of the 64: the number is never negative and can be exceeded.
_LONG_BITS = 62
_TEXT_BITS = 128


def rank(key: Sequence[str], seed: int = 42, method: str = "md5") -> Column:
    """The pseudo-random place of a row among all rows."""
    if method == "md5":
        parts = [F.lit(f"{seed}")]
        for name in key:
            parts += [F.lit(":"), F.coalesce(F.col(name).cast("string"), F.lit(""))]
        return F.md5(F.concat(*parts))
    if method == "xxhash64":
        return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *key), 64 - _LONG_BITS)
    raise ValueError(f"no such hash: {method}")


def _floors(method: str) -> list[str]:
    """SQL literals: the smallest rank of each class 1..CLASSES, and what exceeds
    every rank."""
    if method == "xxhash64":
        return [f"{2**bit}L" for bit in range(_LONG_BITS - CLASSES, _LONG_BITS + 1)]
    texts = []
    for number in range(1, CLASSES + 1):
        zeros, place = divmod(CLASSES - number, 4)
        texts.append("0" * zeros + format(8 >> place, "x"))
    return [f"'{text}'" for text in [*texts, "g"]]


def magnitude(name: str, method: str = "md5") -> Column:
    """Class 0..CLASSES of the rank in column ``name``, by its leading zero bits.

    It never decreases along the ranks, and every class holds about as many rows
    as all the classes below it together. Half of the rows are done after one
    comparison.
    """
    floors = _floors(method)
    cases = [
        f"WHEN `{name}` >= {floors[number - 1]} THEN {number}" for number in range(CLASSES, 0, -1)
    ]
    return F.expr(f"CASE {' '.join(cases)} ELSE 0 END")


def ceiling(number: Column, method: str = "md5") -> Column:
    """The smallest rank above a class."""
    return F.element_at(F.expr(f"array({', '.join(_floors(method))})"), number + 1)


def fraction_bound(fraction: float, method: str = "md5") -> int | str:
    """The smallest rank above the lowest ``fraction`` of all ranks, of their full width.
    A fraction no rank lies below is an error, not an empty sample."""
    if not 0.0 < fraction < 1.0:
        raise ValueError(f"fraction must lie between 0 and 1, got {fraction}")
    bits = _LONG_BITS if method == "xxhash64" else _TEXT_BITS
    bound = int(Fraction(fraction) * 2**bits)
    if bound == 0:
        raise ValueError(f"no {method} rank lies below the fraction {fraction}")
    return bound if method == "xxhash64" else format(bound, f"0{bits // 4}x")


def in_fraction(
    key: Sequence[str], fraction: float, seed: int = 42, method: str = "md5"
) -> Column:
    """True for about ``fraction`` of the keys: those whose rank lies below that
    fraction of all ranks."""
    bound = F.lit(fraction_bound(fraction, method))
    return rank(key, seed, method) < (bound.cast("long") if method == "xxhash64" else bound)
