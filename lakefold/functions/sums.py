"""Sums of doubles that do not depend on the order of their terms.

A double is cut at fixed binary places into integers (``UNITS`` is their weight), with
no rounding, and the integers are added: integer sums are exact, so every grouping,
partitioning and order gives the same parts.  The sum is put together once, at the end.
Terms that the places do not hold whole (2^54 or more, bits below 2^-81, NaN, infinity)
are added as doubles beside them, so NaN and infinity show in the sum as they should.

Parts of a sum are ordinary columns: they can be added again (``add_parts``), so
pre-aggregation before a join stays exact, and multiplied by a whole number
(``total(name, factor)``), which equals adding every term that many times.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 27                                   # a part of 27 bits leaves room for 2^36 terms in a BIGINT
_UNIT = 1 << BITS
_MASK = _UNIT - 1
UNITS = [float(2.0 ** e) for e in (27, 0, -27, -54, -81)]
_LIMIT = 2.0 ** 54


def _names(name: str) -> list[str]:
    return [f"{name}__{i}" for i in range(len(UNITS))]


def sum_parts(x, name: str) -> list[Column]:
    """Aggregates: the parts of the sum of ``x``, the sum of terms outside the places, and the number of terms."""
    x = (F.col(x) if isinstance(x, str) else x).cast("double")
    held = F.when(F.abs(x) < _LIMIT, x).otherwise(F.lit(0.0))  # NaN is greater than all
    whole = held.cast("bigint")
    fraction = (held - whole) * _LIMIT
    high = fraction.cast("bigint")
    rest = (fraction - high) * float(_UNIT)
    low = rest.cast("bigint")
    good = (F.abs(x) < _LIMIT) & (rest == low)
    terms = [F.shiftright(whole, BITS), whole.bitwiseAND(_MASK), F.shiftright(high, BITS), high.bitwiseAND(_MASK), low]
    return [*[F.sum(F.when(good, t).otherwise(F.lit(0).cast("bigint"))).alias(c) for t, c in zip(terms, _names(name))],
            F.sum(F.when(good, F.lit(0.0)).otherwise(x)).alias(f"{name}__rest"), F.count(x).alias(f"{name}__n")]


def add_parts(name: str) -> list[Column]:
    """Aggregates that add the parts of several sums."""
    return [F.sum(c).alias(c) for c in (*_names(name), f"{name}__rest", f"{name}__n")]


def _digits(parts: list[Column]) -> tuple[Column, list[Column]]:
    """(carry, digits from the lowest on): each digit between 0 and 2^27 - 1, the sign in the carry."""
    carry, digits = F.lit(0).cast("bigint"), []
    for part in reversed(parts):
        digits.append((part + carry).bitwiseAND(_MASK))
        carry = F.shiftright(part + carry, BITS)
    return carry, digits


def total(name: str, factor: Column | None = None) -> Column:
    """The sum as a DOUBLE, from the columns of its parts; NULL if there was no term.

    Plain arithmetic on the parts, which Spark compiles: functions of arrays would be
    interpreted for every row.
    """
    parts = [F.coalesce(F.col(c), F.lit(0).cast("bigint")) * (factor if factor is not None else F.lit(1)) for c in _names(name)]
    negative = _digits(parts)[0] < 0

    def value(sign: int) -> Column:
        # made positive first: else a small negative sum would be the difference of two large numbers
        carry, d = _digits([p * F.lit(sign).cast("bigint") for p in parts])
        at = lambda i: d[i].cast("double")
        whole = carry.cast("double") * _LIMIT + (d[4] * _UNIT + d[3]).cast("double")
        part = (d[2] * _UNIT + d[1]).cast("double") / _LIMIT + at(0) * UNITS[4]
        return F.lit(float(sign)) * (whole + part)

    exact = F.when(negative, value(-1)).otherwise(value(1))
    rest = F.col(f"{name}__rest") * (factor.cast("double") if factor is not None else F.lit(1.0))
    return F.when(F.col(f"{name}__n") > 0, exact + rest)
