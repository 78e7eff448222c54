"""Sums of doubles that depend neither on the order of the rows nor on their partitioning.

A double is cut, without error, into its integer part and two limbs of ``BITS`` binary digits
after the point; each part is summed as a decimal, so every partial sum is exact and any
grouping of the additions gives the same three totals. Only the last step, from the totals to
one double, rounds.

Values down to 2**-27 (and 0) enter with all their digits, smaller ones cut off at 2**-80.
Values of 2**62 and more, infinities and NaN do not fit; they are added as doubles beside the
parts (infinities and NaN come out as usual, whatever the order).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BITS = 40
UNIT = float(2 ** BITS)
_LIMB = T.DecimalType(20, 0)


def _cut(x: Column) -> list[Column]:
    """Integer part and two signed limbs of x, and x itself where it is too large for them."""
    fits = F.abs(x) < F.lit(2.0 ** 62)  # false for NaN, which Spark orders above all numbers
    size, sign = F.abs(x), F.when(x < 0, F.lit(-1)).otherwise(F.lit(1)).cast(T.LongType())
    first = F.floor(size)
    rest = (size - first) * F.lit(UNIT)
    second = F.floor(rest)
    third = F.floor((rest - second) * F.lit(UNIT))
    return [*[F.when(fits, sign * p).cast(_LIMB) for p in (first, second, third)], F.when(~fits, x)]


def exact_sum_parts(col: str, name: str) -> list[Column]:
    """The aggregates of one exact sum, as columns of ``name``."""
    return [F.sum(p).alias(f"{name}_{i}") for i, p in enumerate(_cut(F.col(col).cast(T.DoubleType())))]


def exact_total(name: str) -> Column:
    """The sum as a double, from the columns of ``exact_sum_parts``; NULL where no value was summed."""
    unit = F.lit(2 ** BITS).cast(T.DecimalType(13, 0))
    wide = T.DecimalType(38, 0)
    whole, second, third = (F.coalesce(F.col(f"{name}_{i}"), F.lit(0)).cast(wide) for i in range(3))

    def carried(limb: Column) -> tuple[Column, Column]:
        low = F.pmod(limb, unit)  # 0 .. 2**BITS - 1
        return low, F.floor((limb - low) / unit).cast(wide)

    low3, carry = carried(third)
    low2, carry = carried(second + carry)
    # both limbs are below 2**40: exact doubles; the sum rounds to the nearest of the digits that count
    after_point = low2.cast(T.DoubleType()) / F.lit(UNIT) + low3.cast(T.DoubleType()) / F.lit(UNIT * UNIT)
    total = (whole + carry).cast(T.DoubleType()) + after_point
    none = F.col(f"{name}_0").isNull() & F.col(f"{name}_3").isNull()
    return F.when(~none, F.when(F.col(f"{name}_3").isNull(), total).otherwise(total + F.col(f"{name}_3")))


def exact_sums(df: DataFrame, keys: list[str], col: str, alias: str, *more: Column) -> DataFrame:
    """One row per group: the exact sum of ``col`` as ``alias``, and any further aggregates."""
    g = df.groupBy(*keys).agg(*exact_sum_parts(col, "__s"), *more)
    named = [c for c in g.columns if not c.startswith("__s_")]
    return g.select(*[F.col(f"`{c}`") for c in named], exact_total("__s").alias(alias))
