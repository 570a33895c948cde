"""Sums of doubles that do not depend on the order in which the rows are added.

A double is cut at fixed exponents into a few parts, each a whole number of few bits. The parts add up exactly
in longs, in any order, and are put together when all rows are in, rounded once.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# A long takes the parts of 2**35 rows. Bits from 2**-154 on are added, numbers from 2**153 on are not cut.
BITS, PARTS, LOWEST = 28, 11, -154
LIMIT = 2.0 ** (LOWEST + BITS * PARTS - 1)
REST = "rest"
WINDOW = 4  # parts that hold more bits than a double, whatever the first of them holds


def addends(value: Column) -> dict[str, Column]:
    """What is to be summed up for a double: its parts, lowest first, and what cannot be cut (NaN, infinite, from 2**153 on).

    Bits below 2**-154 are rounded off each number. Numbers that are not cut are added as
    doubles, so that only the sums of groups with several such finite ones depend on the order.
    """
    within = F.abs(value) < F.lit(LIMIT)
    cut = F.when(within, value)
    upto = [F.rint(cut * F.lit(2.0 ** -(LOWEST + BITS * k))) for k in range(PARTS)]
    parts = [low - high * F.lit(2.0**BITS) for low, high in zip(upto, upto[1:], strict=False)] + [upto[-1]]
    return {str(k): part.cast("long") for k, part in enumerate(parts)} | {REST: F.when(~within, value)}


def _let(value: Column, function: Callable[[Column], Column]) -> Column:
    """The function of a value that is worked out once, however often the function asks for it."""
    return F.get(F.transform(F.array(value), function), F.lit(0))


def total(sums: Mapping[str, Column]) -> Column:
    """The double next to what the summed-up addends come to."""
    half, one = F.lit(2 ** (BITS - 1)), F.lit(2**BITS)

    def carried(done: Column, sum_: Column) -> Column:
        own = sum_ + done["carry"]
        carry = F.shiftright(own + half, BITS)
        return F.struct(carry.alias("carry"), F.concat(F.array(own - carry * one), done["places"]).alias("places"))

    def rounded(places: Column, start: Column) -> Column:
        # The places from the first that is not 0; of what follows only the sign can matter.
        window = F.slice(places, start, F.lit(WINDOW))
        whole = F.aggregate(
            window, F.lit(0).cast("decimal(38,0)"), lambda sum_, x: (sum_ * one + x.cast("decimal(20,0)")).cast("decimal(38,0)")
        )
        after = F.filter(F.slice(places, start + WINDOW, F.lit(PARTS + 1)), lambda x: x != 0)
        sign = F.coalesce(F.signum(F.get(after, F.lit(0))), F.lit(0.0)).cast("decimal(1,0)")
        last = F.least(start + (WINDOW - 1), F.lit(PARTS + 1))
        return (whole * 2 + sign).cast("double") * F.pow(F.lit(2.0), F.lit(LOWEST + BITS * (PARTS + 1) - 1) - BITS * last)

    def exact(places: Column) -> Column:
        first = F.array_position(F.transform(places, lambda x: x != 0), F.lit(True)).cast("int")
        return _let(F.greatest(first, F.lit(1)), lambda start: rounded(places, start))

    none = F.struct(F.lit(0).cast("long").alias("carry"), F.array().cast("array<bigint>").alias("places"))
    own = F.array(*(F.coalesce(sums[str(k)], F.lit(0).cast("long")) for k in range(PARTS)))
    places = F.aggregate(own, none, carried, lambda done: F.concat(F.array(done["carry"]), done["places"]))
    sum_ = _let(places, exact)
    return F.when(sums[REST].isNull(), sum_).otherwise(sum_ + sums[REST])


def mean(sums: Mapping[str, Column], count: Column) -> Column:
    """The sum over the number of values; null for a group without any."""
    return F.try_divide(total(sums), count)


def added(columns: Mapping[str, Column], weight: Column | None = None) -> dict[str, Column]:
    """The aggregates over addends, or over sums of them, each counted ``weight`` times."""
    return {name: F.sum(column if weight is None else column * weight) for name, column in columns.items()}

