"""Numbers held as text, read so that a bad value never fails the job."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

from tributary.functions import sums

KEEP_NAN = "keep_nan"
NAN_IS_NULL = "nan_is_null"

# A sum has ten digits more than its values, and 38 are the most there are. Of a
# sum times a number of rows Spark then keeps up to six decimal places.
_EXACT_DIGITS, _EXACT_PLACES = 28, 6


def is_castable(column: Column | str, to: str = "float") -> Column:
    """True when the text reads as a number. ``nan`` does, an empty text does not."""
    return _column(column).try_cast(to).isNotNull()


def measure(column: Column | str, policy: str = KEEP_NAN, scale: int | None = None) -> Column:
    """A column as the number an average is taken over, null where it is none.

    ``keep_nan`` lets the text ``nan`` through as NaN, which makes the average
    of its group NaN; ``nan_is_null`` leaves such values out. With a ``scale``
    the number is a decimal of that many places, further ones rounded, so that
    sums do not depend on the order of the rows; a decimal has no NaN. A number
    that has more than 28 digits then, or is infinite, fails the job rather than be left out.
    """
    if policy not in (KEEP_NAN, NAN_IS_NULL):
        raise ValueError(f"unknown measure policy {policy!r}")
    if scale is not None:
        if policy == KEEP_NAN:
            raise ValueError("an exact measure cannot keep NaN; use nan_is_null")
        if not 0 <= scale <= _EXACT_PLACES:
            raise ValueError(f"an exact measure has up to {_EXACT_PLACES} decimal places, not {scale}")
        exact, number = _column(column).try_cast(f"decimal({_EXACT_DIGITS},{scale})"), _column(column).try_cast("double")
        too_large = F.raise_error(F.concat(F.lit("no exact average of "), _column(column).cast("string")))
        return F.when(exact.isNotNull() | number.isNull() | F.isnan(number), exact).otherwise(too_large)
    number = _column(column).try_cast("double")
    if policy == KEEP_NAN:
        return number
    return F.when(~F.isnan(number), number)


def addends(value: Column, scale: int | None) -> dict[str, Column]:
    """What is to be summed up of a measure, by a suffix: the decimal itself, or the parts of a double."""
    return sums.addends(value) if scale is None else {"": value}


def mean_of(summed: Mapping[str, Column], count: Column, scale: int | None) -> Column:
    """The average from the summed-up addends as a double; null for a group without any value."""
    return sums.mean(summed, count) if scale is None else F.try_divide(summed[""].cast("double"), count)


def _column(column: Column | str) -> Column:
    return F.col(column) if isinstance(column, str) else column
