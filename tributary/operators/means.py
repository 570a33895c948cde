"""Grouped averages of one table."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.functions.numbers import KEEP_NAN, addends, mean_of, measure
from tributary.functions.sums import added


def mean_by(
    df: DataFrame,
    group_by: Sequence[str],
    measures: Mapping[str, str],
    *,
    policy: str = KEEP_NAN,
    scale: int | None = None,
    counts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Average the measure columns, numeric or text, per group.

    ``measures`` maps an output name to its column. A null group key forms a
    group of its own, nulls do not count, a group without values averages to
    null. ``counts`` maps an output name to the column whose usable values are
    counted. Averages do not depend on the order of the rows: sums are exact, of doubles or,
    with a ``scale``, of decimals (see ``measure``).
    """
    number = {name: measure(column, policy, scale) for name, column in measures.items()}
    partials = {}
    for name, value in number.items():
        partials |= {f"__sum_{name}{part}": column for part, column in added(addends(value, scale)).items()}
        partials[f"__count_{name}"] = F.count(value)
    partials |= {name: F.count(measure(column, policy, scale)) for name, column in (counts or {}).items()}
    summed = df.groupBy(*group_by).agg(*(column.alias(name) for name, column in partials.items()))
    averages = [
        mean_of({part: F.col(f"__sum_{name}{part}") for part in addends(value, scale)}, F.col(f"__count_{name}"), scale).alias(name)
        for name, value in number.items()
    ]
    return summed.select(*group_by, *averages, *(counts or {}))
