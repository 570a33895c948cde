"""Row cleaning: text, duplicates, missing values, numbers held as text."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from tributary.functions.numbers import is_castable
from tributary.functions.text import normalized


def normalize_text(df: DataFrame) -> DataFrame:
    """Normalise every text column and leave the others alone, in one projection."""
    return df.select(
        *(
            normalized(_quoted(f.name)).alias(f.name) if isinstance(f.dataType, StringType) else _quoted(f.name)
            for f in df.schema.fields
        )
    )


def distinct_rows(df: DataFrame) -> DataFrame:
    """One of each set of equal rows; null equals null and NaN equals NaN.

    Every task first drops the copies it holds itself, so however often one row
    occurs, the shuffle carries at most one of it per task.
    """
    return df.distinct()


def drop_columns(df: DataFrame, *names: str) -> DataFrame:
    """The table less the named columns; names it does not have are ignored."""
    return df.drop(*names)


def require_not_null(df: DataFrame, *columns: str) -> DataFrame:
    return df.filter(_all(F.col(c).isNotNull() for c in columns))


def require_castable(df: DataFrame, *columns: str, to: str = "float") -> DataFrame:
    """Keep the rows whose named columns all read as numbers; the text itself stays."""
    return df.filter(_all(is_castable(c, to) for c in columns))


def fill_missing(df: DataFrame, values: Mapping[str, object] | None) -> DataFrame:
    """Replace nulls column by column; columns the table does not have are ignored.

    Filled before a grouping, a null key joins the group of the fill value.
    Filled after it, the two stay separate rows that then carry the same key.
    """
    present = {name: value for name, value in (values or {}).items() if name in df.columns}
    return df.na.fill(present) if present else df


def _all(conditions) -> Column:
    return reduce(lambda left, right: left & right, conditions)


def _quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")
