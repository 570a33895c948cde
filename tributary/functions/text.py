from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def normalized(column: Column | str) -> Column:
    """Lower case without the spaces around it; tabs and line breaks stay."""
    return F.trim(F.lower(column))
