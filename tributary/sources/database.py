"""Relational tables over JDBC. Connection settings come from the caller only."""

from __future__ import annotations

import math
from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from decimal import Decimal

from pyspark.sql import DataFrame, SparkSession

from tributary.contracts import Contract

FETCH_ROWS = 10_000


@dataclass(frozen=True)
class KeyRange:
    """How to cut a table into parallel reads by a numeric, date or time column.

    Take a column whose values are spread evenly, such as a unique id: all rows
    of one value are read by one task.
    """

    column: str
    lower: object
    upper: object
    partitions: int


def read_options(
    connection: Mapping[str, str],
    table: str,
    *,
    contract: Contract | None = None,
    keys: KeyRange | None = None,
    fetch_rows: int = FETCH_ROWS,
) -> dict[str, str]:
    """The reader options for one table; ``connection`` holds url, user, driver and so on."""
    options = {**connection, "dbtable": table, "fetchsize": str(fetch_rows)}
    if contract:
        options["customSchema"] = contract.ddl
    if keys:
        options |= {
            "partitionColumn": keys.column,
            "lowerBound": str(keys.lower),
            "upperBound": str(keys.upper),
            "numPartitions": str(keys.partitions),
        }
    return options


def key_bounds(
    spark: SparkSession, connection: Mapping[str, str], table: str, column: str, partitions: int
) -> KeyRange | None:
    """The range of a column, worked out by the database; one row comes back. None if no row has a value."""
    query = f"SELECT MIN({column}) AS lo, MAX({column}) AS hi FROM {table}"
    row = spark.read.format("jdbc").options(**connection, query=query).load().first()
    return key_range(column, row[0], row[1], partitions)


def key_range(column: str, lower: object, upper: object, partitions: int) -> KeyRange | None:
    """The range between two values; None where there are none, as of a table without rows.

    Numbers are taken to the whole ones around them, the only ones Spark has as bounds.
    """
    if lower is None or upper is None:
        return None
    if isinstance(lower, float | Decimal) and isinstance(upper, float | Decimal):
        lower, upper = math.floor(lower), math.ceil(upper)
    return KeyRange(column, lower, upper, partitions)


def read_table(
    spark: SparkSession,
    connection: Mapping[str, str],
    table: str,
    *,
    contract: Contract | None = None,
    keys: KeyRange | None = None,
    predicates: Sequence[str] | None = None,
    fetch_rows: int = FETCH_ROWS,
) -> DataFrame:
    """A database table, its types overridden by the contract when there is one.

    Without ``keys`` or ``predicates`` the database is read by one task, which
    suits small tables only. ``predicates`` are one WHERE condition per task,
    for tables that have no evenly spread column; together they must cover
    every row once.
    """
    options = read_options(connection, table, contract=contract, keys=keys, fetch_rows=fetch_rows)
    if predicates:
        if keys:
            raise ValueError("give keys or predicates, not both")
        url, name = options.pop("url"), options.pop("dbtable")
        return spark.read.jdbc(url, name, predicates=list(predicates), properties=options)
    return spark.read.format("jdbc").options(**options).load()
