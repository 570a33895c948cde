"""Joining facts with a dimension."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, MapType, StringType, StructType

from tributary.settings import BROADCAST_LIMIT_BYTES

FACT, DIMENSION = "fact", "dimension"
AUTO, BROADCAST, SHUFFLE = "auto", "broadcast", "shuffle"

_WORD = 8
_ROW_OVERHEAD = 24


@dataclass(frozen=True)
class Size:
    rows: int
    bytes: int


def measured_size(df: DataFrame) -> Size:
    """Rows and bytes of a table, from one aggregate over it.

    Fixed-width columns need the row count only; of the others the lengths are
    added up where the rows are. One row comes back.
    """
    lengths = []
    for field in df.schema.fields:
        name = f"`{field.name}`"
        if isinstance(field.dataType, StringType | BinaryType):
            lengths.append(F.octet_length(name))
        elif isinstance(field.dataType, ArrayType | MapType | StructType):
            lengths.append(F.octet_length(F.to_json(F.struct(name))))
    total = sum((F.coalesce(F.sum(length), F.lit(0)) for length in lengths), F.lit(0).cast("bigint"))
    row = df.agg(F.count(F.lit(1)).alias("n"), total.alias("b")).first()
    return Size(row.n, row.b + row.n * (_ROW_OVERHEAD + 2 * _WORD * len(df.columns)))


def fits_broadcast(df: DataFrame, join: str = AUTO, limit: int = BROADCAST_LIMIT_BYTES) -> bool:
    """Whether to hand the table to every executor.

    Unless the choice is ``shuffle`` it is measured first. Under ``broadcast`` a
    table beyond the limit is refused.
    """
    if join not in (AUTO, BROADCAST, SHUFFLE):
        raise ValueError(f"unknown join choice {join!r}")
    if join == SHUFFLE:
        return False
    size = measured_size(df).bytes
    if join == BROADCAST and size > limit:
        raise ValueError(f"a table of {size} bytes is not broadcast; the limit is {limit}")
    return size <= limit


def joinable(df: DataFrame, broadcast: bool) -> DataFrame:
    """The smaller side of a join with the hint for its plan; beyond the limit Spark's own estimate does not count."""
    return F.broadcast(df) if broadcast else df.hint("merge")


def own_columns(
    facts: DataFrame, dimension: DataFrame, on: Sequence[str], prefer: str
) -> tuple[DataFrame, DataFrame]:
    """Give each column both sides have to the preferred side, dropping the other's."""
    if prefer not in (FACT, DIMENSION):
        raise ValueError(f"unknown side {prefer!r}")
    shared = [c for c in facts.columns if c in dimension.columns and c not in on]
    if prefer == DIMENSION:
        return facts.drop(*shared), dimension
    return facts, dimension.drop(*shared)


def enrich(
    facts: DataFrame,
    dimension: DataFrame,
    on: str | Sequence[str],
    *,
    prefer: str = DIMENSION,
    join: str = AUTO,
    limit: int = BROADCAST_LIMIT_BYTES,
) -> DataFrame:
    """Inner equi-join on columns both sides name alike, each kept once.

    Null keys never match; unmatched facts vanish; a dimension key that occurs
    twice doubles its facts. A dimension within ``limit`` is broadcast, so the
    facts are not shuffled and a hot key does no harm; beyond it Spark shuffles
    both sides and adaptive execution splits the partitions of hot keys.
    """
    keys = [on] if isinstance(on, str) else list(on)
    left, right = own_columns(facts, dimension, keys, prefer)
    return left.join(joinable(right, fits_broadcast(right, join, limit)), keys, "inner")
