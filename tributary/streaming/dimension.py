from __future__ import annotations

import logging
from collections.abc import Sequence
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame

from tributary.operators.stats import PreparedDimension, StatsSpec, prepare_dimension
from tributary.scratch import discard, scratch_path

log = logging.getLogger(__name__)


@dataclass(frozen=True)
class Frozen:
    """A prepared dimension that is cached, and the copy it is read from."""

    dimension: PreparedDimension
    path: str

    def release(self) -> None:
        """Give back the memory and delete the copy; the dimension is of no use then."""
        spark = self.dimension.rows.sparkSession
        self.dimension.rows.unpersist()
        discard(spark, self.path)


def freeze(
    dimension: DataFrame, fact_columns: Sequence[str], spec: StatsSpec, path: str | None = None
) -> Frozen:
    """The dimension as it is now, for the life of a stream.

    It is read and folded once, written below ``path`` or to a scratch table, measured there and read back, so that a lost
    executor's part comes from the copy and not from a database that may have moved on, and cached so that
    a batch does not read the copy again. One that is too large to broadcast is
    cached where its keys hash to and in their order, so that a batch shuffles
    and sorts its events only.
    """
    spark = dimension.sparkSession
    copy = path or scratch_path(spark, "dimension")
    prepared = prepare_dimension(dimension, fact_columns, spec, copy)
    rows = prepared.rows
    if not prepared.broadcast:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
        rows = rows.repartition(partitions, *prepared.on).sortWithinPartitions(*prepared.on)
    cached = rows.cache()
    log.info("dimension of %s rows frozen at %s", cached.count(), copy)
    return Frozen(replace(prepared, rows=cached), copy)
