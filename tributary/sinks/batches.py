"""Sinks of one micro-batch: functions of a table and its batch id.

Batch ids start at 0 with every checkpoint. A sink that replaces a batch when it
is run again therefore also has to know the stream, by ``sink_of_query``.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tributary.sinks.tables import append_table, write_topic
from tributary.sources.topics import Topic

BatchSink = Callable[[DataFrame, int], None]


@dataclass(frozen=True)
class ParquetBatches:
    """See ``parquet_batches``."""

    path: str
    query: str | None = None

    @property
    def name(self) -> str:
        return f"parquet {self.path.rstrip('/')}"

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        of_query = f"/query={self.query}" if self.query else ""
        df.write.mode("overwrite").parquet(f"{self.path.rstrip('/')}{of_query}/batch_id={batch_id}")


@dataclass(frozen=True)
class TopicBatches:
    """See ``topic_batches``."""

    topic: Topic
    query: str | None = None

    @property
    def name(self) -> str:
        return f"topic {getattr(self.topic, 'path', None) or self.topic.name}"

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        write_topic(df, self.topic, batch_id, self.query)


def parquet_batches(path: str) -> BatchSink:
    """One folder per stream and batch, replaced when the batch is run again.

    The folders are ``query=<id>/batch_id=<n>``; outside a stream ``batch_id=<n>``.
    """
    return ParquetBatches(path)


def topic_batches(topic: Topic) -> BatchSink:
    """A message per row. A topic of files has a folder per stream and batch, and one that is complete is left as it is."""
    return TopicBatches(topic)


def sink_of_query(sink: BatchSink, query_id: str) -> BatchSink:
    """The sink for the batches of one stream; sinks that only add rows stay as they are."""
    return replace(sink, query=query_id) if isinstance(sink, ParquetBatches | TopicBatches) else sink


@dataclass(frozen=True)
class TableBatches:
    """See ``table_batches``."""

    connection: Mapping[str, str]
    table: str
    batch_column: str | None = None
    options: Mapping[str, object] = field(default_factory=dict)

    @property
    def name(self) -> str:
        return f"table {self.table}"

    def __call__(self, df: DataFrame, batch_id: int) -> None:
        if self.batch_column:
            df = df.withColumn(self.batch_column, F.lit(batch_id).cast("bigint"))
        append_table(df, self.connection, self.table, **self.options)


def table_batches(
    connection: Mapping[str, str], table: str, *, batch_column: str | None = None, **options
) -> BatchSink:
    """Append to a database table, with the batch id in ``batch_column`` if named.

    A batch that is run again appends again, unless a ledger says that the table has it; the column lets readers tell.
    """
    return TableBatches(connection, table, batch_column, options)


def sink_names(sinks: Sequence[BatchSink]) -> list[str]:
    """A name for each sink that is the same when a stream starts again: by where it writes, else by its place."""
    names = [getattr(sink, "name", None) or f"sink {place}" for place, sink in enumerate(sinks)]
    if len(set(names)) < len(names):
        raise ValueError(f"two sinks write to one place: {names}")
    return names
