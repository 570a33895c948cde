"""Where tables, batches and messages are written."""

from tributary.sinks.batches import parquet_batches, sink_names, table_batches, topic_batches
from tributary.sinks.tables import Buckets, append_table, overwrite_zone, table_options, write_topic

__all__ = [
    "Buckets",
    "append_table",
    "overwrite_zone",
    "parquet_batches",
    "sink_names",
    "table_batches",
    "table_options",
    "topic_batches",
    "write_topic",
]
