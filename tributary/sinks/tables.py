"""Writers of whole tables."""

from __future__ import annotations

import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame

from tributary.operators.codec import encode_rows
from tributary.scratch import discard, exists, read_small, write_small
from tributary.sources.lake import MANIFEST, SNAPSHOTS, versions, zone_path
from tributary.sources.topics import KafkaTopic, Topic

BATCH_ROWS = 5_000
KEPT = 3  # snapshots of a table, the present one included


@dataclass(frozen=True)
class Buckets:
    """Tables laid out by a key: ``number`` files, each sorted, known to the session's catalog as ``<prefix>_<table>``.

    Tables with the same key and number are joined and grouped by it without a shuffle. Rows without a key share a file.
    """

    key: str
    number: int
    prefix: str

    def name(self, table: str) -> str:
        return f"{self.prefix}_{table}"


def _written(df: DataFrame, path: str, table: str, partition_by: tuple[str, ...], buckets: Buckets | None) -> None:
    if buckets is None:
        (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(path)
        return
    # A task has the rows of one file, as Spark deals rows over tasks and over buckets alike.
    writer = df.repartition(buckets.number, buckets.key).write.bucketBy(buckets.number, buckets.key).sortBy(buckets.key)
    writer.mode("overwrite").option("path", path).format("parquet").saveAsTable(buckets.name(table))


def overwrite_zone(
    df: DataFrame, zone: str, table: str, partition_by: tuple[str, ...] = (), buckets: Buckets | None = None
) -> str:
    """Replace a zone's table in one step and return the folder of its new snapshot.

    The rows are written aside, and then one small file makes them the table. Until then, and if the
    write fails, readers see the table as it was. Of two writers at a time the later one fails. The snapshots
    of the last ``KEPT`` writes stay for those who still read them.
    """
    spark, path = df.sparkSession, zone_path(zone, table)
    known = versions(spark, path)
    snapshot = uuid.uuid4().hex
    target = f"{path}/{SNAPSHOTS}/{snapshot}"
    try:
        _written(df, target, table, partition_by, buckets)
    except Exception:
        discard(spark, target)
        raise
    version = int(known[-1]) + 1 if known else 0
    if not write_small(spark, f"{path}/{MANIFEST}/{version:012d}", snapshot):
        discard(spark, target)
        raise RuntimeError(f"{path} was written by someone else meanwhile")
    for old in known[: max(0, len(known) + 1 - KEPT)]:
        name = f"{path}/{MANIFEST}/{old}"
        discard(spark, f"{path}/{SNAPSHOTS}/{read_small(spark, name)}")
        discard(spark, name)
    return target


def table_options(
    connection: Mapping[str, str], table: str, *, batch_rows: int = BATCH_ROWS, connections: int | None = None
) -> dict[str, str]:
    """The writer options for one database table.

    ``connections`` bounds how many tasks write at a time. A replaced table is
    emptied, not dropped, so that its column types and indexes stay.
    """
    options = {**connection, "dbtable": table, "batchsize": str(batch_rows), "truncate": "true"}
    if connections:
        options["numPartitions"] = str(connections)
    return options


def append_table(
    df: DataFrame,
    connection: Mapping[str, str],
    table: str,
    *,
    mode: str = "append",
    batch_rows: int = BATCH_ROWS,
    connections: int | None = None,
) -> None:
    """Write rows to a database table in bulk, each partition in one transaction.

    Rows are delivered at least once: a write that is run again appends again.
    """
    options = table_options(connection, table, batch_rows=batch_rows, connections=connections)
    df.write.format("jdbc").options(**options).mode(mode).save()


def write_topic(df: DataFrame, topic: Topic, batch_id: int | None = None, query_id: str | None = None) -> None:
    """Send every row as one JSON message, without a message key.

    A broker gets the messages at least once. A folder of files is added to. Where
    a batch id is given, that batch of the stream has a folder: once it is complete it stays as it is,
    so that whoever reads the topic as a stream does not meet its messages again.
    """
    options = topic.write_options(batch_id, query_id)
    of_batch = batch_id is not None and not isinstance(topic, KafkaTopic)
    if of_batch and exists(df.sparkSession, f"{options['path']}/_SUCCESS"):
        return
    writer = encode_rows(df).write.format(topic.format).options(**options)
    writer.mode("overwrite" if of_batch else "append").save()
