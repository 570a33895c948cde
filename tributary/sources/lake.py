"""Lake tables: snapshots below a table's folder, and a manifest that names the one that counts.

``<zone>/<table>/_snapshots/<id>`` holds a table as one write left it, in Parquet, and
``<zone>/<table>/_manifest/<version>`` the id. A version is there as a whole or not at all, so a reader
sees the table before a write or after it. A plain folder of Parquet files is read as it is.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from tributary.contracts import Contract
from tributary.scratch import children, read_small

SNAPSHOTS, MANIFEST = "_snapshots", "_manifest"


def zone_path(zone: str, table: str) -> str:
    return f"{zone.rstrip('/')}/{table}"


def versions(spark: SparkSession, path: str) -> list[str]:
    """The manifest's versions, oldest first."""
    return sorted(name for name in children(spark, f"{path}/{MANIFEST}") if name.isdigit())


def snapshot_path(spark: SparkSession, zone: str, table: str) -> str:
    """The folder that holds the table now; that of the table itself where nothing names a snapshot."""
    path = zone_path(zone, table)
    known = versions(spark, path)
    return f"{path}/{SNAPSHOTS}/{read_small(spark, f'{path}/{MANIFEST}/{known[-1]}')}" if known else path


def read_zone(spark: SparkSession, zone: str, table: str, contract: Contract | None = None) -> DataFrame:
    """A zone's table as the last whole write left it; with a contract exactly its columns, checked by name and type.

    What is read stays what it was while later writes go on, until ``KEPT`` of them have followed.
    """
    df = spark.read.parquet(snapshot_path(spark, zone, table))
    return contract.conform(df) if contract else df


def counted_files(spark: SparkSession, schema: StructType, path: str, flag: str) -> dict[bool, int]:
    """The rows of a table cut by a flag, by its values, from the footers of its files.

    These are of the tasks whose output counts, however often tasks were run; no column is read.
    """
    rows = spark.read.schema(schema).parquet(path).groupBy(flag).count()
    return {r[flag]: r["count"] for r in rows.collect()}
