"""Copying tables from one place to another, and onto a topic."""

from __future__ import annotations

import logging
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tributary.operators.rejects import REASONS, Rule, is_valid, tag_rejects
from tributary.scratch import scratch_path
from tributary.sinks.tables import write_topic
from tributary.sources.lake import counted_files, zone_path
from tributary.sources.topics import Topic

log = logging.getLogger(__name__)

_VALID = "valid"


@dataclass(frozen=True)
class Copied:
    """The outcome of one table's copy and where its rejected rows are."""

    rows: int
    rejected: int
    rejects: DataFrame


def copy_tables(
    spark: SparkSession,
    rules: Mapping[str, Sequence[Rule]],
    read: Callable[[str], DataFrame],
    write: Callable[[DataFrame, str], None],
    *,
    staging: str | None = None,
    write_rejects: Callable[[DataFrame, str], None] | None = None,
) -> dict[str, Copied]:
    """Copy each named table, leaving out the rows its rules refuse.

    Those go to ``write_rejects``, with the names of the rules they break.

    ``read`` and ``write`` are the two ends, for instance a database reader and
    a database writer. The source is read once, into a staged table cut by
    whether a row is valid. Both the copy and the rejects come from there, so
    they are of the same moment and a lost executor does not ask the source again.
    """
    root = staging or scratch_path(spark, "copy")
    outcome = {}
    for table, table_rules in rules.items():
        tagged = tag_rejects(read(table).withColumn(_VALID, is_valid(table_rules)), table_rules)
        path = zone_path(root, table)
        tagged.write.mode("overwrite").partitionBy(_VALID).parquet(path)
        staged = spark.read.schema(tagged.schema).parquet(path)
        counts = counted_files(spark, tagged.schema, path, _VALID)
        write(staged.filter(_VALID).drop(_VALID, REASONS), table)
        rejects = staged.filter(f"not {_VALID}").drop(_VALID)
        if write_rejects:
            write_rejects(rejects, table)
        outcome[table] = Copied(sum(counts.values()), counts.get(False, 0), rejects)
        log.info("%s: %s rows, %s rejected", table, outcome[table].rows, outcome[table].rejected)
    return outcome


def replay_table(df: DataFrame, topic: Topic) -> None:
    """Send a whole table to a topic, one JSON message per row; each run sends it again."""
    write_topic(df, topic)
