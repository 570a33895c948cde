"""Which sinks have a batch, and what those that missed one are still to get."""

from __future__ import annotations

import hashlib
import json
import logging
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from tributary.scratch import children, discard, exists, read_small, write_small
from tributary.sinks.batches import BatchSink, sink_names, sink_of_query

log = logging.getLogger(__name__)

REMEMBERED = 100  # batches; Spark runs none again but the last


def _short(name: str) -> str:
    return hashlib.sha256(name.encode()).hexdigest()[:32]


@dataclass(frozen=True)
class Ledger:
    """Marks of the batches that sinks have, below a folder all drivers of a stream share.

    A mark is made after the sink has returned. Between the two a driver may still be lost, and the sink then
    gets the batch again: a sink that can only add has a batch at least once, but not again because another sink failed.
    """

    spark: SparkSession
    path: str
    query: str = ""

    def _batch(self, batch_id: int) -> str:
        return f"{self.path.rstrip('/')}/{self.query or 'batches'}/{batch_id}"

    def has(self, batch_id: int, sink: str) -> bool:
        return exists(self.spark, f"{self._batch(batch_id)}/{_short(sink)}")

    def mark(self, batch_id: int, sink: str) -> None:
        write_small(self.spark, f"{self._batch(batch_id)}/{_short(sink)}", sink)
        if batch_id >= REMEMBERED:
            discard(self.spark, self._batch(batch_id - REMEMBERED))


@dataclass(frozen=True)
class DeadLetters:
    """Batches that sinks have missed: the computed rows, by stream, batch and sink.

    A folder has the rows, and beside it a small file, made last, says what they are.
    """

    spark: SparkSession
    path: str
    query: str = ""

    def keep(self, df: DataFrame, batch_id: int, sinks: Sequence[str], error: BaseException) -> None:
        for sink in sinks:
            place = f"{self.path.rstrip('/')}/{self.query or 'batches'}-{batch_id}-{_short(sink)}"
            df.write.mode("overwrite").parquet(f"{place}/rows")
            about = {"query": self.query, "batch_id": batch_id, "sink": sink, "error": str(error)[:2000]}
            write_small(self.spark, f"{place}/letter.json", json.dumps(about))
            log.warning("batch %s is kept for %s at %s", batch_id, sink, place)


@dataclass(frozen=True)
class Letter:
    """A batch that a sink is still to get."""

    place: str
    query: str
    batch_id: int
    sink: str
    error: str


def dead_letters(spark: SparkSession, path: str) -> list[Letter]:
    """What is to be delivered, in the order of streams and batches."""
    letters = []
    for name in children(spark, path):
        place = f"{path.rstrip('/')}/{name}"
        if exists(spark, f"{place}/letter.json"):
            letters.append(Letter(place=place, **json.loads(read_small(spark, f"{place}/letter.json"))))
    return sorted(letters, key=lambda letter: (letter.query, letter.batch_id, letter.sink))


def deliver_dead_letters(spark: SparkSession, path: str, sinks: Sequence[BatchSink]) -> list[Letter]:
    """Hand the batches kept below ``path`` to the sinks that missed them, and forget those delivered; returns these.

    Sinks are known by their names (``sink_names``); what is kept for another stays. A sink that fails ends the
    run, and its batch and those after it stay.
    """
    by_name = dict(zip(sink_names(sinks), sinks, strict=True))
    done = []
    for letter in dead_letters(spark, path):
        if letter.sink in by_name:
            sink = sink_of_query(by_name[letter.sink], letter.query) if letter.query else by_name[letter.sink]
            sink(spark.read.parquet(f"{letter.place}/rows"), letter.batch_id)
            # The small file first: without it the rows are no letter.
            discard(spark, f"{letter.place}/letter.json")
            discard(spark, letter.place)
            done.append(letter)
    return done
