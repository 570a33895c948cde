"""Event topics: a broker's topic, or a folder of text files with one message per line."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class KafkaTopic:
    """One topic of a broker; needs Spark's Kafka connector on the class path.

    ``options`` go to the connector as they are: ``maxOffsetsPerTrigger`` bounds
    a micro-batch, ``minPartitions`` splits a topic partition that is far larger
    than the others.
    """

    servers: str
    name: str
    starting_offsets: str = "earliest"
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def format(self) -> str:
        return "kafka"

    def read_options(self) -> dict[str, str]:
        return {
            "kafka.bootstrap.servers": self.servers,
            "subscribe": self.name,
            "startingOffsets": self.starting_offsets,
            **self.options,
        }

    def write_options(self, batch_id: int | None = None, query_id: str | None = None) -> dict[str, str]:
        return {"kafka.bootstrap.servers": self.servers, "topic": self.name, **self.options}


@dataclass(frozen=True)
class FileTopic:
    """A folder whose text files hold one message per line.

    ``options`` go to the file source: ``maxFilesPerTrigger`` or
    ``maxBytesPerTrigger`` bounds a micro-batch.
    """

    path: str
    options: Mapping[str, str] = field(default_factory=dict)

    @property
    def format(self) -> str:
        return "text"

    def read_options(self) -> dict[str, str]:
        return {"path": self.path, "recursiveFileLookup": "true", **self.options}

    def write_options(self, batch_id: int | None = None, query_id: str | None = None) -> dict[str, str]:
        """Each batch of a stream has a folder of its own."""
        of_query = f"/query={query_id}" if query_id else ""
        return {"path": self.path if batch_id is None else f"{self.path}{of_query}/batch_id={batch_id}"}


Topic = KafkaTopic | FileTopic


def stream_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """The topic as an unbounded table with the message in ``value``."""
    return spark.readStream.format(topic.format).options(**topic.read_options()).load()


def read_topic(spark: SparkSession, topic: Topic) -> DataFrame:
    """What the topic holds now, as a bounded table with the message in ``value``."""
    return spark.read.format(topic.format).options(**topic.read_options()).load()
