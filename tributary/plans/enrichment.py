"""The streaming job: JSON events in, averages per micro-batch out."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from tributary.contracts import ATHLETE_EVENT_RESULTS, Contract
from tributary.functions.payload import CORRUPT
from tributary.operators.clean import require_castable, require_not_null
from tributary.operators.codec import decode_rows, undecodable
from tributary.operators.enrich import DIMENSION
from tributary.operators.stats import StatsSpec
from tributary.plans.presets import STREAM_STATS
from tributary.sinks.batches import BatchSink
from tributary.sources.topics import Topic, stream_topic
from tributary.streaming.enrichment import start_enrichment


def usable_dimension(dimension: DataFrame, spec: StatsSpec = STREAM_STATS, facts: Sequence[str] = ()) -> DataFrame:
    """The rows whose measures all read as numbers, and the columns a spec takes from them.

    ``facts`` are the fact columns, which come first if the spec prefers them. The
    text ``nan`` reads as a number and stays.
    """
    taken = set(facts) - set(spec.on) if spec.prefer != DIMENSION else set()
    columns = [c for c in spec.columns if c in dimension.columns and c not in taken]
    measures = [c for c in spec.measures.values() if c in columns]
    present = require_not_null(dimension.select(*columns), *measures) if measures else dimension.select(*columns)
    return require_castable(present, *measures) if measures else present


def run_event_enrichment(
    spark: SparkSession,
    topic: Topic,
    bio: DataFrame,
    sinks: Sequence[BatchSink],
    *,
    checkpoint: str,
    contract: Contract = ATHLETE_EVENT_RESULTS,
    spec: StatsSpec = STREAM_STATS,
    rejects: BatchSink | None = None,
    **options,
) -> StreamingQuery:
    """Decode the topic, join it with the usable dimension, average, write to every sink.

    ``options`` are those of ``start_enrichment``. Only the fields the spec uses
    are decoded. A message that does not parse has no key, is counted, and meets
    no dimension row; ``rejects`` gets such messages and those without a key, at
    the price of decoding each batch a second time.
    """
    used = StructType([field for field in contract.schema.fields if field.name in spec.columns])
    messages = stream_topic(spark, topic)
    if rejects:
        events = decode_rows(messages, used, corrupt=CORRUPT, keep=("value",))
        options["first"] = lambda batch, batch_id: rejects(_useless(batch, spec), batch_id)
    else:
        events = decode_rows(messages, used)
    dimension = usable_dimension(bio, spec, used.names)
    return start_enrichment(events, dimension, spec, sinks, checkpoint=checkpoint, **options)


def _useless(batch: DataFrame, spec: StatsSpec) -> DataFrame:
    return batch.filter(undecodable(CORRUPT, *spec.on)).select("value")
