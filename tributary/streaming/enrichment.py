"""A stream of events, averaged per micro-batch against a frozen dimension."""

from __future__ import annotations

import json
import logging
import threading
from collections.abc import Callable, Sequence
from concurrent.futures import Future
from dataclasses import dataclass, fields, replace

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from tributary.operators.stats import PreparedDimension, StatsSpec, stats_of
from tributary.sinks.batches import BatchSink, sink_of_query
from tributary.streaming.dimension import Frozen, freeze
from tributary.scratch import read_small, write_small
from tributary.streaming.fanout import RAISE, fan_out
from tributary.streaming.ledger import DeadLetters, Ledger

log = logging.getLogger(__name__)

TRIGGER_SECONDS = 30
# Beside what Spark keeps in a checkpoint.
DELIVERED, RULES = "delivered", "rules.json"
ONLY_WORK = ("join", "broadcast_limit", "fold_facts", "unique_dimension")


@dataclass(frozen=True)
class BatchCounts:
    """What a batch read: its rows, and those that came with every join key.

    They are for watching a stream, not for settling accounts: rows that are
    read again because an executor was lost are counted again.
    """

    batch_id: int
    rows: int
    keyed: int


def enrich_batches(
    dimension: PreparedDimension,
    spec: StatsSpec,
    sinks: Sequence[BatchSink],
    *,
    on_error: str = RAISE,
    first: BatchSink | None = None,
    on_counts: Callable[[BatchCounts], None] | None = None,
    run_ts: Callable[[int], Column] | None = None,
    query_id: Callable[[], str] | None = None,
    ledger: Ledger | None = None,
    letters: DeadLetters | None = None,
) -> Callable[[DataFrame, int], None]:
    """The function that handles one micro-batch.

    Averages are over that batch alone and never merged with another's. The
    batch's rows are counted while they are averaged, not by a job of their own.
    ``first`` is given the batch itself before that. With a ``query_id`` sinks that
    keep batches apart keep those of different streams apart as well. For ``ledger`` and ``letters`` see ``fan_out``.
    """

    counters = [F.count(F.lit(1)).alias("rows"), F.count_if(_all_present(spec.on)).alias("keyed")]

    def handle(batch: DataFrame, batch_id: int) -> None:
        own = (lambda sink: sink_of_query(sink, query_id())) if query_id else (lambda sink: sink)
        if first:
            own(first)(batch, batch_id)
        seen = Observation(f"batch-{batch_id}")
        stamp = run_ts(batch_id) if run_ts else None
        stats = stats_of(batch.observe(seen, *counters), dimension, spec, stamp)
        of_query = {"query": query_id()} if query_id else {}
        kept = (replace(each, **of_query) if each else None for each in (ledger, letters))
        written = fan_out(stats, [own(sink) for sink in sinks], batch_id, on_error, *kept)
        # Adaptive execution drops a branch it finds empty, and what it observed with it.
        counted = seen.get if written else batch.agg(*counters).first().asDict()
        counts = BatchCounts(batch_id, **counted)
        log.info("%s%s", counts, "" if written else ", nothing to write")
        if on_counts:
            on_counts(counts)

    return handle


def start_enrichment(
    events: DataFrame,
    dimension: DataFrame,
    spec: StatsSpec,
    sinks: Sequence[BatchSink],
    *,
    checkpoint: str,
    every_seconds: int = TRIGGER_SECONDS,
    available_now: bool = False,
    on_error: str = RAISE,
    first: BatchSink | None = None,
    on_counts: Callable[[BatchCounts], None] | None = None,
    run_ts: Callable[[int], Column] | None = None,
    name: str | None = None,
    frozen_path: str | None = None,
    dead_letters: str | None = None,
) -> StreamingQuery:
    """Start averaging an event stream; the dimension stays as it is at this moment.

    ``available_now`` handles what is there and ends. The checkpoint remembers
    which events have been handled and belongs to one stream; its id keeps the stream's output
    apart from that of any other. Beside it is noted which sinks have a batch, so that one that has it does not get it
    again because another failed, and under which rules the stream runs: with others it does not start again. With ``on_error="skip"`` a batch that sinks have missed is kept at
    ``dead_letters``, for ``deliver_dead_letters``. The dimension's copy is at ``frozen_path``, or a scratch
    table, until the stream ends.
    """
    spark = events.sparkSession
    same_rules(spark, checkpoint, spec, events)
    frozen = freeze(dimension, events.columns, spec, frozen_path)
    if spec.fold_facts is False and not frozen.dimension.broadcast:
        frozen.release()
        raise ValueError("a stream folds its facts if the dimension is not broadcast, as a hot key would not be split")
    started: Future[str] = Future()
    handle = enrich_batches(
        frozen.dimension,
        spec,
        sinks,
        on_error=on_error,
        first=first,
        on_counts=on_counts,
        run_ts=run_ts,
        query_id=started.result,
        ledger=Ledger(spark, f"{checkpoint.rstrip('/')}/{DELIVERED}"),
        letters=DeadLetters(spark, dead_letters) if dead_letters else None,
    )
    writer = events.writeStream.option("checkpointLocation", checkpoint).foreachBatch(handle)
    if name:
        writer = writer.queryName(name)
    trigger = {"availableNow": True} if available_now else {"processingTime": f"{every_seconds} seconds"}
    try:
        query = writer.trigger(**trigger).start()
    except Exception:
        frozen.release()
        raise
    started.set_result(query.id)
    threading.Thread(target=_release_at_end, args=(query, frozen), daemon=True).start()
    return query


def same_rules(spark: SparkSession, checkpoint: str, spec: StatsSpec, events: DataFrame) -> None:
    """Note the rules a checkpoint's results are made by, or refuse if it has others.

    Settings that change the work only, not the results, may change.
    """
    rules = {field.name: getattr(spec, field.name) for field in fields(spec) if field.name not in ONLY_WORK}
    used = {f.name: f.dataType.simpleString() for f in events.schema.fields if f.name in spec.columns}
    text = json.dumps({"rules": rules, "columns": used}, sort_keys=True, default=dict)
    path = f"{checkpoint.rstrip('/')}/{RULES}"
    if not write_small(spark, path, text) and (noted := read_small(spark, path)) != text:
        raise ValueError(f"{checkpoint} is of a stream with other rules: {noted}; now: {text}. Take another checkpoint, or the rules it has")


def _release_at_end(query: StreamingQuery, frozen: Frozen) -> None:
    try:
        query.awaitTermination()
    except StreamingQueryException:
        pass  # whoever waits for the stream is told
    try:
        frozen.release()
    except Exception:
        log.warning("the dimension at %s was not released", frozen.path, exc_info=True)


def wait(query: StreamingQuery, seconds: float | None = None) -> bool:
    """Wait until the stream ends, or for so many seconds; True when it has ended."""
    if seconds is None:
        query.awaitTermination()
        return True
    return bool(query.awaitTermination(seconds))


def _all_present(columns: Sequence[str]) -> Column:
    present = F.lit(True)
    for name in columns:
        present = present & F.col(name).isNotNull()
    return present
