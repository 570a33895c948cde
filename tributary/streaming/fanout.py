from __future__ import annotations

import logging
from collections.abc import Sequence

from pyspark.sql import DataFrame

from tributary.sinks.batches import BatchSink, sink_names
from tributary.streaming.ledger import DeadLetters, Ledger

log = logging.getLogger(__name__)

RAISE, SKIP = "raise", "skip"


def fan_out(
    df: DataFrame,
    sinks: Sequence[BatchSink],
    batch_id: int,
    on_error: str = RAISE,
    ledger: Ledger | None = None,
    letters: DeadLetters | None = None,
) -> bool:
    """Write one computed table to several sinks in order; False when it is empty.

    The table is computed once and all sinks get the same rows and time stamps.
    A failing sink ends the batch. ``raise`` lets the stream fail, which runs the
    batch again on restart; sinks that have the batch by the ``ledger`` are then left out. ``skip`` logs the failure, and the batch
    counts as done; ``letters`` keep it for the sinks that never got it. A failure to compute the table
    always fails the stream.
    """
    if on_error not in (RAISE, SKIP):
        raise ValueError(f"unknown error policy {on_error!r}")
    names = sink_names(sinks)
    df = df.persist()
    try:
        if df.isEmpty():
            return False
        waiting = [(name, sink) for name, sink in zip(names, sinks, strict=True) if not (ledger and ledger.has(batch_id, name))]
        try:
            while waiting:
                name, sink = waiting[0]
                sink(df, batch_id)
                if ledger:
                    ledger.mark(batch_id, name)
                del waiting[0]
        except Exception as error:
            if on_error == RAISE:
                raise
            log.exception("batch %s: sinks left out", batch_id)
            if letters:
                letters.keep(df, batch_id, [name for name, _ in waiting], error)
        return True
    finally:
        df.unpersist()
