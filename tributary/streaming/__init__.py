"""Micro-batch enrichment."""

from tributary.streaming.dimension import freeze
from tributary.streaming.enrichment import BatchCounts, enrich_batches, start_enrichment, wait
from tributary.streaming.fanout import fan_out
from tributary.streaming.ledger import DeadLetters, Ledger, dead_letters, deliver_dead_letters

__all__ = [
    "BatchCounts",
    "DeadLetters",
    "Ledger",
    "dead_letters",
    "deliver_dead_letters",
    "enrich_batches",
    "fan_out",
    "freeze",
    "start_enrichment",
    "wait",
]
