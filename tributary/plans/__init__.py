"""Jobs: operators, sources and sinks put together."""

from tributary.plans.enrichment import run_event_enrichment, usable_dimension
from tributary.plans.medallion import bronze_to_silver, land_new_files, landing_to_bronze, run_medallion, silver_to_gold
from tributary.plans.presets import BATCH_STATS, STREAM_STATS
from tributary.plans.transfer import copy_tables, replay_table

__all__ = [
    "BATCH_STATS",
    "STREAM_STATS",
    "bronze_to_silver",
    "copy_tables",
    "land_new_files",
    "landing_to_bronze",
    "replay_table",
    "run_event_enrichment",
    "run_medallion",
    "silver_to_gold",
    "usable_dimension",
]
