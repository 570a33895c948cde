"""The two rule sets under which the same averages are taken."""

from __future__ import annotations

from tributary.operators.enrich import DIMENSION, FACT
from tributary.operators.stats import AFTER, BEFORE, StatsSpec

# Keys, measures and the word for a missing medal.
_COMMON = StatsSpec(
    on=("athlete_id",),
    group_by=("sport", "medal", "sex", "country_noc"),
    measures={"avg_height": "height", "avg_weight": "weight"},
    fill={"medal": "nan"},
)

# Whole silver tables: the country is the athlete's, a missing medal is named
# after grouping and stays apart from one that reads "nan".
BATCH_STATS = _COMMON.with_(prefer=DIMENSION, fill_when=AFTER)

# One micro-batch: the country is the event's, a missing medal is named before
# grouping and joins one that reads "nan".
STREAM_STATS = _COMMON.with_(prefer=FACT, fill_when=BEFORE)
