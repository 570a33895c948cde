"""DataFrame in, DataFrame out: the steps the plans are composed of."""

from tributary.operators.clean import (
    distinct_rows,
    drop_columns,
    fill_missing,
    normalize_text,
    require_castable,
    require_not_null,
)
from tributary.operators.codec import decode_rows, encode_rows
from tributary.operators.enrich import enrich, fits_broadcast, measured_size, own_columns
from tributary.operators.means import mean_by
from tributary.operators.rejects import (
    Rule,
    contract_rules,
    rule_castable,
    rule_max_length,
    rule_not_null,
    split_rejects,
    tag_rejects,
)
from tributary.operators.stats import (
    PreparedDimension,
    StatsSpec,
    folding_pays,
    grouped_stats,
    prepare_dimension,
    stats_of,
)

__all__ = [
    "PreparedDimension",
    "Rule",
    "StatsSpec",
    "contract_rules",
    "decode_rows",
    "distinct_rows",
    "drop_columns",
    "encode_rows",
    "enrich",
    "fill_missing",
    "fits_broadcast",
    "folding_pays",
    "grouped_stats",
    "mean_by",
    "measured_size",
    "normalize_text",
    "own_columns",
    "prepare_dimension",
    "require_castable",
    "require_not_null",
    "rule_castable",
    "rule_max_length",
    "rule_not_null",
    "split_rejects",
    "stats_of",
    "tag_rejects",
]
