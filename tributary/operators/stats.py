"""Averages over facts joined with a dimension, without building every joined row.

An average is a sum and a count, and both can be taken before the join: a fact
that meets ``n`` equal dimension rows adds ``n`` times to a fact sum, and a
dimension row that meets ``m`` facts adds ``m`` times to a dimension sum. So

* the dimension is always folded to one row per key and dimension group key,
  which keeps a key that is repeated in it from multiplying the facts, and
* when the dimension is too large to broadcast, the facts may be folded as well,
  inside each task before anything is shuffled. A key that holds a third of all
  facts then shuffles a few rows per task instead of a third of the table.

Folding facts pays where keys repeat. Where they hardly do, it shuffles the facts
once to fold them and most of them again to join them, and where there are very many
of them, each task holds a large map; then they are better
joined as they are, and adaptive execution splits the partitions of hot keys.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tributary.functions.numbers import KEEP_NAN, addends, mean_of, measure
from tributary.functions.sums import added
from tributary.operators.clean import fill_missing, require_not_null
from tributary.operators.enrich import AUTO, BROADCAST, DIMENSION, SHUFFLE, fits_broadcast, joinable, own_columns
from tributary.scratch import scratch_path
from tributary.settings import BROADCAST_LIMIT_BYTES

BEFORE, AFTER = "before", "after"

# Rows of a large table are spread over so many tasks that only hot keys shrink
# before the shuffle. Folding then costs a second shuffle of one row per group,
# and this bounds that at a quarter of the rows.
ROWS_PER_GROUP = 4

# A task may meet every group, and its map of them, some 250 bytes each and more with several measures,
# is not to grow with the table: facts of more groups than this are joined as they are.
MOST_GROUPS = 1_000_000


@dataclass(frozen=True)
class StatsSpec:
    """What to average, by what, and under which rules.

    ``measures`` maps an output name to a column of either side. ``prefer``
    names the side that owns a column both have. ``fill`` replaces null group
    keys ``before`` or ``after`` the grouping. ``stamp`` names the column that
    takes the run's time, or is None for no such column.

    Results do not depend on ``join``, ``broadcast_limit``, ``fold_facts`` and
    ``unique_dimension``, nor on the order of the rows, only the work does: doubles are added exactly,
    and decimals are with ``scale``. ``fold_facts`` is for dimensions
    that are not broadcast; None leaves it to ``folding_pays``, and a stream then
    folds. ``unique_dimension=True`` saves folding a dimension known to hold each
    key once.
    """

    on: tuple[str, ...]
    group_by: tuple[str, ...]
    measures: Mapping[str, str]
    prefer: str = DIMENSION
    measure_policy: str = KEEP_NAN
    scale: int | None = None
    fill: Mapping[str, str] = field(default_factory=dict)
    fill_when: str = AFTER
    join: str = AUTO
    broadcast_limit: int = BROADCAST_LIMIT_BYTES
    fold_facts: bool | None = None
    unique_dimension: bool = False
    stamp: str | None = "timestamp"

    def __post_init__(self):
        if self.fill_when not in (BEFORE, AFTER):
            raise ValueError(f"unknown time to fill {self.fill_when!r}")

    def with_(self, **changes) -> StatsSpec:
        return replace(self, **changes)

    @property
    def columns(self) -> tuple[str, ...]:
        """Every input column the spec uses, of either side."""
        return tuple(dict.fromkeys([*self.on, *self.group_by, *self.measures.values()]))


@dataclass(frozen=True)
class PreparedDimension:
    """A dimension reduced to what a spec needs, and how it is to be joined."""

    rows: DataFrame
    on: tuple[str, ...]
    group_by: tuple[str, ...]
    measures: tuple[str, ...]
    broadcast: bool


def prepare_dimension(
    dimension: DataFrame, fact_columns: Sequence[str], spec: StatsSpec, path: str | None = None
) -> PreparedDimension:
    """Fold the dimension once; a stream does this at start and reuses it for every batch.

    With a ``path``, or if working the dimension out takes a shuffle, the folded rows are written
    there, or to a scratch table, and the copy is measured and joined. A dimension beyond the limit is shuffled even
    if the spec asks for ``broadcast``: the averages are the same, and its memory would grow with the table.
    """
    if spec.prefer != DIMENSION:
        dimension = dimension.drop(*(set(fact_columns) - set(spec.on)))
    group_by = tuple(c for c in spec.group_by if c in dimension.columns and c not in spec.on)
    measures = tuple(name for name, column in spec.measures.items() if column in dimension.columns)
    needed = {*spec.on, *group_by, *(spec.measures[name] for name in measures)}
    pruned = require_not_null(dimension.select(*[c for c in dimension.columns if c in needed]), *spec.on)
    if spec.fill_when == BEFORE:
        pruned = fill_missing(pruned, spec.fill)
    keys = (*spec.on, *group_by)
    rows = (_one_each if spec.unique_dimension else _folded)(pruned, keys, measures, spec, "d")
    if path or (spec.join != SHUFFLE and shuffles(pruned)):
        path = path or scratch_path(rows.sparkSession, "dimension")
        rows.write.mode("overwrite").parquet(path)
        rows = pruned = rows.sparkSession.read.schema(rows.schema).parquet(path)
    broadcast = fits_broadcast(pruned, AUTO if spec.join == BROADCAST else spec.join, spec.broadcast_limit)
    return PreparedDimension(rows, spec.on, group_by, measures, broadcast)


def shuffles(df: DataFrame) -> bool:
    """Whether working a table out shuffles rows, so that it is better not done twice."""
    return "Exchange" in df._jdf.queryExecution().executedPlan().toString()


def stats_of(
    facts: DataFrame, dimension: PreparedDimension, spec: StatsSpec, run_ts: Column | None = None
) -> DataFrame:
    """Average facts against a prepared dimension: group keys, averages, stamp."""
    in_facts = [name for name in spec.measures if name not in dimension.measures]
    fact_keys = [c for c in spec.group_by if c not in dimension.group_by]
    needed = list(dict.fromkeys([*spec.on, *fact_keys, *(spec.measures[n] for n in in_facts)]))
    pruned = require_not_null(facts.select(*needed), *spec.on)
    if spec.fill_when == BEFORE:
        pruned = fill_missing(pruned, spec.fill)

    keys = list(dict.fromkeys([*spec.on, *fact_keys]))
    partials = _one_each if dimension.broadcast or spec.fold_facts is False else _folded
    left = partials(pruned, keys, in_facts, spec, "f")
    joined = left.join(joinable(dimension.rows, dimension.broadcast), list(spec.on), "inner")

    partials = {}
    for name in spec.measures:
        side, other = ("d", "f") if name in dimension.measures else ("f", "d")
        rows_met = f"__{other}_rows"
        weight = F.col(rows_met) if rows_met in joined.columns else None
        sums = added(_summable(joined, side, name, spec), weight)
        partials |= {f"__sum_{name}{part}": column for part, column in sums.items()}
        partials[f"__count_{name}"] = F.sum(_times(F.col(f"__{side}_count_{name}"), weight))
    summed = joined.groupBy(*spec.group_by).agg(*(column.alias(name) for name, column in partials.items()))
    averages = [
        mean_of({part: F.col(f"__sum_{name}{part}") for part in _parts(spec)}, F.col(f"__count_{name}"), spec.scale).alias(name)
        for name in spec.measures
    ]
    result = summed.select(*spec.group_by, *averages)
    if spec.stamp:
        result = result.withColumn(spec.stamp, F.current_timestamp() if run_ts is None else run_ts)
    return fill_missing(result, spec.fill) if spec.fill_when == AFTER else result


def grouped_stats(
    facts: DataFrame, dimension: DataFrame, spec: StatsSpec, run_ts: Column | None = None
) -> DataFrame:
    """Inner-join facts and dimension and average per group, under the spec's rules."""
    facts, dimension = own_columns(facts, dimension, spec.on, spec.prefer)
    prepared = prepare_dimension(dimension, facts.columns, spec)
    if spec.fold_facts is None and not prepared.broadcast:
        keys = [c for c in spec.group_by if c not in prepared.group_by and c not in spec.on]
        spec = spec.with_(fold_facts=folding_pays(require_not_null(facts, *spec.on), [*spec.on, *keys]))
    return stats_of(facts, prepared, spec, run_ts)


def folding_pays(facts: DataFrame, keys: Sequence[str]) -> bool:
    """Whether facts repeat their keys often enough, and these are few enough, to be folded before a join.

    One aggregate over the key columns, in a sketch of fixed size per task; the
    answer only chooses between two plans for the same result. Facts that take a shuffle
    to work out are not worked out to ask. Without adaptive execution a hot key has to be folded in any case.
    """
    conf = facts.sparkSession.conf
    if "false" in (conf.get("spark.sql.adaptive.enabled"), conf.get("spark.sql.adaptive.skewJoin.enabled")):
        return True
    if shuffles(facts):
        return True
    groups = F.approx_count_distinct(F.xxhash64(*keys))
    seen = facts.agg(F.count(F.lit(1)).alias("rows"), groups.alias("groups")).first()
    return seen["groups"] <= MOST_GROUPS and seen["groups"] * ROWS_PER_GROUP <= seen["rows"]


def _folded(df: DataFrame, keys, measures, spec: StatsSpec, side: str) -> DataFrame:
    """One row per key: rows met, and the sum and count of each measure."""
    partials = [F.count(F.lit(1)).alias(f"__{side}_rows")]
    for name in measures:
        value = measure(spec.measures[name], spec.measure_policy, spec.scale)
        sums = added(addends(value, spec.scale))
        partials += [column.alias(f"__{side}_sum_{name}{part}") for part, column in sums.items()]
        partials.append(F.count(value).alias(f"__{side}_count_{name}"))
    return df.groupBy(*keys).agg(*partials)


def _one_each(df: DataFrame, keys, measures, spec: StatsSpec, side: str) -> DataFrame:
    """The keys of rows that stand for themselves, and each measure's value and count."""
    partials = []
    for name in measures:
        value = measure(spec.measures[name], spec.measure_policy, spec.scale)
        count = value.isNotNull().cast("bigint")
        partials += [value.alias(f"__{side}_value_{name}"), count.alias(f"__{side}_count_{name}")]
    return df.select(*keys, *partials)


def _parts(spec: StatsSpec) -> list[str]:
    return list(addends(F.lit(0.0), spec.scale))


def _summable(joined: DataFrame, side: str, name: str, spec: StatsSpec) -> dict[str, Column]:
    """The addends of a measure: sums of folded rows, or those of a row's value, which is cut after the join."""
    value = f"__{side}_value_{name}"
    if value in joined.columns:
        return addends(F.col(value), spec.scale)
    return {part: F.col(f"__{side}_sum_{name}{part}") for part in _parts(spec)}


def _times(value: Column, weight: Column | None) -> Column:
    return value if weight is None else value * weight
