"""Filters, averages and joins over whole tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conformance.registry import query, table
from conformance.shapes import BATCH_STATS_SQL, STREAM_STATS_SQL, bio, dirty, exact_avg, results
from tributary.functions import measure
from tributary.functions.numbers import NAN_IS_NULL
from tributary.operators import (
    StatsSpec,
    distinct_rows,
    drop_columns,
    enrich,
    fill_missing,
    grouped_stats,
    mean_by,
    normalize_text,
    require_castable,
    require_not_null,
    split_rejects,
    rule_castable,
    rule_max_length,
    rule_not_null,
)
from tributary.operators.rejects import REASONS
from tributary.plans import BATCH_STATS, STREAM_STATS, usable_dimension

CENTS = 2

EVENT_STATS = StatsSpec(
    on=("user_id",),
    group_by=("event_type", "c_mktsegment", "c_nationkey"),
    measures={"avg_value": "value", "avg_acctbal": "c_acctbal"},
    measure_policy=NAN_IS_NULL,
    scale=CENTS,
    stamp=None,
)

EVENT_STATS_SQL = f"""
    select event_type, c_mktsegment, c_nationkey,
           {exact_avg('value')} as avg_value, {exact_avg('c_acctbal')} as avg_acctbal
    from events join customer on user_id = c_custkey
    group by event_type, c_mktsegment, c_nationkey
"""


def customers(spark, sf_dir):
    return table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "user_id")


@query("enrich_avg_stats", EVENT_STATS_SQL)
def enrich_avg_stats(spark, sf_dir):
    return grouped_stats(table(spark, sf_dir, "events"), customers(spark, sf_dir), EVENT_STATS)


@query("enrich_avg_stats_shuffled", EVENT_STATS_SQL)
def enrich_avg_stats_shuffled(spark, sf_dir):
    """The same as for a dimension that is too large to broadcast."""
    spec = EVENT_STATS.with_(join="shuffle")
    return grouped_stats(table(spark, sf_dir, "events"), customers(spark, sf_dir), spec)


_REPEATED_SQL = f"""
    with dim as (
        select c_custkey, c_mktsegment, c_acctbal, unnest(range(1 + c_nationkey % 3)) as again from customer
        union all select c_custkey, c_mktsegment, c_nationkey, 0 from customer
        union all select c_custkey, 'OTHER', c_acctbal, 0 from customer)
    select event_type, c_mktsegment, {exact_avg('value')} as avg_value, {exact_avg('c_acctbal')} as avg_acctbal
    from events join dim on user_id = c_custkey
    group by event_type, c_mktsegment
"""


def _repeated(spark, sf_dir, join):
    dim = customers(spark, sf_dir)
    columns = ["user_id", "c_mktsegment", "c_acctbal"]
    again = dim.withColumn("again", F.explode(F.array_repeat(F.lit(0), 1 + F.col("c_nationkey") % 3)))
    second = dim.withColumn("c_acctbal", F.col("c_nationkey").cast("double"))
    other = dim.withColumn("c_mktsegment", F.lit("OTHER"))
    dim = again.select(*columns).unionAll(second.select(*columns)).unionAll(other.select(*columns))
    spec = EVENT_STATS.with_(group_by=("event_type", "c_mktsegment"), join=join)
    return grouped_stats(table(spark, sf_dir, "events"), dim, spec)


@query("repeated_keys_broadcast", _REPEATED_SQL)
def repeated_keys_broadcast(spark, sf_dir):
    """Dimension keys that occur three to five times count that often."""
    return _repeated(spark, sf_dir, "broadcast")


@query("repeated_keys_shuffled", _REPEATED_SQL)
def repeated_keys_shuffled(spark, sf_dir):
    return _repeated(spark, sf_dir, "shuffle")


@query(
    "enrich_lineitem_stats",
    f"""
    select l_returnflag, l_linestatus, p_brand,
           {exact_avg('l_quantity')} as avg_quantity, {exact_avg('p_retailprice')} as avg_retailprice
    from lineitem join part on l_partkey = p_partkey
    group by l_returnflag, l_linestatus, p_brand
    """,
)
def enrich_lineitem_stats(spark, sf_dir):
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    spec = EVENT_STATS.with_(
        on=("l_partkey",),
        group_by=("l_returnflag", "l_linestatus", "p_brand"),
        measures={"avg_quantity": "l_quantity", "avg_retailprice": "p_retailprice"},
    )
    return grouped_stats(table(spark, sf_dir, "lineitem"), part, spec)


@query("grouped_stats_batch", BATCH_STATS_SQL)
def grouped_stats_batch(spark, sf_dir):
    """The batch rule set, from uncleaned tables to averages."""
    spec = BATCH_STATS.with_(measure_policy=NAN_IS_NULL, scale=CENTS, stamp=None)
    clean_bio = distinct_rows(normalize_text(bio(spark, sf_dir)))
    clean_results = distinct_rows(normalize_text(results(spark, sf_dir)))
    return grouped_stats(clean_results, clean_bio, spec)


@query("grouped_stats_stream", STREAM_STATS_SQL)
def grouped_stats_stream(spark, sf_dir):
    """The streaming rule set on all events as if they were one batch."""
    spec = STREAM_STATS.with_(measure_policy=NAN_IS_NULL, scale=CENTS, stamp=None)
    return grouped_stats(results(spark, sf_dir), usable_dimension(bio(spark, sf_dir)), spec)


_MEDAL = "case when event_type = 'error' then null when event_type = 'view' then 'nan' else event_type end"


def _with_medal(spark, sf_dir):
    joined = enrich(table(spark, sf_dir, "events"), customers(spark, sf_dir), "user_id")
    return joined.withColumn("medal", F.expr(_MEDAL))


@query(
    "fill_after_agg",
    f"""
    select coalesce(medal, 'nan') as medal, c_mktsegment, avg_value from (
        select {_MEDAL} as medal, c_mktsegment, {exact_avg('value')} as avg_value
        from events join customer on user_id = c_custkey group by {_MEDAL}, c_mktsegment)
    """,
)
def fill_after_agg(spark, sf_dir):
    means = mean_by(
        _with_medal(spark, sf_dir), ["medal", "c_mktsegment"], {"avg_value": "value"}, policy=NAN_IS_NULL, scale=CENTS
    )
    return fill_missing(means, {"medal": "nan"})


@query(
    "fill_before_agg",
    f"""
    select coalesce({_MEDAL}, 'nan') as medal, c_mktsegment, {exact_avg('value')} as avg_value
    from events join customer on user_id = c_custkey group by coalesce({_MEDAL}, 'nan'), c_mktsegment
    """,
)
def fill_before_agg(spark, sf_dir):
    filled = fill_missing(_with_medal(spark, sf_dir), {"medal": "nan"})
    return mean_by(filled, ["medal", "c_mktsegment"], {"avg_value": "value"}, policy=NAN_IS_NULL, scale=CENTS)


_DIRTY = dirty("c_custkey", "c_acctbal")


def _measured(spark, sf_dir):
    return table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", F.expr(_DIRTY).alias("height"))


@query(
    "numeric_castable_filter",
    f"""
    select c_custkey, c_mktsegment, height
    from (select c_custkey, c_mktsegment, {_DIRTY} as height from customer)
    where c_mktsegment is not null and height is not null and try_cast(height as float) is not null
    """,
)
def numeric_castable_filter(spark, sf_dir):
    present = require_not_null(_measured(spark, sf_dir), "c_mktsegment", "height")
    return require_castable(present, "height")


_GAPS = {
    "segment": "case when c_custkey % 4 = 1 then null else c_mktsegment end",
    "nation": "case when c_custkey % 3 = 1 then null else c_nationkey end",
}
_GAPPED = f"select c_custkey, c_acctbal, {_GAPS['segment']} as segment, {_GAPS['nation']} as nation from customer"


def _gapped(spark, sf_dir):
    gaps = [F.expr(expression).alias(name) for name, expression in _GAPS.items()]
    return table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal", *gaps)


@query(
    "not_null_conjunction",
    f"select c_custkey, segment, nation from ({_GAPPED}) where segment is not null and nation is not null",
)
def not_null_conjunction(spark, sf_dir):
    return require_not_null(_gapped(spark, sf_dir), "segment", "nation").drop("c_acctbal")


@query(
    "null_group_keys",
    f"select segment, nation, {exact_avg('c_acctbal')} as avg_acctbal from ({_GAPPED}) group by segment, nation",
)
def null_group_keys(spark, sf_dir):
    """A missing key is a key like any other."""
    return mean_by(
        _gapped(spark, sf_dir), ["segment", "nation"], {"avg_acctbal": "c_acctbal"}, policy=NAN_IS_NULL, scale=CENTS
    )


_SPECIAL = "case user_id % 3 when 0 then null when 1 then cast('nan' as double) else user_id end"


@query(
    "distinct_special_values",
    f"""
    select event_type, count(*) as n, count(v) as present, count(case when isnan(v) then 1 end) as nans
    from (select distinct event_type, {_SPECIAL} as v from events) group by event_type
    """,
)
def distinct_special_values(spark, sf_dir):
    """Nulls are one value, and so are NaNs."""
    special = F.expr(_SPECIAL).alias("v")
    distinct = distinct_rows(table(spark, sf_dir, "events").select("event_type", special))
    return distinct.groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n"), F.count("v").alias("present"), F.count_if(F.isnan("v")).alias("nans")
    )


@query(
    "numeric_measure_clean",
    f"""
    select c_custkey, try_cast(height as double) as height
    from (select c_custkey, {_DIRTY} as height from customer)
    where try_cast(height as double) is not null and not isnan(try_cast(height as double))
    """,
)
def numeric_measure_clean(spark, sf_dir):
    numbers = _measured(spark, sf_dir).select("c_custkey", measure("height", NAN_IS_NULL).alias("height"))
    return require_not_null(numbers, "height")


@query(
    "avg_text_measure",
    f"""
    select c_mktsegment, {exact_avg('height')} as avg_height, count(try_cast(height as decimal(28,2))) as n
    from (select c_mktsegment, {_DIRTY} as height from customer) group by c_mktsegment
    """,
)
def avg_text_measure(spark, sf_dir):
    return mean_by(
        _measured(spark, sf_dir),
        ["c_mktsegment"],
        {"avg_height": "height"},
        policy=NAN_IS_NULL,
        scale=CENTS,
        counts={"n": "height"},
    )


@query(
    "avg_text_measure_keep_nan",
    f"""
    select c_custkey % 10 as digit, isnan(avg(try_cast(height as double))) as is_nan,
           count(try_cast(height as double)) as n
    from (select c_custkey, {_DIRTY} as height from customer) group by c_custkey % 10
    """,
)
def avg_text_measure_keep_nan(spark, sf_dir):
    """Which groups the text ``nan`` turns into NaN; null where a group has no number."""
    means = mean_by(
        _measured(spark, sf_dir).withColumn("digit", F.col("c_custkey") % 10),
        ["digit"],
        {"avg_height": "height"},
        counts={"n": "height"},
    )
    is_nan = F.when(F.col("avg_height").isNotNull(), F.isnan("avg_height"))
    return means.select("digit", is_nan.alias("is_nan"), "n")


@query(
    "drop_overlap_join",
    """
    select e.event_id, e.user_id, e.event_type, c.c_nationkey as country, c.c_mktsegment as sex
    from events e join customer c on e.user_id = c.c_custkey
    """,
)
def drop_overlap_join(spark, sf_dir):
    """Both sides have a country; the dimension's is kept."""
    events = table(spark, sf_dir, "events").withColumn("country", F.lit(-1))
    dim = customers(spark, sf_dir).withColumnsRenamed({"c_nationkey": "country", "c_mktsegment": "sex"})
    events = drop_columns(events, "ts", "value", "props", "sex")
    joined = enrich(events, drop_columns(dim, "c_name", "c_acctbal"), "user_id")
    return joined.select("event_id", "user_id", "event_type", "country", "sex")


@query(
    "reject_split",
    f"""
    select c_custkey, height, concat_ws(',',
        case when height is null then 'height_missing' end,
        case when try_cast(height as float) is null then 'height_not_float' end,
        case when length(c_mktsegment) > 9 then 'c_mktsegment_too_long' end) as reasons
    from (select c_custkey, c_mktsegment, {_DIRTY} as height from customer)
    """,
)
def reject_split(spark, sf_dir):
    """Valid and rejected rows put together again: every row once, with its reasons."""
    rules = [rule_not_null("height"), rule_castable("height"), rule_max_length("c_mktsegment", 9)]
    valid, rejects = split_rejects(_measured(spark, sf_dir), rules)
    return valid.select("c_custkey", "height", F.lit("").alias("reasons")).unionAll(
        rejects.select("c_custkey", "height", F.array_join(REASONS, ",").alias("reasons"))
    )


@query(
    "enrich_lineitem_defaults",
    """
    select l_returnflag, l_linestatus, p_brand, avg(l_quantity) as avg_quantity, avg(p_size) as avg_size
    from lineitem join part on l_partkey = p_partkey
    group by l_returnflag, l_linestatus, p_brand
    """,
)
def enrich_lineitem_defaults(spark, sf_dir):
    """The rules as they are by default: doubles that keep NaN. Whole numbers add up alike in any order."""
    part = table(spark, sf_dir, "part").withColumnRenamed("p_partkey", "l_partkey")
    spec = StatsSpec(
        on=("l_partkey",),
        group_by=("l_returnflag", "l_linestatus", "p_brand"),
        measures={"avg_quantity": "l_quantity", "avg_size": "p_size"},
        stamp=None,
    )
    return grouped_stats(table(spark, sf_dir, "lineitem"), part, spec)


_LARGE = "concat(cast(cast(floor(o_totalprice * 100) as bigint) as string), '0000000000000', case when o_orderkey % 3 = 0 then '.25' else '' end)"


@query(
    "avg_large_values",
    f"""
    select o_orderpriority, cast(sum(cast({_LARGE} as decimal(38,2))) as double) / count(*) as avg_price, count(*) as n
    from orders group by o_orderpriority
    """,
)
def avg_large_values(spark, sf_dir):
    """Exact averages of numbers of over twenty digits."""
    orders = table(spark, sf_dir, "orders").select("o_orderpriority", F.expr(_LARGE).alias("price"))
    return mean_by(
        orders,
        ["o_orderpriority"],
        {"avg_price": "price"},
        policy=NAN_IS_NULL,
        scale=CENTS,
        counts={"n": "price"},
    )


# Ways to deal and join the facts: the tasks they are dealt to, one more for each so many rows, and the plan.
_ROWS_A_TASK = 1_000_000
_PLANS = ((1, {}), (7, {"broadcast_limit": 0, "fold_facts": False}), (200, {"broadcast_limit": 0, "fold_facts": True}))
# Of doubles between 2**-12 and 2**40 all bits are whole after this shift, and text is read as the double next to it.
_SHIFT = "pow(2.0, 64)"


@query(
    "avg_doubles_any_order",
    f"""
    select way, l_returnflag, p_brand, cast(cast(sum(cast(l_extendedprice * l_discount * {_SHIFT} as hugeint)) as varchar) as double)
        / {_SHIFT} / count(*) as avg_discount,
        cast(cast(sum(cast(p_retailprice * 0.1::double * {_SHIFT} as hugeint)) as varchar) as double) / {_SHIFT} / count(*) as avg_tenth
    from lineitem join part on l_partkey = p_partkey, (select unnest(range({len(_PLANS)})) as way)
    group by way, l_returnflag, p_brand
    """,
)
def avg_doubles_any_order(spark, sf_dir):
    """Averages of doubles, to the last bit, however the rows are dealt and joined."""
    amount = F.col("l_extendedprice").cast("double") * F.col("l_discount").cast("double")
    facts = table(spark, sf_dir, "lineitem").select("l_partkey", "l_returnflag", amount.alias("amount"))
    tenth = F.col("p_retailprice").cast("double") * F.lit(0.1)
    part = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("l_partkey"), "p_brand", tenth.alias("tenth"))
    spec = StatsSpec(on=("l_partkey",), group_by=("l_returnflag", "p_brand"), measures={"avg_discount": "amount", "avg_tenth": "tenth"}, stamp=None)
    more = facts.count() // _ROWS_A_TASK
    ways = [
        grouped_stats(facts.repartition(parts + more), part, spec.with_(**plan)).withColumn("way", F.lit(way).cast("long"))
        for way, (parts, plan) in enumerate(_PLANS)
    ]
    return reduce(DataFrame.unionAll, ways)
