"""Stand-in tables and SQL fragments that read the same in both engines.

The shared tables are clean, so dirty values, missing keys and repeated rows
are put in by expression, over all of their rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from conformance.registry import table


def dirty(key: str, value: str) -> str:
    """A number as text; five in ten are ill-formed, missing or padded."""
    return (
        f"case {key} % 10 when 0 then '77-80' when 1 then 'nan' when 2 then null "
        f"when 3 then '' when 4 then ' 165 ' else cast({value} as string) end"
    )


def exact_avg(value: str) -> str:
    """An average whose sum does not depend on the order of the rows."""
    number = f"try_cast({value} as decimal(28,2))"
    return f"cast(sum({number}) as double) / count({number})"


BIO_COLUMNS = {
    "athlete_id": "cast(c_custkey as int)",
    "name": "c_name",
    "sex": "c_mktsegment",
    "born": "cast(null as string)",
    "height": dirty("c_custkey", "c_acctbal"),
    "weight": dirty("(c_custkey + 3)", "c_nationkey"),
    "country": "concat(' Country, \"', cast(c_nationkey as string), '\" ')",
    "country_noc": "concat('N', cast(c_nationkey as string))",
    "description": "case when c_custkey % 4 = 0 then null else concat(c_name, '\nsecond line, ', c_mktsegment) end",
    "special_notes": "case when c_custkey % 3 = 0 then null else c_mktsegment end",
}

RESULT_COLUMNS = {
    "edition": "cast(year(ts) as string)",
    "edition_id": "cast(event_id % 60 as int)",
    "country_noc": "concat('E', cast(user_id % 7 as string))",
    "sport": "event_type",
    "event": "concat(event_type, ', ', props)",
    "result_id": "event_id",
    "athlete": "cast(user_id as string)",
    "athlete_id": "case when event_id % 50 = 7 then null else cast(user_id as int) end",
    "pos": "cast(event_id % 8 as string)",
    "medal": "case event_id % 4 when 0 then null when 1 then 'nan' when 2 then 'Gold' else 'Silver' end",
    "isTeamSport": "case when event_id % 2 = 0 then 'True' else 'False' end",
}


def _select(columns: dict[str, str], source: str) -> str:
    return "select " + ", ".join(f"{expr} as {name}" for name, expr in columns.items()) + f" from {source}"


# Every athlete occurs a second time with other padding and case.
_PADDED = BIO_COLUMNS | {
    "name": "concat('  ', upper(c_name), ' ')",
    "sex": "concat(' ', lower(c_mktsegment))",
}

BIO_SQL = f"{_select(BIO_COLUMNS, 'customer')} union all {_select(_PADDED, 'customer')}"
RESULTS_SQL = _select(RESULT_COLUMNS, "events")


def bio(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = table(spark, sf_dir, "customer")
    first, again = (
        customer.selectExpr(*(f"{e} as {n}" for n, e in columns.items())) for columns in (BIO_COLUMNS, _PADDED)
    )
    return first.unionAll(again)


def results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(*(f"{e} as {n}" for n, e in RESULT_COLUMNS.items()))


def _normal(columns: dict[str, str]) -> str:
    numbers = ("athlete_id", "edition_id", "result_id")
    return ", ".join(name if name in numbers else f"trim(lower({name})) as {name}" for name in columns)


# The batch rule set on the stand-ins: normal text, no equal rows, the athlete's
# country, a missing medal named after grouping.
BATCH_STATS_SQL = f"""
    with bio as (select distinct {_normal(BIO_COLUMNS)} from ({BIO_SQL})),
    results as (select distinct {_normal(RESULT_COLUMNS)} from ({RESULTS_SQL})),
    stats as (
        select r.sport, r.medal, b.sex, b.country_noc,
               {exact_avg('b.height')} as avg_height, {exact_avg('b.weight')} as avg_weight
        from results r join bio b on r.athlete_id = b.athlete_id
        group by r.sport, r.medal, b.sex, b.country_noc)
    select sport, coalesce(medal, 'nan') as medal, sex, country_noc, avg_height, avg_weight from stats
"""

# The streaming rule set as one batch: text as it is, athletes with two numbers,
# the event's country, a missing medal named before grouping.
STREAM_STATS_SQL = f"""
    with bio as (
        select athlete_id, sex, height, weight from ({BIO_SQL})
        where try_cast(height as float) is not null and try_cast(weight as float) is not null),
    results as (select *, coalesce(medal, 'nan') as medal_key from ({RESULTS_SQL}))
    select r.sport, r.medal_key as medal, b.sex, r.country_noc,
           {exact_avg('b.height')} as avg_height, {exact_avg('b.weight')} as avg_weight
    from results r join bio b on r.athlete_id = b.athlete_id
    group by r.sport, r.medal_key, b.sex, r.country_noc
"""
