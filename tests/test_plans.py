"""The physical plans the operators are meant to have."""

import contextlib
import os

import pytest

from conformance.batch import EVENT_STATS, customers
from conformance.registry import table
from tributary.operators import enrich, folding_pays, grouped_stats, prepare_dimension, stats_of
from tributary.operators.clean import normalize_text
from tributary.streaming import freeze

SF = "/root/testdata/sf0.01"


def plan_of(df, run=False):
    if run:
        df.collect()
    return df._jdf.queryExecution().executedPlan().toString()


@contextlib.contextmanager
def settings(spark, **values):
    names = {k.replace("__", "."): v for k, v in values.items()}
    old = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    try:
        yield
    finally:
        for k, v in old.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def test_small_dimension_leaves_the_facts_where_they_are(spark):
    plan = plan_of(grouped_stats(table(spark, SF, "events"), customers(spark, SF), EVENT_STATS))
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert plan.count("Exchange hashpartitioning") == 2, "one of the dimension, one of the partial averages"
    assert "ReadSchema: struct<user_id:bigint,event_type:string,value:double>" in plan
    assert "PushedFilters: [IsNotNull(user_id)]" in plan


def test_large_dimension_folds_facts_before_the_shuffle(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        spec = EVENT_STATS.with_(broadcast_limit=1, fold_facts=True)
        plan = plan_of(grouped_stats(table(spark, SF, "events"), customers(spark, SF), spec))
    assert "SortMergeJoin" in plan and "Broadcast" not in plan
    below = plan[plan.rindex("SortMergeJoin") :]
    for scan in ("user_id#", "c_custkey#"):
        assert scan in below
    assert below.count("partial_count(1)") == 2, "both sides are folded in the tasks that read them"


def test_unhinted_broadcast_needs_a_measured_size(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        facts, dim = table(spark, SF, "events"), customers(spark, SF)
        assert "BroadcastHashJoin" in plan_of(enrich(facts, dim, "user_id"))
        assert "SortMergeJoin" in plan_of(enrich(facts, dim, "user_id", limit=1))


def test_hot_key_of_a_row_join_is_split(spark):
    facts = spark.range(0, 300_000, 1, 8).selectExpr("if(id % 3 = 0, 0, id) as k", "id as v", "repeat('x', 50) as t")
    dim = spark.range(0, 300_000, 1, 8).selectExpr("id as k", "id * 2 as w")
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100000",
    ):
        joined = enrich(facts, dim, "k", join="shuffle")
        assert joined.selectExpr("count(*) as n", "sum(w) as w").first().n == 300_000
        joined.write.format("noop").mode("overwrite").save()
        plan = plan_of(joined, run=True)
    assert "isSkewJoin=true" in plan or "skewed" in plan


def test_text_is_normalised_in_one_generated_stage(spark):
    plan = plan_of(normalize_text(table(spark, SF, "part")))
    assert plan.count("Project") == 1 and "*(1) Project" in plan


@pytest.mark.parametrize("columns, want", [(("event_type", "c_mktsegment"), "c_mktsegment:string"), (("event_type",), "c_custkey:bigint")])
def test_unused_columns_are_not_read(spark, columns, want):
    spec = EVENT_STATS.with_(group_by=columns, measures={"avg_value": "value"})
    plan = plan_of(grouped_stats(table(spark, SF, "events"), customers(spark, SF), spec))
    assert "props" not in plan and "c_name" not in plan and want in plan


def test_a_frozen_large_dimension_is_not_shuffled_again(spark, folder):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        events, spec = table(spark, SF, "events"), EVENT_STATS.with_(join="shuffle", fold_facts=False)
        kept = freeze(customers(spark, SF), events.columns, spec, folder("copy"))
        frozen = kept.dimension
        plan = plan_of(stats_of(events, frozen, spec))
        plan = plan[: plan.index("InMemoryRelation")]
        assert plan.count("Exchange hashpartitioning") == 2, "the events, and the partial averages"
        assert plan.count("Sort [") == 1
        assert stats_of(events, frozen, spec).count() == grouped_stats(events, customers(spark, SF), spec).count()
        kept.release()
        assert not os.path.exists(folder("copy"))


def test_facts_can_be_left_unfolded(spark):
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        spec = EVENT_STATS.with_(join="shuffle", fold_facts=False, unique_dimension=True)
        plan = plan_of(grouped_stats(table(spark, SF, "events"), customers(spark, SF), spec))
    assert "partial_count(1)" not in plan and plan.count("Exchange") == 3


def test_facts_are_folded_where_keys_repeat(spark):
    events = table(spark, SF, "events")
    assert folding_pays(events, ["user_id", "event_type"]), "10,000 rows of 150 users and five types"
    assert not folding_pays(events, ["event_id"])
    with settings(spark, spark__sql__adaptive__skewJoin__enabled="false"):
        assert folding_pays(events, ["event_id"]), "nothing else would take care of a hot key"
    with settings(spark, spark__sql__autoBroadcastJoinThreshold="-1"):
        spec = EVENT_STATS.with_(join="shuffle", unique_dimension=True)
        repeated = plan_of(grouped_stats(events, customers(spark, SF), spec))
        by_id = spec.with_(group_by=("event_id", "c_mktsegment"))
        unique = plan_of(grouped_stats(events, customers(spark, SF), by_id))
    assert "partial_count(1)" in repeated and "partial_count(1)" not in unique


def test_hot_key_of_unfolded_facts_is_split(spark):
    facts = spark.range(0, 300_000, 1, 8).selectExpr("if(id % 3 = 0, 0, id) as user_id", "id % 5 as event_type", "id as value")
    dim = spark.range(0, 300_000, 1, 8).selectExpr("id as user_id", "id % 4 as c_mktsegment", "id % 9 as c_nationkey", "id as c_acctbal")
    spec = EVENT_STATS.with_(join="shuffle", scale=None)
    with settings(
        spark,
        spark__sql__autoBroadcastJoinThreshold="-1",
        spark__sql__adaptive__skewJoin__skewedPartitionThresholdInBytes="100000",
        spark__sql__adaptive__skewJoin__skewedPartitionFactor="2",
        spark__sql__adaptive__advisoryPartitionSizeInBytes="100000",
    ):
        unfolded = grouped_stats(facts, dim, spec)
        plan = plan_of(unfolded, run=True)
        folded = grouped_stats(facts, dim, spec.with_(fold_facts=True))
        assert sorted(map(tuple, unfolded.collect())) == sorted(map(tuple, folded.collect()))
    assert "isSkewJoin=true" in plan or "skewed" in plan


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
@pytest.mark.parametrize("name", ["enrich_avg_stats_shuffled", "repeated_keys_shuffled"])
def test_large_dimensions_are_not_broadcast_under_default_settings(spark, name, sf):
    from conformance import QUERIES

    df = QUERIES[name](spark, f"/root/testdata/{sf}")
    df.collect()
    plan = plan_of(df)
    final = plan[plan.index("Final Plan") : plan.index("Initial Plan")]
    assert "SortMergeJoin" in final and "BroadcastHashJoin" not in final


def test_a_large_table_is_not_broadcast_on_request(spark):
    with pytest.raises(ValueError, match="not broadcast"):
        enrich(table(spark, SF, "events"), customers(spark, SF), "user_id", join="broadcast", limit=1)


def test_a_dimension_that_takes_a_shuffle_is_worked_out_once(spark):
    from conformance import QUERIES

    df = QUERIES["grouped_stats_batch"](spark, SF)
    plan = plan_of(df)
    assert "customer.parquet" not in plan, "only its written copy is read"
    assert plan.count("events.parquet") == 1
    assert QUERIES["enrich_avg_stats"](spark, SF).inputFiles() and "customer.parquet" in plan_of(QUERIES["enrich_avg_stats"](spark, SF))


def test_tables_cut_by_a_flag_are_written_without_a_sort(spark, folder):
    from tributary.settings import BASE_SETTINGS

    spark.sql(
        f"create table flagged (id bigint, rejected boolean) using parquet partitioned by (rejected) location '{folder('t')}'"
    )
    insert = "explain insert overwrite flagged select id, id % 2 = 0 as rejected from range(100)"
    try:
        assert "Sort" in spark.sql(insert).first()[0]
        name = "spark.sql.maxConcurrentOutputFileWriters"
        with settings(spark, **{name.replace(".", "__"): BASE_SETTINGS[name]}):
            assert "Sort" not in spark.sql(insert).first()[0]
    finally:
        spark.sql("drop table flagged")
