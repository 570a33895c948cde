import itertools
import math
import random

import pytest
from pyspark.sql import functions as F
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tributary.functions.numbers import NAN_IS_NULL
from tributary.operators import StatsSpec, enrich, fits_broadcast, grouped_stats, measured_size
from tributary.plans import BATCH_STATS, STREAM_STATS, usable_dimension

BIO = "athlete_id int, sex string, height string, weight string, country_noc string"
RESULTS = "athlete_id int, sport string, medal string, country_noc string"

BIO_ROWS = [
    (1, "M", "180", "80", "bio1"),
    (2, "F", "170", "60", "bio2"),
    (2, "F", "170", "60", "bio2"),
    (3, "F", "nan", "55", "bio2"),
    (4, "M", "77-80", "90", "bio1"),
    (5, "M", None, "70", "bio1"),
    (None, "M", "1", "1", "bio1"),
]
RESULT_ROWS = [
    (1, "row", None, "ev1"),
    (1, "row", "nan", "ev1"),
    (2, "row", "gold", "ev1"),
    (3, "row", "gold", "ev1"),
    (4, "row", None, "ev2"),
    (5, "run", "gold", "ev2"),
    (9, "run", "gold", "ev2"),
    (None, "run", "gold", "ev2"),
]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


@pytest.mark.parametrize("join", ["auto", "broadcast", "shuffle"])
@pytest.mark.parametrize("partitions", [1, 7])
def test_batch_rules(spark, join, partitions):
    bio = spark.createDataFrame(BIO_ROWS, BIO).repartition(partitions)
    results = spark.createDataFrame(RESULT_ROWS, RESULTS).repartition(partitions)
    spec = BATCH_STATS.with_(stamp=None, join=join, measure_policy=NAN_IS_NULL)
    assert rows(grouped_stats(results, bio, spec)) == sorted(
        [
            ("row", "nan", "M", "bio1", 180.0, 85.0),
            ("row", "nan", "M", "bio1", 180.0, 80.0),
            ("row", "gold", "F", "bio2", 170.0, (60.0 * 2 + 55.0) / 3),
            ("run", "gold", "M", "bio1", None, 70.0),
        ],
        key=repr,
    )


@pytest.mark.parametrize("join", ["auto", "broadcast", "shuffle"])
@pytest.mark.parametrize("partitions", [1, 7])
def test_stream_rules(spark, join, partitions):
    bio = usable_dimension(spark.createDataFrame(BIO_ROWS, BIO).repartition(partitions))
    results = spark.createDataFrame(RESULT_ROWS, RESULTS).repartition(partitions)
    spec = STREAM_STATS.with_(stamp=None, join=join)
    got = rows(grouped_stats(results, bio, spec))
    gold, medal = got
    assert medal == ("row", "nan", "M", "ev1", 180.0, 80.0)
    assert gold[:4] == ("row", "gold", "F", "ev1") and math.isnan(gold[4]) and gold[5] == 175.0 / 3


def test_stamp_is_injected_or_now(spark):
    bio, results = spark.createDataFrame(BIO_ROWS, BIO), spark.createDataFrame(RESULT_ROWS, RESULTS)
    fixed = grouped_stats(results, bio, BATCH_STATS, F.lit("2024-01-02 03:04:05").cast("timestamp"))
    assert fixed.columns == ["sport", "medal", "sex", "country_noc", "avg_height", "avg_weight", "timestamp"]
    assert {str(r.timestamp) for r in fixed.collect()} == {"2024-01-02 03:04:05"}
    assert grouped_stats(results, bio, BATCH_STATS).schema["timestamp"].dataType.simpleString() == "timestamp"


def test_owner_of_a_shared_column(spark):
    bio, results = spark.createDataFrame(BIO_ROWS, BIO), spark.createDataFrame(RESULT_ROWS, RESULTS)
    assert {r.country_noc for r in enrich(results, bio, "athlete_id").collect()} == {"bio1", "bio2"}
    kept = enrich(results, bio, "athlete_id", prefer="fact")
    assert {r.country_noc for r in kept.collect()} == {"ev1", "ev2"}
    with pytest.raises(ValueError):
        enrich(results, bio, "athlete_id", prefer="neither")


def test_enrich_drops_and_repeats_rows(spark):
    bio, results = spark.createDataFrame(BIO_ROWS, BIO), spark.createDataFrame(RESULT_ROWS, RESULTS)
    for join in ("broadcast", "shuffle"):
        assert sorted(r.athlete_id for r in enrich(results, bio, "athlete_id", join=join).collect()) == [1, 1, 2, 2, 3, 4, 5]


def brute_force(facts, dimension):
    groups = {}
    for (key, sport, value), (other, sex, height) in itertools.product(facts, dimension):
        if key is not None and key == other:
            groups.setdefault((sport, sex), []).append((value, height))
    mean = lambda values: sum(values) / len(values) if values else None
    return sorted(
        (
            (*group, mean([v for v, _ in pairs if v is not None]), mean([h for _, h in pairs if h is not None]))
            for group, pairs in groups.items()
        ),
        key=repr,
    )


KEY = st.one_of(st.none(), st.integers(0, 3))
VALUE = st.one_of(st.none(), st.integers(-8, 8).map(lambda n: n / 2))
FACT = st.tuples(KEY, st.sampled_from(["row", "run", None]), VALUE)
DIM = st.tuples(KEY, st.sampled_from(["M", "F", None]), VALUE)


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(FACT, max_size=25), st.lists(DIM, max_size=12))
def test_agrees_with_brute_force(spark, facts, dimension):
    left = spark.createDataFrame(facts, "k int, sport string, v double")
    right = spark.createDataFrame(dimension, "k int, sex string, h double")
    spec = StatsSpec(("k",), ("sport", "sex"), {"avg_v": "v", "avg_h": "h"}, stamp=None)
    want = brute_force(facts, dimension)
    for join, unique, fold in itertools.product(("broadcast", "shuffle"), (False, True), (None, False, True)):
        variant = spec.with_(join=join, unique_dimension=unique, fold_facts=fold)
        got = rows(grouped_stats(left, right, variant))
        assert [g[:2] for g in got] == [w[:2] for w in want]
        for g, w in zip(got, want):
            assert g[2:] == pytest.approx(w[2:])


def test_a_key_with_a_third_of_both_sides(spark):
    """A hot key on both sides: the pairs it makes are counted, never built."""
    facts = spark.range(0, 30_000, 1, 4).selectExpr(
        "if(id % 3 = 0, 0, id) as k", "concat('s', id % 2) as sport", "cast(id % 10 as double) as v"
    )
    dim = spark.range(0, 30_000, 1, 4).selectExpr(
        "if(id % 3 = 0, 0, id) as k", "if(id % 2 = 0, 'M', 'F') as sex", "cast(id % 7 as double) as h"
    )
    spec = StatsSpec(("k",), ("sport", "sex"), {"avg_v": "v", "avg_h": "h"}, stamp=None, scale=2, measure_policy=NAN_IS_NULL)
    want = None
    for join in ("shuffle", "broadcast"):
        got = rows(grouped_stats(facts, dim, spec.with_(join=join)))
        assert want is None or got == want
        want = got
    # 10,000 x 10,000 pairs of the hot key, worked out by hand from the counts.
    k0f = {"s0": [i % 10 for i in range(0, 30_000, 3) if i % 2 == 0], "s1": [i % 10 for i in range(0, 30_000, 3) if i % 2]}
    k0d = {"M": [i % 7 for i in range(0, 30_000, 3) if i % 2 == 0], "F": [i % 7 for i in range(0, 30_000, 3) if i % 2]}
    others = [i for i in range(30_000) if i % 3]
    for sport, sex, avg_v, avg_h in want:
        pairs = len(k0f[sport]) * len(k0d[sex])
        total_v = sum(k0f[sport]) * len(k0d[sex])
        total_h = sum(k0d[sex]) * len(k0f[sport])
        for i in others:
            if sport == f"s{i % 2}" and sex == ("M" if i % 2 == 0 else "F"):
                pairs, total_v, total_h = pairs + 1, total_v + i % 10, total_h + i % 7
        assert avg_v == pytest.approx(total_v / pairs) and avg_h == pytest.approx(total_h / pairs)
    assert len(want) == 4


def test_measured_size_decides(spark):
    df = spark.createDataFrame([("x" * 1000,)] * 50, "s string")
    size = measured_size(df)
    assert size.rows == 50 and 50_000 < size.bytes < 60_000
    assert fits_broadcast(df, limit=60_000) and not fits_broadcast(df, limit=50_000)
    assert fits_broadcast(df, "broadcast", 60_000) and not fits_broadcast(df, "shuffle", 10**9)
    with pytest.raises(ValueError, match="not broadcast"):
        fits_broadcast(df, "broadcast", 50_000)
    with pytest.raises(ValueError):
        fits_broadcast(df, "other")
    nested = spark.createDataFrame([([1, 2, 3], {"a": "b"})], "a array<int>, m map<string,string>")
    assert measured_size(nested).bytes > 0
    assert measured_size(spark.range(0)).rows == 0


def test_bad_fill_time():
    with pytest.raises(ValueError):
        BATCH_STATS.with_(fill_when="never")


def test_averages_do_not_depend_on_partitions(spark):
    random.seed(1)
    facts = spark.createDataFrame([(i % 5, "s", random.random() * 100) for i in range(2000)], "k int, sport string, v double")
    dim = spark.createDataFrame([(i, "M", random.random()) for i in range(5)], "k int, sex string, h double")
    spec = StatsSpec(("k",), ("sport", "sex"), {"v": "v", "h": "h"}, stamp=None, scale=4, measure_policy=NAN_IS_NULL)
    results = {
        tuple(rows(grouped_stats(facts.repartition(n), dim.repartition(n), spec.with_(join=join))))
        for n in (1, 7)
        for join in ("broadcast", "shuffle")
    }
    assert len(results) == 1


def test_exact_sums_keep_six_places_through_weights(spark):
    facts = spark.range(0, 3000, 1, 3).selectExpr("id % 2 as k", "'s' as sport", "id % 7 * 0.000001D as v")
    dim = spark.range(0, 3000, 1, 3).selectExpr("id % 2 as k", "'M' as sex")
    spec = StatsSpec(("k",), ("sport", "sex"), {"v": "v"}, stamp=None, scale=6, measure_policy=NAN_IS_NULL)
    want = sum(i % 7 for i in range(3000)) / 3000 / 1_000_000
    for join in ("broadcast", "shuffle"):
        ((_, _, got),) = rows(grouped_stats(facts, dim, spec.with_(join=join)))
        assert got == pytest.approx(want, rel=1e-15)


def test_averages_with_a_dimension_too_large_for_the_broadcast_asked_for(spark):
    facts = spark.createDataFrame([(i % 7, "row", float(i)) for i in range(100)], "k int, sport string, v double")
    dim = spark.createDataFrame([(i % 5, "M", float(i)) for i in range(20)], "k int, sex string, h double")
    spec = StatsSpec(("k",), ("sport", "sex"), {"v": "v", "h": "h"}, stamp=None, join="broadcast")
    small, beyond = grouped_stats(facts, dim, spec), grouped_stats(facts, dim, spec.with_(broadcast_limit=100))
    assert rows(small) == rows(beyond)
    plans = [df._jdf.queryExecution().sparkPlan().toString() for df in (small, beyond)]
    assert ["Broadcast" in plan for plan in plans] == [True, False] and "SortMergeJoin" in plans[1]


def test_facts_of_very_many_groups_are_not_folded(spark, monkeypatch):
    """A task's map of the groups is bounded, whatever the size of the table."""
    from tributary.operators import stats

    facts = spark.range(0, 1000, 1, 2).selectExpr("id % 100 as k", "'s' as sport", "cast(id as double) as v")
    dim = spark.range(100).selectExpr("id as k", "if(id % 2 = 0, 'M', 'F') as sex", "cast(id as double) as h")
    spec = StatsSpec(("k",), ("sport", "sex"), {"v": "v", "h": "h"}, stamp=None, join="shuffle")
    assert stats.folding_pays(facts, ["k", "sport"])
    folded = rows(grouped_stats(facts, dim, spec))
    monkeypatch.setattr(stats, "MOST_GROUPS", 50)
    assert not stats.folding_pays(facts, ["k", "sport"])
    assert rows(grouped_stats(facts, dim, spec)) == folded
