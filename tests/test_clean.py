import math

import pytest
from pyspark.sql import functions as F

from tributary.functions.numbers import KEEP_NAN, NAN_IS_NULL, measure
from tributary.operators import (
    distinct_rows,
    drop_columns,
    fill_missing,
    mean_by,
    normalize_text,
    require_castable,
    require_not_null,
)

MEASURES = ["180", "170.5", "nan", None, "", " 165 ", "77-80"]


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def test_castable_keeps_the_text(spark):
    df = spark.createDataFrame([(m,) for m in MEASURES], "m string")
    assert sorted(r.m for r in require_castable(df, "m").collect()) == [" 165 ", "170.5", "180", "nan"]


def test_not_null_wants_all_columns(spark):
    df = spark.createDataFrame([(1, "a"), (2, None), (None, "c")], "k int, v string")
    assert rows(require_not_null(df, "k", "v")) == [(1, "a")]


@pytest.mark.parametrize(
    "policy, want", [(KEEP_NAN, [165.0, 170.5, 180.0, "nan"]), (NAN_IS_NULL, [165.0, 170.5, 180.0])]
)
def test_measure_policies(spark, policy, want):
    df = spark.createDataFrame([(m,) for m in MEASURES], "m string")
    got = [r[0] for r in df.select(measure("m", policy)).collect() if r[0] is not None]
    assert sorted(("nan" if math.isnan(v) else v for v in got), key=str) == want


def test_measure_refuses_unknown_and_contradicting_choices():
    with pytest.raises(ValueError):
        measure("m", "other")
    with pytest.raises(ValueError):
        measure("m", KEEP_NAN, scale=2)
    with pytest.raises(ValueError):
        measure("m", NAN_IS_NULL, scale=7)


def test_mean_of_text(spark):
    data = [("a", "180"), ("a", "nan"), ("b", None), ("b", ""), (None, "1"), (None, "2")]
    df = spark.createDataFrame(data, "g string, m string")
    assert rows(mean_by(df, ["g"], {"m": "m"}, policy=NAN_IS_NULL)) == [("a", 180.0), ("b", None), (None, 1.5)]
    assert rows(mean_by(df, ["g"], {"m": "m"}, policy=NAN_IS_NULL, scale=1)) == [("a", 180.0), ("b", None), (None, 1.5)]
    kept = {r.g: r.m for r in mean_by(df, ["g"], {"m": "m"}).collect()}
    assert math.isnan(kept["a"]) and kept["b"] is None and kept[None] == 1.5


def test_fill_before_and_after_grouping(spark):
    df = spark.createDataFrame([(None, 1.0), ("nan", 3.0), ("gold", 5.0)], "medal string, v double")
    missing = {"medal": "nan", "absent": "x"}
    before = mean_by(fill_missing(df, missing), ["medal"], {"v": "v"})
    after = fill_missing(mean_by(df, ["medal"], {"v": "v"}), missing)
    assert rows(before) == [("gold", 5.0), ("nan", 2.0)]
    assert rows(after) == [("gold", 5.0), ("nan", 1.0), ("nan", 3.0)]


def test_normalize_touches_text_only_and_trims_spaces_only(spark):
    df = spark.createDataFrame([("  AbC ", 1), ("\t A \n", 2), ("İÉ", 3), (None, 4)], "`a.b` string, n int")
    out = normalize_text(df)
    assert out.schema == df.schema
    assert [tuple(r) for r in out.orderBy("n").collect()] == [("abc", 1), ("\t a \n", 2), ("i̇é", 3), (None, 4)]


def test_distinct_after_normalizing(spark):
    nan = float("nan")
    data = [(" A", 0.0), ("a ", -0.0), ("b", nan), ("B", nan), (None, None), (None, None)]
    df = spark.createDataFrame(data, "s string, v double")
    assert distinct_rows(normalize_text(df)).count() == 3


def test_one_row_repeated_is_shuffled_once_per_task(spark):
    """However many copies there are, no task gets them all."""
    df = spark.range(0, 40_000, 1, 4).select(
        F.when(F.col("id") % 3 == 0, F.lit("same")).otherwise(F.col("id").cast("string")).alias("s")
    )
    plan = distinct_rows(df)._jdf.queryExecution().executedPlan().toString()
    exchange = plan.index("Exchange hashpartitioning")
    assert "HashAggregate" in plan[exchange:], "copies are dropped before the shuffle as well"
    assert distinct_rows(df).count() == 40_000 - 13_334 + 1


def test_drop_ignores_absent_columns(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert drop_columns(df, "b", "zzz").columns == ["a"]


def test_exact_averages_of_large_numbers(spark):
    df = spark.createDataFrame([("99999999999999999",), ("1",), ("0.004",)], "m string")
    got = mean_by(df, [], {"m": "m"}, policy=NAN_IS_NULL, scale=2, counts={"n": "m"}).first()
    assert got == (1e17 / 3, 3)
    for large in ("1" + "0" * 26, "inf"):
        one = spark.createDataFrame([(large,), ("1",)], "m string")
        with pytest.raises(Exception, match="no exact average"):
            mean_by(one, [], {"m": "m"}, policy=NAN_IS_NULL, scale=2).collect()
