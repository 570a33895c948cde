"""Tables that are replaced in one step, and counts that do not depend on how often a task was run."""

import os
import subprocess
import sys

import pytest
from pyspark.sql import functions as F

from tributary.operators import StatsSpec, grouped_stats
from tributary.sinks import Buckets, overwrite_zone, tables
from tributary.sources import read_zone
from tributary.sources.lake import snapshot_path

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def test_a_write_that_ends_half_way_leaves_the_table_as_it_was(spark, folder):
    overwrite_zone(spark.range(10).repartition(2), folder("zone"), "t")
    half = spark.range(0, 100, 1, 4).withColumn("id", F.when(F.col("id") == 90, F.raise_error(F.lit("lost"))).otherwise(F.col("id")))
    before = read_zone(spark, folder("zone"), "t")
    with pytest.raises(Exception, match="lost"):
        overwrite_zone(half.select(F.col("id").cast("long")), folder("zone"), "t")
    assert read_zone(spark, folder("zone"), "t").count() == before.count() == 10
    assert len(os.listdir(folder("zone") + "/t/_snapshots")) == 1


def test_a_reader_keeps_what_it_reads(spark, folder):
    overwrite_zone(spark.range(5), folder("zone"), "t")
    old = read_zone(spark, folder("zone"), "t")
    overwrite_zone(spark.range(7), folder("zone"), "t")
    assert old.count() == 5 and read_zone(spark, folder("zone"), "t").count() == 7


def test_a_table_can_be_made_from_itself(spark, folder):
    overwrite_zone(spark.range(4), folder("zone"), "t")
    for n in (8, 16):
        rows = read_zone(spark, folder("zone"), "t")
        overwrite_zone(rows.unionAll(rows), folder("zone"), "t")
        assert read_zone(spark, folder("zone"), "t").count() == n


def test_old_snapshots_go(spark, folder):
    paths = [overwrite_zone(spark.range(n), folder("zone"), "t") for n in range(6)]
    assert [os.path.exists(path) for path in paths] == [False] * 3 + [True] * 3
    assert snapshot_path(spark, folder("zone"), "t") == paths[-1]
    assert len([n for n in os.listdir(folder("zone") + "/t/_manifest") if n.isdigit()]) == tables.KEPT


def test_of_two_writers_at_a_time_the_later_one_fails(spark, folder, monkeypatch):
    overwrite_zone(spark.range(1), folder("zone"), "t")
    real = tables.versions
    seen = []

    def versions(session, path):
        known = real(session, path)
        if not seen:
            seen.append(1)
            overwrite_zone(spark.range(2), folder("zone"), "t")
        return known

    monkeypatch.setattr(tables, "versions", versions)
    with pytest.raises(RuntimeError, match="someone else"):
        overwrite_zone(spark.range(3), folder("zone"), "t")
    assert read_zone(spark, folder("zone"), "t").count() == 2


def test_a_plain_folder_is_read_as_it_is(spark, folder):
    spark.range(3).write.parquet(folder("zone") + "/t")
    assert read_zone(spark, folder("zone"), "t").count() == 3


RETRIED = """
import os, sys
sys.path.insert(0, sys.argv[1])
from pyspark.sql import SparkSession
from pyspark.sql import functions as F
spark = SparkSession.builder.master("local[2,4]").config("spark.ui.enabled", "false").config("spark.driver.host", "127.0.0.1").getOrCreate()
spark.sparkContext.setLogLevel("OFF")
from tributary.operators import rule_castable
from tributary.plans import copy_tables
from tributary.sinks import overwrite_zone

def fails_once(frames):
    from pyspark import TaskContext
    for frame in frames:
        yield frame
    if TaskContext.get().attemptNumber() == 0:
        raise RuntimeError("lost")

rows = spark.range(0, 100, 1, 4).selectExpr("id", "if(id % 4 = 0, 'no', '1') as v").mapInPandas(fails_once, "id long, v string")
out = copy_tables(spark, {"t": [rule_castable("v")]}, lambda name: rows, lambda df, name: overwrite_zone(df, sys.argv[2] + "/to", name), staging=sys.argv[2] + "/staged")
print("COUNTS", out["t"].rows, out["t"].rejected)
"""


def test_rows_of_tasks_that_are_run_again_count_once(tmp_path):
    env = {name: value for name, value in os.environ.items() if not name.startswith("SPARK_")}
    done = subprocess.run([sys.executable, "-c", RETRIED, ROOT, str(tmp_path)], capture_output=True, text=True, timeout=200, env=env)
    assert "COUNTS 100 25" in done.stdout, done.stderr[-2000:]


def test_tables_laid_out_by_key_are_joined_without_a_shuffle(spark, folder):
    buckets = Buckets("k", 4, "laid_out")
    facts = spark.range(2000).selectExpr("id % 50 as k", "id % 3 as g", "id as v").union(spark.sql("select cast(null as bigint), 1L, 2L"))
    people = spark.range(50).selectExpr("id as k", "id % 2 as h", "id as w")
    for name, rows in (("facts", facts), ("people", people)):
        overwrite_zone(rows, folder("silver"), name, buckets=buckets)
    assert read_zone(spark, folder("silver"), "facts").count() == 2001
    facts, people = spark.table("laid_out_facts"), spark.table("laid_out_people")
    spec = StatsSpec(on=("k",), group_by=("g", "h"), measures={"v": "v", "w": "w"}, stamp=None, broadcast_limit=0)
    for fold in (True, False):
        stats = grouped_stats(facts, people, spec.with_(fold_facts=fold))
        plan = stats._jdf.queryExecution().executedPlan().toString().split("Join")
        assert len(plan) == 2 and "Exchange" not in plan[1] and "Bucketed: true" in plan[1]
        assert {(r["g"], r["h"]): r["v"] for r in stats.collect()} == {
            (g, h): sum(x) / len(x) for g in range(3) for h in range(2) for x in [[i for i in range(2000) if i % 3 == g and i % 50 % 2 == h]]
        }
    spark.sql("drop table laid_out_facts")
    spark.sql("drop table laid_out_people")
