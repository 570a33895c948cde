import json
import os
import time

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from tributary.contracts import ATHLETE_EVENT_RESULTS, AVERAGE_STATS
from tributary.operators import decode_rows, prepare_dimension
from tributary.plans import STREAM_STATS, replay_table, run_event_enrichment
from tributary.sinks import parquet_batches, topic_batches
from tributary.sources import FileTopic, read_topic, stream_topic
from tributary.streaming import dead_letters, deliver_dead_letters, enrich_batches, fan_out, freeze, wait

BIO = "athlete_id int, name string, sex string, height string, weight string, country_noc string"
BIO_ROWS = [(1, "a", "M", "180", "80", "X"), (2, "b", "F", "170", "60", "Y"), (3, "c", "F", "bad", "60", "Y")]
KEYS = ["sport", "medal", "sex", "country_noc"]


def bio(spark):
    return spark.createDataFrame(BIO_ROWS, BIO)


def message(athlete, medal=None, sport="row", country="E"):
    fields = {"athlete_id": athlete, "sport": sport, "country_noc": country, "medal": medal, "isTeamSport": "True"}
    return json.dumps({k: v for k, v in fields.items() if v is not None})


def put(path, name, lines):
    os.makedirs(path, exist_ok=True)
    with open(os.path.join(path, name), "w", encoding="utf-8") as file:
        file.write("\n".join(lines) + "\n")


def run(spark, topic, sinks, checkpoint, **options):
    query = run_event_enrichment(spark, topic, bio(spark), sinks, checkpoint=checkpoint, available_now=True, **options)
    assert wait(query, 120)
    return query


def stored(spark, path):
    rows = spark.read.parquet(path).select("batch_id", *KEYS, "avg_height").collect()
    return sorted(tuple(r) for r in rows)


def test_averages_are_per_batch(spark, folder):
    topic = FileTopic(folder("in"), {"maxFilesPerTrigger": "1"})
    out, progress = folder("out"), folder("progress")
    counts = []
    put(topic.path, "0.txt", [message(1), message(1, "nan"), message(3), message(9), "not json"])
    run(spark, topic, [parquet_batches(out)], progress, on_counts=counts.append)
    put(topic.path, "1.txt", [message(1), message(2, "gold")])
    run(spark, topic, [parquet_batches(out)], progress, on_counts=counts.append)
    put(topic.path, "2.txt", [message(9), "not json either"])
    run(spark, topic, [parquet_batches(out)], progress, on_counts=counts.append)
    assert stored(spark, out) == [
        (0, "row", "nan", "M", "E", 180.0),
        (1, "row", "gold", "F", "E", 170.0),
        (1, "row", "nan", "M", "E", 180.0),
    ]
    assert [(c.batch_id, c.rows, c.keyed) for c in counts] == [(0, 5, 4), (1, 2, 2), (2, 2, 1)]
    run(spark, topic, [parquet_batches(out)], progress, on_counts=counts.append)
    assert len(counts) == 3, "nothing new, no batch"


def test_many_files_make_many_batches(spark, folder):
    topic = FileTopic(folder("in"), {"maxFilesPerTrigger": "1"})
    for i in range(4):
        put(topic.path, f"{i}.txt", [message(1 + i % 2, sport=f"s{i}")])
    run(spark, topic, [parquet_batches(folder("out"))], folder("progress"))
    assert {(r[1], r[5]) for r in stored(spark, folder("out"))} == {("s0", 180.0), ("s1", 170.0), ("s2", 180.0), ("s3", 170.0)}
    assert len({r[0] for r in stored(spark, folder("out"))}) == 4


class Flaky:
    """A sink that fails on chosen batches, once each."""

    def __init__(self, *fail_on):
        self.left, self.seen = set(fail_on), []

    def __call__(self, df, batch_id):
        if batch_id in self.left:
            self.left.remove(batch_id)
            raise RuntimeError("not reachable")
        self.seen.append(batch_id)


def test_a_failed_batch_is_run_again(spark, folder):
    topic = FileTopic(folder("in"), {"maxFilesPerTrigger": "1"})
    put(topic.path, "0.txt", [message(1)])
    flaky = Flaky(0)
    sinks = [parquet_batches(folder("out")), flaky]
    with pytest.raises(StreamingQueryException):
        run(spark, topic, sinks, folder("progress"))
    run(spark, topic, sinks, folder("progress"))
    run(spark, topic, sinks, folder("progress"))
    assert flaky.seen == [0]
    assert stored(spark, folder("out")) == [(0, "row", "nan", "M", "E", 180.0)]


def test_skip_gives_a_batch_up(spark, folder):
    topic = FileTopic(folder("in"), {"maxFilesPerTrigger": "1"})
    put(topic.path, "0.txt", [message(1)])
    flaky = Flaky(0)
    run(spark, topic, [flaky, parquet_batches(folder("out"))], folder("progress"), on_error="skip")
    put(topic.path, "1.txt", [message(2)])
    run(spark, topic, [flaky, parquet_batches(folder("out"))], folder("progress"), on_error="skip")
    assert flaky.seen == [1]
    assert [r[0] for r in stored(spark, folder("out"))] == [1]


def test_both_sinks_get_the_same_rows_and_times(spark, folder):
    topic = FileTopic(folder("in"))
    put(topic.path, "0.txt", [message(1), message(2, "gold")])
    messages = FileTopic(folder("sent"))
    run(spark, topic, [parquet_batches(folder("out")), topic_batches(messages)], folder("progress"))
    sent = decode_rows(read_topic(spark, messages), AVERAGE_STATS.schema)
    table = spark.read.parquet(folder("out")).withColumn("timestamp", F.date_trunc("millisecond", "timestamp"))
    assert sorted(map(tuple, sent.collect())) == sorted(map(tuple, table.drop("query", "batch_id").collect()))
    assert sent.select("timestamp").distinct().count() == 1


def test_writing_a_batch_again_replaces_it(spark, folder):
    df = spark.range(3).withColumn("v", F.lit("x"))
    messages = FileTopic(folder("sent"))
    for _ in range(2):
        parquet_batches(folder("out"))(df, 4)
        topic_batches(messages)(df, 4)
    assert spark.read.parquet(folder("out")).count() == 3
    assert read_topic(spark, messages).count() == 3


def test_fan_out_releases_and_guards(spark):
    seen = []
    df = spark.range(3).withColumn("x", F.col("id") * 2)
    assert fan_out(df, [lambda d, b: seen.append((b, d.count()))], 7) and seen == [(7, 3)]
    assert not fan_out(df.filter("id > 9"), [lambda d, b: seen.append(b)], 8) and len(seen) == 1
    with pytest.raises(ZeroDivisionError):
        fan_out(df, [lambda d, b: 1 / 0], 9)
    assert not df.is_cached
    with pytest.raises(ValueError):
        fan_out(df, [], 1, on_error="other")


def test_the_dimension_is_frozen(spark, folder):
    source = folder("dimension")
    bio(spark).write.parquet(source)
    spec = STREAM_STATS
    kept = freeze(spark.read.parquet(source).drop("country_noc"), ["athlete_id"], spec, folder("copy"))
    frozen = kept.dimension
    before = frozen.rows.count()
    bio(spark).limit(1).write.mode("overwrite").parquet(source)
    frozen.rows.unpersist()
    assert frozen.rows.count() == before == 3
    kept.release()
    assert not os.path.exists(folder("copy"))


def test_the_frozen_copy_goes_when_the_stream_ends(spark, folder):
    topic = FileTopic(folder("in"))
    put(topic.path, "0.txt", [message(1)])
    run(spark, topic, [parquet_batches(folder("out"))], folder("progress"), frozen_path=folder("copy"))
    for _ in range(100):
        if not os.path.exists(folder("copy")):
            break
        time.sleep(0.1)
    assert not os.path.exists(folder("copy"))
    assert len(stored(spark, folder("out"))) == 1


def test_a_stream_folds_facts_of_a_large_dimension(spark, folder):
    topic = FileTopic(folder("in"))
    put(topic.path, "0.txt", [message(1)])
    spec = STREAM_STATS.with_(broadcast_limit=1, fold_facts=False)
    with pytest.raises(ValueError, match="hot key"):
        run(spark, topic, [parquet_batches(folder("out"))], folder("progress"), spec=spec)


def test_streams_leave_each_others_batches_alone(spark, folder):
    for i, sport in enumerate(("row", "swim")):
        topic = FileTopic(folder(f"in{i}"))
        put(topic.path, "0.txt", [message(1, sport=sport)])
        run(spark, topic, [parquet_batches(folder("out"))], folder(f"progress{i}"))
    assert [(r[0], r[1]) for r in stored(spark, folder("out"))] == [(0, "row"), (0, "swim")]


def test_a_replayed_batch_reaches_a_reader_of_the_topic_once(spark, folder):
    topic, sent = FileTopic(folder("in")), FileTopic(folder("sent"))
    put(topic.path, "0.txt", [message(1), message(2)])
    failures = iter([RuntimeError("gone")])

    def fails_once(df, batch_id):
        for error in failures:
            raise error

    sinks = [topic_batches(sent), fails_once]
    with pytest.raises(StreamingQueryException):
        run(spark, topic, sinks, folder("progress"))

    def read_on():
        reader = stream_topic(spark, sent).writeStream.format("parquet").option("checkpointLocation", folder("reader"))
        assert wait(reader.option("path", folder("read")).trigger(availableNow=True).start(), 60)

    read_on()
    run(spark, topic, sinks, folder("progress"))
    read_on()
    assert spark.read.parquet(folder("read")).count() == read_topic(spark, sent).count() == 2


def test_injected_time(spark, folder):
    topic = FileTopic(folder("in"))
    put(topic.path, "0.txt", [message(1)])
    stamp = F.lit("2024-05-06 07:08:09").cast("timestamp")
    run(spark, topic, [parquet_batches(folder("out"))], folder("progress"), run_ts=lambda batch_id: stamp)
    assert str(spark.read.parquet(folder("out")).first().timestamp) == "2024-05-06 07:08:09"


def test_replaying_a_table_sends_it_again(spark, folder):
    rows = [("e", 1, "X", "row", "ev", 5, "a", 1, "1", None, "True")]
    df = spark.createDataFrame(rows, ATHLETE_EVENT_RESULTS.schema)
    topic = FileTopic(folder("topic"))
    replay_table(df, topic)
    replay_table(df, topic)
    back = decode_rows(read_topic(spark, topic), ATHLETE_EVENT_RESULTS.schema)
    assert [tuple(r) for r in back.collect()] == rows * 2


def test_interval_trigger_and_wait(spark, folder):
    topic = FileTopic(folder("in"))
    put(topic.path, "0.txt", [message(1)])
    query = run_event_enrichment(
        spark, topic, bio(spark), [parquet_batches(folder("out"))], checkpoint=folder("progress"), every_seconds=1, name="timed"
    )
    try:
        assert not wait(query, 0.1)
        query.processAllAvailable()
        assert query.name == "timed"
        assert len(stored(spark, folder("out"))) == 1
    finally:
        query.stop()
    assert wait(query)


def test_useless_messages_are_set_aside(spark, folder):
    topic = FileTopic(folder("in"))
    bad = ["not json", "{}", json.dumps({"athlete_id": "x", "sport": "row"})]
    put(topic.path, "0.txt", [message(1), *bad, message(9)])
    counts = []
    run(
        spark,
        topic,
        [parquet_batches(folder("out"))],
        folder("progress"),
        rejects=parquet_batches(folder("aside")),
        on_counts=counts.append,
    )
    assert sorted(r.value for r in spark.read.parquet(folder("aside")).collect()) == sorted(bad)
    assert stored(spark, folder("out")) == [(0, "row", "nan", "M", "E", 180.0)]
    assert (counts[0].rows, counts[0].keyed) == (5, 2)


@pytest.mark.parametrize("join", ["broadcast", "shuffle"])
@pytest.mark.parametrize("athletes, keyed", [([], 0), ([None, None], 0), ([9], 1)])
def test_batches_without_a_result_are_counted_not_written(spark, join, athletes, keyed):
    spec = STREAM_STATS.with_(join=join)
    schema = "athlete_id int, sport string, medal string, country_noc string"
    batch = spark.createDataFrame([(a, "row", None, "E") for a in athletes], schema)
    for people in (bio(spark), bio(spark).filter("athlete_id < 0")):
        counts, written = [], []
        dimension = prepare_dimension(people, batch.columns, spec)
        handle = enrich_batches(dimension, spec, [lambda df, b: written.append(b)], on_counts=counts.append)
        handle(batch, 5)
        assert not written and [(c.batch_id, c.rows, c.keyed) for c in counts] == [(5, len(athletes), keyed)]


def test_a_table_that_cannot_be_computed_is_never_skipped(spark):
    df = spark.range(3).select(F.raise_error(F.lit("no such luck")).alias("x"))
    with pytest.raises(Exception, match="no such luck"):
        fan_out(df, [], 1, on_error="skip")


def put_in_order(path, *batches):
    """A file for each batch, later ones changed later, as batches are taken in this order."""
    for number, lines in enumerate(batches):
        put(path, f"{number}.txt", lines)
        os.utime(os.path.join(path, f"{number}.txt"), (1_000_000 + number, 1_000_000 + number))


class Appends:
    """A sink that keeps all it gets, and fails when told to."""

    def __init__(self, name, *failing):
        self.name, self.failing, self.got = name, list(failing), []

    def __call__(self, df, batch_id):
        if batch_id in self.failing:
            self.failing.remove(batch_id)
            raise RuntimeError(f"{self.name} not reachable")
        self.got.append((batch_id, sorted(r["sport"] for r in df.collect())))


def test_a_sink_that_has_a_batch_does_not_get_it_again(spark, folder):
    topic = FileTopic(folder("in"), {"maxFilesPerTrigger": "1"})
    put_in_order(topic.path, [message(1)], [message(2, sport="run")])
    first, second, third = Appends("a"), Appends("b", 1, 1), Appends("c")
    for _ in range(2):
        with pytest.raises(StreamingQueryException):
            run(spark, topic, [first, second, third], folder("progress"))
    run(spark, topic, [third, second, first], folder("progress"))  # in another order
    put(topic.path, "2.txt", [message(1)])
    run(spark, topic, [first, second, third], folder("progress"))
    assert first.got == second.got == third.got == [(0, ["row"]), (1, ["run"]), (2, ["row"])]
    with pytest.raises(ValueError, match="two sinks"):
        fan_out(spark.range(1), [parquet_batches(folder("x")), parquet_batches(folder("x") + "/")], 0)


def test_a_second_stream_has_a_ledger_of_its_own(spark, folder):
    topic = FileTopic(folder("in"))
    put(topic.path, "0.txt", [message(1)])
    sink = Appends("a")
    for progress in ("one", "two"):
        run(spark, topic, [sink], folder(progress))
    assert sink.got == [(0, ["row"])] * 2


def test_missed_batches_are_kept_and_delivered_once(spark, folder):
    topic = FileTopic(folder("in"), {"maxFilesPerTrigger": "1"})
    put_in_order(topic.path, *([message(1, sport=sport)] for sport in ("row", "run", "swim")))
    first, second, third = Appends("a"), Appends("b", 0, 2), parquet_batches(folder("out"))
    run(spark, topic, [first, second, third], folder("progress"), on_error="skip", dead_letters=folder("dead"))
    assert [b for b, _ in first.got] == [0, 1, 2] and [b for b, _ in second.got] == [1]
    assert [r[0] for r in stored(spark, folder("out"))] == [1]
    letters = dead_letters(spark, folder("dead"))
    assert [(x.batch_id, x.sink.split()[0], x.error) for x in letters] == [(b, s, "b not reachable") for b in (0, 2) for s in ("b", "parquet")]
    broken = Appends("b", 2)
    with pytest.raises(RuntimeError):
        deliver_dead_letters(spark, folder("dead"), [broken])
    assert broken.got == [(0, ["row"])]
    assert len(deliver_dead_letters(spark, folder("dead"), [second, third])) == 3
    assert second.got == [(1, ["run"]), (2, ["swim"])]
    assert [r[:2] for r in stored(spark, folder("out"))] == [(0, "row"), (1, "run"), (2, "swim")]
    assert deliver_dead_letters(spark, folder("dead"), [second, third]) == [] == dead_letters(spark, folder("nowhere"))


def test_a_checkpoint_keeps_to_its_rules(spark, folder):
    topic = FileTopic(folder("in"))
    put(topic.path, "0.txt", [message(1)])
    sink = Appends("a")
    run(spark, topic, [sink], folder("progress"))
    with pytest.raises(ValueError, match="other rules"):
        run(spark, topic, [sink], folder("progress"), spec=STREAM_STATS.with_(measure_policy="nan_is_null"))
    put(topic.path, "1.txt", [message(2)])
    run(spark, topic, [sink], folder("progress"), spec=STREAM_STATS.with_(broadcast_limit=0))
    assert [b for b, _ in sink.got] == [0, 1]
