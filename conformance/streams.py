"""Topics and micro-batches. Whole tables go through a topic of files and a stream over it."""

from __future__ import annotations

from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from conformance.batch import EVENT_STATS, EVENT_STATS_SQL, customers
from conformance.registry import query, table
from conformance.shapes import STREAM_STATS_SQL, bio, exact_avg, results
from tributary.contracts import AVERAGE_STATS, Contract
from tributary.functions.numbers import KEEP_NAN, NAN_IS_NULL
from tributary.operators import decode_rows
from tributary.plans import STREAM_STATS, replay_table, run_event_enrichment
from tributary.scratch import scratch_path
from tributary.sinks import parquet_batches, topic_batches
from tributary.sources import FileTopic, read_topic, stream_topic
from tributary.streaming import deliver_dead_letters, start_enrichment, wait

EVENT = StructType(
    [
        StructField("event_id", LongType()),
        StructField("user_id", LongType()),
        StructField("event_type", StringType()),
        StructField("value", DoubleType()),
    ]
)


def _topic_of(spark, df):
    topic = FileTopic(scratch_path(spark, "topic"))
    replay_table(df, topic)
    return topic


def _event_topic(spark, sf_dir):
    return _topic_of(spark, table(spark, sf_dir, "events").select(*EVENT.names))


def _run(spark, events, dimension, spec, sinks, checkpoint=None, **options):
    checkpoint = checkpoint or scratch_path(spark, "progress")
    wait(start_enrichment(events, dimension, spec, sinks, checkpoint=checkpoint, available_now=True, **options))


@query("topic_replay", "select event_id, user_id, event_type, value from events")
def topic_replay(spark, sf_dir):
    return decode_rows(read_topic(spark, _event_topic(spark, sf_dir)), EVENT)


@query("stream_enrich_avg", EVENT_STATS_SQL)
def stream_enrich_avg(spark, sf_dir):
    """A stream over the event table itself."""
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    out = scratch_path(spark, "stats")
    _run(spark, events, customers(spark, sf_dir), EVENT_STATS, [parquet_batches(out)])
    return spark.read.parquet(out).drop("query", "batch_id")


@query("stream_json_stats", STREAM_STATS_SQL)
def stream_json_stats(spark, sf_dir):
    """The whole streaming job on the stand-ins: table to topic, topic to averages."""
    topic = _topic_of(spark, results(spark, sf_dir))
    out = scratch_path(spark, "stats")
    wait(
        run_event_enrichment(
            spark,
            topic,
            bio(spark, sf_dir),
            [parquet_batches(out)],
            checkpoint=scratch_path(spark, "progress"),
            spec=STREAM_STATS.with_(measure_policy=NAN_IS_NULL, scale=2),
            available_now=True,
        )
    )
    return spark.read.parquet(out).drop("query", "batch_id", "timestamp")


@query(
    "stream_fanout",
    f"""
    select sport, medal, sex, country_noc, avg_height, avg_weight, true as same_time
    from ({STREAM_STATS_SQL})
    """,
)
def stream_fanout(spark, sf_dir):
    """A table and a topic written from one batch hold the same rows and time stamps."""
    topic = _topic_of(spark, results(spark, sf_dir))
    out, messages = scratch_path(spark, "stats"), FileTopic(scratch_path(spark, "stats-topic"))
    wait(
        run_event_enrichment(
            spark,
            topic,
            bio(spark, sf_dir),
            [parquet_batches(out), topic_batches(messages)],
            checkpoint=scratch_path(spark, "progress"),
            spec=STREAM_STATS.with_(measure_policy=NAN_IS_NULL, scale=2),
            available_now=True,
        )
    )
    keys = ["sport", "medal", "sex", "country_noc"]
    sent = decode_rows(read_topic(spark, messages), AVERAGE_STATS.schema)
    stored = spark.read.parquet(out).select(*keys, F.col("timestamp").alias("stored_at"))
    # A message carries milliseconds.
    same = F.col("timestamp") == F.date_trunc("millisecond", "stored_at")
    return sent.join(stored, keys).select(*keys, "avg_height", "avg_weight", same.alias("same_time"))


@query("stream_replay", EVENT_STATS_SQL)
def stream_replay(spark, sf_dir):
    """A sink fails once; on restart the batch runs again and nothing is lost or doubled."""
    events = decode_rows(stream_topic(spark, _event_topic(spark, sf_dir)), EVENT)
    out, progress = scratch_path(spark, "stats"), scratch_path(spark, "progress")
    failures = iter([RuntimeError("sink not reachable")])

    def fails_once(df, batch_id):
        for error in failures:
            raise error

    sinks = [parquet_batches(out), fails_once]
    try:
        _run(spark, events, customers(spark, sf_dir), EVENT_STATS, sinks, progress)
    except StreamingQueryException:
        _run(spark, events, customers(spark, sf_dir), EVENT_STATS, sinks, progress)
    return spark.read.parquet(out).drop("query", "batch_id")


class _AppendsOnly:
    """A sink that cannot take a batch back, like a database table; the first times it is called it fails."""

    def __init__(self, path, failures=0):
        self.path, self.failures, self.name = path, failures, f"append {path}"

    def __call__(self, df, batch_id):
        if self.failures:
            self.failures -= 1
            raise RuntimeError("sink not reachable")
        df.withColumn("batch_id", F.lit(batch_id)).write.mode("append").parquet(self.path)


_TWO_SINKS_SQL = f"""
    select sink, event_type, c_mktsegment, c_nationkey, avg_value, avg_acctbal
    from ({EVENT_STATS_SQL}), (select unnest(range(2)) as sink)
    """


def _two_sinks(spark, sf_dir, failures):
    """The events as a topic, two sinks of which the second fails, and what either has."""
    events = decode_rows(stream_topic(spark, _event_topic(spark, sf_dir)), EVENT)
    sinks = [_AppendsOnly(scratch_path(spark, "first")), _AppendsOnly(scratch_path(spark, "second"), failures)]

    def both():
        kept = [spark.read.parquet(sink.path).drop("batch_id").withColumn("sink", F.lit(n).cast("long")) for n, sink in enumerate(sinks)]
        return kept[0].unionByName(kept[1])

    return events, sinks, both


@query("stream_fanout_resumed", _TWO_SINKS_SQL)
def stream_fanout_resumed(spark, sf_dir):
    """The second sink fails once; on restart the batch goes to it alone, and both have it once."""
    events, sinks, both = _two_sinks(spark, sf_dir, 1)
    progress = scratch_path(spark, "progress")
    try:
        _run(spark, events, customers(spark, sf_dir), EVENT_STATS, sinks, progress)
    except StreamingQueryException:
        _run(spark, events, customers(spark, sf_dir), EVENT_STATS, sinks, progress)
    return both()


@query("stream_dead_letters", _TWO_SINKS_SQL)
def stream_dead_letters(spark, sf_dir):
    """The stream goes on without the second sink, which gets what it missed later."""
    events, sinks, both = _two_sinks(spark, sf_dir, 1)
    letters = scratch_path(spark, "letters")
    _run(spark, events, customers(spark, sf_dir), EVENT_STATS, sinks, on_error="skip", dead_letters=letters)
    deliver_dead_letters(spark, letters, sinks)
    return both()


@query(
    "batch_metrics",
    """
    select cast(0 as bigint) as batch_id, count(*) as rows,
           count(*) - count(case when event_id % 10 = 3 then 1 end) as keyed
    from events
    """,
)
def batch_metrics(spark, sf_dir):
    """Rows of the batch and rows with a key, counted while the averages are taken."""
    events = table(spark, sf_dir, "events")
    row = F.to_json(F.struct(*EVENT.names))
    payload = F.when(F.col("event_id") % 10 == 3, F.lit("not json")).otherwise(row)
    topic = FileTopic(scratch_path(spark, "topic"))
    events.select(payload.alias("value")).write.text(topic.path)
    counts = []
    _run(
        spark,
        decode_rows(stream_topic(spark, topic), EVENT),
        customers(spark, sf_dir),
        EVENT_STATS,
        [parquet_batches(scratch_path(spark, "stats"))],
        on_counts=counts.append,
    )
    return spark.createDataFrame(
        [(c.batch_id, c.rows, c.keyed) for c in counts], "batch_id bigint, rows bigint, keyed bigint"
    )


def in_batches(spark, sf_dir, **options):
    """All events in ten micro-batches, of a file per ten cores each; the finished stream."""
    per_batch = max(1, spark.sparkContext.defaultParallelism // 10)
    topic = FileTopic(scratch_path(spark, "topic"), {"maxFilesPerTrigger": str(per_batch)})
    replay_table(table(spark, sf_dir, "events").select(*EVENT.names).repartition(10 * per_batch), topic)
    stream = start_enrichment(
        decode_rows(stream_topic(spark, topic), EVENT),
        customers(spark, sf_dir),
        EVENT_STATS,
        [parquet_batches(scratch_path(spark, "stats"))],
        checkpoint=scratch_path(spark, "progress"),
        available_now=True,
        **options,
    )
    wait(stream)
    return stream


@query("stream_batches_whole", "select count(*) as rows, count(user_id) as keyed, true as several from events")
def stream_batches_whole(spark, sf_dir):
    """Several batches together saw every event once."""
    seen = []
    in_batches(spark, sf_dir, on_counts=seen.append)
    counts = spark.createDataFrame([(c.rows, c.keyed) for c in seen], "rows bigint, keyed bigint")
    return counts.agg(
        F.sum("rows").alias("rows"), F.sum("keyed").alias("keyed"), (F.count("*") > 1).alias("several")
    )


def _means(condition: str) -> str:
    return f"""
        select event_type, c_mktsegment, c_nationkey, {exact_avg('value')} as avg_value, {exact_avg('c_acctbal')} as avg_acctbal
        from events join customer on user_id = c_custkey where {condition}
        group by event_type, c_mktsegment, c_nationkey"""


@query("stream_second_checkpoint", f"{_means('event_id % 2 = 0')} union all {_means('event_id % 2 = 1')}")
def stream_second_checkpoint(spark, sf_dir):
    """Two streams with a checkpoint each write to one path and leave each other's batches alone."""
    out = scratch_path(spark, "stats")
    for half in (0, 1):
        events = table(spark, sf_dir, "events").select(*EVENT.names).where(F.col("event_id") % 2 == half)
        events = decode_rows(stream_topic(spark, _topic_of(spark, events)), EVENT)
        _run(spark, events, customers(spark, sf_dir), EVENT_STATS, [parquet_batches(out)])
    return spark.read.parquet(out).drop("query", "batch_id")


@query(
    "stream_batches_stats",
    """
    select cast(event_id % 5 as int) as batch_id, event_type, c_mktsegment, avg(floor(value)) as avg_value, avg(c_nationkey) as avg_nation
    from events join customer on user_id = c_custkey group by event_id % 5, event_type, c_mktsegment
    """,
)
def stream_batches_stats(spark, sf_dir):
    """Averages of each of five batches by the default rules; a file of the topic is a batch."""
    topic = FileTopic(scratch_path(spark, "topic"), {"maxFilesPerTrigger": "1"})
    events = table(spark, sf_dir, "events").withColumn("value", F.floor("value").cast("double"))
    for batch in range(5):
        replay_table(events.select(*EVENT.names).where(F.col("event_id") % 5 == batch).coalesce(1), topic)
    out = scratch_path(spark, "stats")
    spec = EVENT_STATS.with_(
        group_by=("event_type", "c_mktsegment"),
        measures={"avg_value": "value", "avg_nation": "c_nationkey"},
        measure_policy=KEEP_NAN,
        scale=None,
    )
    _run(spark, decode_rows(stream_topic(spark, topic), EVENT), customers(spark, sf_dir), spec, [parquet_batches(out)])
    return spark.read.parquet(out).drop("query")


@query(
    "stream_other_schema",
    f"""
    select o_orderpriority, c_mktsegment, {exact_avg('o_totalprice')} as avg_price, {exact_avg('c_acctbal')} as avg_acctbal
    from orders join customer on o_custkey = c_custkey group by o_orderpriority, c_mktsegment
    """,
)
def stream_other_schema(spark, sf_dir):
    """The streaming job with keys, measures and columns of other tables."""
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice", "o_orderpriority")
    out = scratch_path(spark, "stats")
    wait(
        run_event_enrichment(
            spark,
            _topic_of(spark, orders),
            table(spark, sf_dir, "customer").withColumnRenamed("c_custkey", "o_custkey"),
            [parquet_batches(out)],
            checkpoint=scratch_path(spark, "progress"),
            contract=Contract("orders", orders.schema, ("o_custkey",)),
            spec=EVENT_STATS.with_(
                on=("o_custkey",),
                group_by=("o_orderpriority", "c_mktsegment"),
                measures={"avg_price": "o_totalprice", "avg_acctbal": "c_acctbal"},
            ),
            available_now=True,
        )
    )
    return spark.read.parquet(out).drop("query", "batch_id")


def batch_rates(spark, sf_dir):
    """Rows per second and time per batch of ten micro-batches."""
    batches = [progress for progress in in_batches(spark, sf_dir).recentProgress if progress["numInputRows"]]
    rows = sum(progress["numInputRows"] for progress in batches)
    spent = [progress["durationMs"]["triggerExecution"] / 1000 for progress in batches]
    return {
        "batches": len(batches),
        "rows": rows,
        "rows_per_sec": round(rows / sum(spent)),
        "median_batch_sec": sorted(spent)[len(spent) // 2],
        "max_batch_sec": max(spent),
    }
