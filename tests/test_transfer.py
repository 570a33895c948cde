"""Copies, rejects, and the options handed to connectors that are not run here."""

import pytest

from tributary.contracts import ATHLETE_BIO
from tributary.operators import rule_castable, rule_max_length, rule_not_null, split_rejects, tag_rejects
from tributary.plans import copy_tables
from tributary.sinks import append_table, batches, overwrite_zone, table_batches, table_options
from tributary.sources import FileTopic, KafkaTopic, KeyRange, key_bounds, read_options, read_table, read_zone, stream_topic

ROWS = [(1, "180", "ok"), (2, "77-80", "ok"), (3, None, "much too long"), (None, "1", None)]
RULES = [rule_not_null("id"), rule_castable("height"), rule_max_length("note", 5)]


def test_split_is_whole(spark):
    df = spark.createDataFrame(ROWS, "id int, height string, note string")
    valid, rejects = split_rejects(df, RULES)
    assert [r.id for r in valid.collect()] == [1]
    assert {r.id: r.reject_reasons for r in rejects.collect()} == {
        2: ["height_not_float"],
        3: ["height_not_float", "note_too_long"],
        None: ["id_missing"],
    }
    assert valid.columns == df.columns


def test_no_rules_reject_nothing(spark):
    df = spark.createDataFrame(ROWS, "id int, height string, note string")
    valid, rejects = split_rejects(df, [])
    assert valid.count() == 4 and rejects.count() == 0
    assert {len(r.reject_reasons) for r in tag_rejects(df, []).collect()} == {0}


@pytest.mark.parametrize("condition, rows, rejected", [("true", 4, 3), ("id = 1", 1, 0), ("id = 2", 1, 1), ("false", 0, 0)])
def test_copy(spark, folder, condition, rows, rejected):
    df = spark.createDataFrame(ROWS, "id int, height string, note string").filter(condition).repartition(3)
    copied = copy_tables(
        spark,
        {"people": RULES},
        read=lambda table: df,
        write=lambda out, table: overwrite_zone(out, folder("target"), table),
        staging=folder("staging"),
    )["people"]
    assert (copied.rows, copied.rejected, copied.rejects.count()) == (rows, rejected, rejected)
    target = read_zone(spark, folder("target"), "people")
    assert target.count() == rows - rejected


CONNECTION = {"url": "jdbc:some:thing", "user": "u", "password": "p", "driver": "d"}


def test_reader_options():
    options = read_options(CONNECTION, "t", contract=ATHLETE_BIO, keys=KeyRange("athlete_id", 1, 900, 16))
    assert options["dbtable"] == "t" and options["url"] == CONNECTION["url"] and options["user"] == "u"
    assert options["customSchema"].startswith("athlete_id int, name string, sex string")
    assert [options[k] for k in ("partitionColumn", "lowerBound", "upperBound", "numPartitions")] == ["athlete_id", "1", "900", "16"]
    assert "partitionColumn" not in read_options(CONNECTION, "t")


def test_keys_and_predicates_exclude_each_other():
    with pytest.raises(ValueError):
        read_table(None, CONNECTION, "t", keys=KeyRange("k", 0, 1, 2), predicates=["k < 1", "k >= 1"])


def test_writer_options():
    options = table_options(CONNECTION, "t", connections=4)
    assert options["dbtable"] == "t" and options["numPartitions"] == "4" and options["truncate"] == "true"
    assert "numPartitions" not in table_options(CONNECTION, "t")


def test_topic_options():
    topic = KafkaTopic("host:1", "events", options={"maxOffsetsPerTrigger": "1000"})
    assert topic.read_options() == {
        "kafka.bootstrap.servers": "host:1",
        "subscribe": "events",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "1000",
    }
    assert topic.write_options(3)["topic"] == "events"
    assert FileTopic("/t").write_options(3) == {"path": "/t/batch_id=3"}
    assert FileTopic("/t").write_options() == {"path": "/t"}


class Recorder:
    """Stands in for a session, reader or writer and notes what is asked of it.

    No database is started for a test; what Spark's JDBC source is told is all
    that can be looked at.
    """

    def __init__(self, row=None):
        self.calls, self.row = [], row

    @property
    def read(self):
        return self

    write = read

    def first(self):
        return self.row

    def __getattr__(self, name):
        def call(*args, **kwargs):
            self.calls.append((name, args, kwargs))
            return self

        return call

    def seen(self, name):
        return [(args, kwargs) for called, args, kwargs in self.calls if called == name]


def test_a_table_is_read_by_ranges_of_its_key():
    session = Recorder(row=(3, 900))
    keys = key_bounds(session, CONNECTION, "people", "athlete_id", 8)
    assert keys == KeyRange("athlete_id", 3, 900, 8)
    ((_, asked),) = session.seen("options")
    assert asked["query"] == "SELECT MIN(athlete_id) AS lo, MAX(athlete_id) AS hi FROM people"
    session = Recorder()
    read_table(session, CONNECTION, "people", contract=ATHLETE_BIO, keys=keys)
    assert session.seen("format") == [(("jdbc",), {})] and len(session.seen("load")) == 1
    ((_, asked),) = session.seen("options")
    assert asked == read_options(CONNECTION, "people", contract=ATHLETE_BIO, keys=keys)


def test_a_table_is_read_by_conditions():
    session = Recorder()
    read_table(session, CONNECTION, "people", predicates=["sex = 'M'", "sex <> 'M' or sex is null"])
    ((args, options),) = session.seen("jdbc")
    assert args == (CONNECTION["url"], "people")
    assert options["predicates"] == ["sex = 'M'", "sex <> 'M' or sex is null"]
    assert "url" not in options["properties"] and options["properties"]["user"] == "u"


def test_a_table_is_written_in_bulk():
    table = Recorder()
    append_table(table, CONNECTION, "people", connections=3)
    ((_, options),) = table.seen("options")
    assert options == table_options(CONNECTION, "people", connections=3)
    assert table.seen("mode") == [(("append",), {})] and table.seen("save") == [((), {})]


def test_a_batch_is_appended_with_its_id(spark, monkeypatch):
    written = []
    monkeypatch.setattr(batches, "append_table", lambda df, connection, table, **options: written.append((df, table, options)))
    df = spark.range(2)
    table_batches(CONNECTION, "stats", batch_column="batch", connections=2)(df, 7)
    table_batches(CONNECTION, "stats")(df, 8)
    (first, table, options), (second, _, _) = written
    assert table == "stats" and options == {"connections": 2}
    assert [tuple(r) for r in first.collect()] == [(0, 7), (1, 7)] and first.schema["batch"].dataType.simpleString() == "bigint"
    assert second.columns == ["id"]


def test_a_topic_of_a_broker():
    session = Recorder()
    topic = KafkaTopic("host:1", "events")
    session.readStream = session
    stream_topic(session, topic)
    assert session.seen("format") == [(("kafka",), {})]
    assert session.seen("options") == [((), topic.read_options())]


def test_key_ranges():
    from decimal import Decimal

    from tributary.sources.database import key_range

    assert key_range("k", None, None, 4) is None
    assert key_range("k", 1.5, 9.25, 4) == KeyRange("k", 1, 10, 4)
    assert key_range("k", Decimal("-1.5"), Decimal("3.00"), 4) == KeyRange("k", -2, 3, 4)
    assert key_range("k", 1, 9, 4) == KeyRange("k", 1, 9, 4)


def test_rules_of_a_contract(spark):
    from tributary.contracts import Contract
    from tributary.operators.rejects import contract_rules

    df = spark.createDataFrame([*ROWS, (5, None, None), (6, "", "€€€€€"), (7, "1e3", "€€€€€€"), (8, "nan", "")], "id int, height string, note string")
    contract = Contract("t", df.schema, ("id",), castable={"height": "float"}, longest={"note": 5})
    valid, rejects = split_rejects(df, contract_rules(contract))
    assert sorted(r.id for r in valid.collect()) == [1, 5, 8]
    assert {r.id: r.reject_reasons for r in rejects.collect()} == {
        2: ["height_not_float"],
        3: ["note_too_long"],
        6: ["height_not_float"],
        7: ["note_too_long"],
        None: ["id_missing"],
    }


def test_rejects_are_written_where_the_caller_says(spark, folder):
    from tributary.contracts import Contract
    from tributary.operators.rejects import contract_rules
    from tributary.sinks import overwrite_zone

    df = spark.createDataFrame([(1, "a"), (None, "b")], "k int, v string")
    rules = {"t": contract_rules(Contract("t", df.schema, ("k",)))}
    copy_tables(
        spark,
        rules,
        lambda name: df,
        lambda rows, name: overwrite_zone(rows, folder("to"), name),
        write_rejects=lambda rows, name: overwrite_zone(rows, folder("aside"), name),
    )
    assert [tuple(r) for r in read_zone(spark, folder("to"), "t").collect()] == [(1, "a")]
    assert [tuple(r) for r in read_zone(spark, folder("aside"), "t").collect()] == [(None, "b", ["k_missing"])]
