from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from tributary.contracts import ATHLETE_EVENT_RESULTS, Contract, ContractError, without_fields
from tributary.functions.payload import CORRUPT
from tributary.operators import decode_rows, encode_rows
from tributary.operators.codec import undecodable

import pytest

SCHEMA = StructType([StructField("a", IntegerType()), StructField("b", StringType())])

PAYLOADS = [
    ('{"a":1,"b":"x"}', (1, "x"), False, False),
    ('{"a":"bad","b":"x"}', (None, "x"), True, True),
    ("notjson", (None, None), True, True),
    (None, (None, None), False, True),
    ('{"a":2,"b":"y","c":[1]}', (2, "y"), False, False),
    ('{"a":1.5,"b":"x"}', (None, "x"), True, True),
    ('{"b":"x"}', (None, "x"), False, True),
    ('{"A":1}', (None, None), False, True),
    ("{}", (None, None), False, True),
]


def test_decode_each_kind_of_payload(spark):
    df = spark.createDataFrame([(i, p[0]) for i, p in enumerate(PAYLOADS)], "i int, value string")
    df = df.withColumn("value", F.col("value").cast("binary"))
    plain = decode_rows(df, SCHEMA, keep=("i",)).orderBy("i").collect()
    assert [(r.a, r.b) for r in plain] == [p[1] for p in PAYLOADS]

    tagged = decode_rows(df, SCHEMA, corrupt=CORRUPT, keep=("i",))
    tagged = tagged.withColumn("rejected", undecodable(CORRUPT, "a")).orderBy("i").collect()
    assert [(r.a, r.b) for r in tagged] == [p[1] for p in PAYLOADS]
    assert [r[CORRUPT] is not None for r in tagged] == [p[2] for p in PAYLOADS]
    assert [r.rejected for r in tagged] == [p[3] for p in PAYLOADS]


def test_encode_null_nan_and_time(spark):
    df = spark.sql("select 1 as a, cast(null as string) as b, double('nan') as c, timestamp'2024-01-01 00:00:00.123456' as d")
    assert encode_rows(df).first().value == '{"a":1,"c":"NaN","d":"2024-01-01T00:00:00.123Z"}'


def test_round_trip(spark):
    data = [(1, "é\n\"quoted\" ✓"), (2, ""), (3, None)]
    df = spark.createDataFrame(data, SCHEMA)
    back = decode_rows(encode_rows(df), SCHEMA)
    assert sorted(tuple(r) for r in back.collect()) == data


def test_schema_subtraction():
    assert without_fields(SCHEMA, "b", "zzz").names == ["a"]
    contract = Contract("t", SCHEMA, ("a", "b")).without("b")
    assert contract.schema.names == ["a"] and contract.required == ("a",)


def test_rules_of_a_contract():
    contract = Contract("t", SCHEMA, ("a",)).ruled(["b", "a"], {"b": "date"}, {"b": 3}).ruled(longest={"b": 4})
    assert contract.required == ("a", "b") and contract.castable == {"b": "date"} and contract.longest == {"b": 4}
    assert contract.without("b") == Contract("t", contract.without("b").schema, ("a",)) and hash(contract)
    with pytest.raises(ContractError, match="c"):
        contract.ruled(longest={"c": 1})


def test_contract_ddl_and_conformity(spark):
    assert Contract("t", SCHEMA).ddl == "a int, b string"
    assert ATHLETE_EVENT_RESULTS.ddl.startswith("edition string, edition_id int")
    df = spark.createDataFrame([(1, "x", 2.0)], "a int, b string, c double")
    assert Contract("t", SCHEMA).conform(df).columns == ["a", "b"]
    with pytest.raises(ContractError):
        Contract("t", SCHEMA).conform(df.select("a"))
    with pytest.raises(ContractError):
        Contract("t", SCHEMA).conform(df.withColumn("a", F.lit("text")))
