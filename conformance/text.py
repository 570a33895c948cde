"""Text normalising, duplicates, and JSON messages."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, LongType, StringType, StructField, StructType

from conformance.registry import query, table
from tributary.contracts import without_fields
from tributary.functions.payload import CORRUPT
from tributary.operators import decode_rows, distinct_rows, encode_rows, normalize_text
from tributary.operators.codec import undecodable


@query(
    "normalize_text_distinct",
    """
    select distinct p_partkey, trim(lower(p_name)) as p_name, trim(lower(p_brand)) as p_brand,
           trim(lower(p_type)) as p_type, p_size, p_retailprice
    from part
    """,
)
def normalize_text_distinct(spark, sf_dir):
    """Every part three times, twice with other case and padding; one of each is left."""
    part = table(spark, sf_dir, "part")
    padded = part.withColumns({c: F.concat(F.lit("  "), F.upper(c), F.lit(" ")) for c in ("p_name", "p_type")})
    return distinct_rows(normalize_text(part.unionAll(padded).unionAll(part)))


@query("normalize_documents", "select distinct trim(lower(text)) as text from documents")
def normalize_documents(spark, sf_dir):
    return distinct_rows(normalize_text(table(spark, sf_dir, "documents").select("text")))


@query(
    "normalize_all_documents",
    """
    select distinct doc_id, trim(lower(text)) as text, trim(lower(lang)) as lang,
           trim(lower(source)) as source, n_chars
    from documents
    """,
)
def normalize_all_documents(spark, sf_dir):
    return distinct_rows(normalize_text(table(spark, sf_dir, "documents")))


_PROPS = StructType([StructField("k", IntegerType()), StructField("sex", StringType())])


@query("json_decode_project", "select event_id, try_cast(json_extract_string(props, '$.k') as int) as k from events")
def json_decode_project(spark, sf_dir):
    """Binary payloads, decoded by a schema a field has been taken from."""
    messages = table(spark, sf_dir, "events").select("event_id", F.col("props").cast("binary").alias("value"))
    return decode_rows(messages, without_fields(_PROPS, "sex"), keep=("event_id",))


@query(
    "json_decode_rejects",
    """
    select event_id,
           case when event_id % 6 in (0, 1, 2, 3) then null
                else try_cast(json_extract_string(props, '$.k') as int) end as k,
           event_id % 6 in (0, 1) as corrupt,
           event_id % 6 in (0, 1, 2, 3) as rejected
    from events
    """,
)
def json_decode_rejects(spark, sf_dir):
    """Malformed, ill-typed, null and keyless payloads among good ones and ones with more fields."""
    payload = F.expr(
        """case event_id % 6 when 0 then 'not json' when 1 then '{"k": "bad"}' when 2 then null
           when 3 then '{"K": 1}' when 4 then concat('{"more": [1], ', substr(props, 2)) else props end"""
    )
    messages = table(spark, sf_dir, "events").select("event_id", payload.alias("value"))
    rows = decode_rows(messages, without_fields(_PROPS, "sex"), corrupt=CORRUPT, keep=("event_id",))
    return rows.select(
        "event_id", "k", F.col(CORRUPT).isNotNull().alias("corrupt"), undecodable(CORRUPT, "k").alias("rejected")
    )


@query(
    "json_encode_rows",
    """
    select cast(to_json(struct_pack(event_id := event_id, user_id := user_id, event_type := event_type,
                                    value := value)) as varchar) as value
    from events
    """,
)
def json_encode_rows(spark, sf_dir):
    return encode_rows(table(spark, sf_dir, "events").select("event_id", "user_id", "event_type", "value"))


_NATION = "case when c_custkey % 3 = 0 then null else c_nationkey end"


@query("json_round_trip", f"select c_custkey, c_name, {_NATION} as c_nationkey, c_mktsegment from customer")
def json_round_trip(spark, sf_dir):
    """Encoded and decoded again, nulls included."""
    schema = StructType(
        [
            StructField("c_custkey", LongType()),
            StructField("c_name", StringType()),
            StructField("c_nationkey", IntegerType()),
            StructField("c_mktsegment", StringType()),
        ]
    )
    rows = table(spark, sf_dir, "customer").withColumn("c_nationkey", F.expr(_NATION))
    return decode_rows(encode_rows(rows.select(*schema.names)), schema)
