"""Landed files, lake zones, copies."""

from __future__ import annotations

import contextlib
import uuid
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conformance.registry import query, table
from conformance.shapes import BATCH_STATS_SQL, bio, dirty, exact_avg, results
from tributary.contracts import ATHLETE_BIO, ATHLETE_EVENT_RESULTS, Contract
from tributary.functions.numbers import NAN_IS_NULL
from tributary.operators import contract_rules, rule_castable, rule_max_length, rule_not_null
from tributary.plans import BATCH_STATS, bronze_to_silver, copy_tables, land_new_files, run_medallion, silver_to_gold
from tributary.plans.medallion import read_bronze
from tributary.scratch import scratch_path
from tributary.sinks import Buckets, overwrite_zone
from tributary.sources import read_landed, read_zone

CENTS = 2


def land(df, path, mode="error"):
    """Write a table the way a landed file looks: header, quotes doubled, spaces kept."""
    df.write.mode(mode).options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, emptyValue='""'
    ).csv(path)
    return path


@query("csv_landing", "select * from customer")
def csv_landing(spark, sf_dir):
    customer = table(spark, sf_dir, "customer")
    path = land(customer, scratch_path(spark, "customer"))
    return read_landed(spark, path, Contract("customer", customer.schema, ("c_custkey",)), corrupt=None)


@query("csv_landing_documents", "select doc_id, text, lang, source, n_chars from documents")
def csv_landing_documents(spark, sf_dir):
    """Texts with quotes, commas and line breaks in them."""
    documents = table(spark, sf_dir, "documents")
    path = land(documents, scratch_path(spark, "documents"))
    return read_landed(spark, path, Contract("documents", documents.schema, ("doc_id",)), corrupt=None)


@query("landing_incremental", "select * from customer")
def landing_incremental(spark, sf_dir):
    """Files land twice, and the second run parses the new ones only."""
    customer = table(spark, sf_dir, "customer")
    contract = Contract("customer", customer.schema, ("c_custkey",))
    path, bronze, progress = (scratch_path(spark, name) for name in ("customer", "bronze", "progress"))
    added = []
    for half in (0, 1):
        land(customer.where(F.col("c_custkey") % 2 == half), path, "append")
        added.append(land_new_files(spark, {"customer": path}, bronze, [contract], checkpoints=progress)["customer"]["rows"])
    if min(added) == sum(added):
        raise ValueError(f"each run adds its half, not {added}")
    return read_bronze(spark, bronze, "customer")


@contextlib.contextmanager
def _splits_of(spark, size):
    """Files are cut into splits of this many bytes; what is read has to be written before the end."""
    name = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(name)
    spark.conf.set(name, str(size))
    try:
        yield
    finally:
        spark.conf.set(name, before)


def _read_in_splits(spark, path, contract, size):
    copy = scratch_path(spark, "read")
    with _splits_of(spark, size):
        read_landed(spark, path, contract, corrupt=None).write.parquet(copy)
    return spark.read.parquet(copy)


@query("csv_landing_joined", "select doc_id, text, lang, source, n_chars from documents")
def csv_landing_joined(spark, sf_dir):
    """The same where splits are smaller than files: a file with cells of several lines stays whole."""
    documents = table(spark, sf_dir, "documents")
    path = land(documents, scratch_path(spark, "documents"))
    return _read_in_splits(spark, path, Contract("documents", documents.schema, ("doc_id",)), 64 * 1024)


@query("csv_landing_split", "select * from orders")
def csv_landing_split(spark, sf_dir):
    """As for files too large for one task, without records that span lines."""
    orders = table(spark, sf_dir, "orders")
    path = land(orders, scratch_path(spark, "orders"))
    return _read_in_splits(spark, path, Contract("orders", orders.schema, ("o_orderkey",), one_line=True), 64 * 1024)


# Split sizes the same files are read with: uncut, and cut every so many bytes.
_SPLITS = (128 * 1024 * 1024, 16 * 1024, 2_000)

_ODD_NAME = """
    case c_custkey % 5 when 0 then concat(c_name, '" pipe') when 1 then concat(c_name, '{br}second, "line"{br}')
    when 2 then concat(' "', c_name) when 3 then concat('"', c_name, '" and more') else c_name end"""


@query(
    "csv_landing_same_by_size",
    f"""
    select way, c_custkey, {_ODD_NAME.format(br=chr(10))} as c_name, c_mktsegment
    from customer, (select unnest(range({len(_SPLITS)})) as way)
    """,
)
def csv_landing_same_by_size(spark, sf_dir):
    """Stray quotes, blank lines, CRLF in cells and records over several lines, read alike in splits of any size."""
    name = F.expr(_ODD_NAME.format(br="\r\n"))
    # A quote that does not open its cell is written as it is, any other cell with quotes or breaks is quoted.
    quoted = F.concat(F.lit('"'), F.replace(name, F.lit('"'), F.lit('""')), F.lit('"'))
    written = F.when(F.col("c_custkey") % 5 == 1, quoted).when(F.col("c_custkey") % 5 == 3, quoted).otherwise(name)
    blank = F.when(F.col("c_custkey") % 7 == 0, F.lit("\r\n   ")).otherwise(F.lit(""))
    record = F.concat(F.concat_ws(",", "c_custkey", written, "c_mktsegment"), blank, F.lit("\r"))
    customer = table(spark, sf_dir, "customer")
    path = scratch_path(spark, "customer")
    header = spark.range(1).select(F.lit("c_custkey,c_name,c_mktsegment\r").alias("value"))
    header.unionAll(customer.select(record)).coalesce(1).write.text(path)
    contract = Contract("customer", customer.select("c_custkey", "c_name", "c_mktsegment").schema, ("c_custkey",))
    ways = [_read_in_splits(spark, path, contract, size).withColumn("way", F.lit(way).cast("long")) for way, size in enumerate(_SPLITS)]
    return reduce(DataFrame.unionAll, ways)


@query("medallion_gold", BATCH_STATS_SQL)
def medallion_gold(spark, sf_dir):
    """Landed files through bronze and silver to the gold averages."""
    landed = {
        ATHLETE_BIO.name: land(bio(spark, sf_dir), scratch_path(spark, "bio")),
        ATHLETE_EVENT_RESULTS.name: land(results(spark, sf_dir), scratch_path(spark, "results")),
    }
    spec = BATCH_STATS.with_(measure_policy=NAN_IS_NULL, scale=CENTS)
    path = run_medallion(spark, landed, scratch_path(spark, "lake"), spec=spec)
    return spark.read.parquet(path).drop("timestamp")


@query("gold_bucketed", BATCH_STATS_SQL)
def gold_bucketed(spark, sf_dir):
    """Gold from silver tables laid out by the key they are joined on, with a merge join."""
    lake, buckets = scratch_path(spark, "lake"), Buckets("athlete_id", 8, f"silver_{uuid.uuid4().hex[:12]}")
    for name, rows in ((ATHLETE_BIO.name, bio(spark, sf_dir)), (ATHLETE_EVENT_RESULTS.name, results(spark, sf_dir))):
        overwrite_zone(rows, f"{lake}/bronze", name)
    bronze_to_silver(spark, f"{lake}/bronze", f"{lake}/silver", buckets=buckets)
    spec = BATCH_STATS.with_(measure_policy=NAN_IS_NULL, scale=CENTS, broadcast_limit=0)
    path = silver_to_gold(spark, f"{lake}/silver", f"{lake}/gold", spec=spec, buckets=buckets)
    return spark.read.parquet(path).drop("timestamp")


@query("lake_overwrite", "select * from part")
def lake_overwrite(spark, sf_dir):
    """A zone table written twice holds the second table only."""
    zone = scratch_path(spark, "zone")
    overwrite_zone(table(spark, sf_dir, "orders"), zone, "items")
    part = table(spark, sf_dir, "part")
    overwrite_zone(part, zone, "items")
    return read_zone(spark, zone, "items", Contract("items", part.schema))


_PRICE = dirty("o_orderkey", "o_totalprice")
_ORDERS = f"select o_orderkey, o_custkey, o_orderpriority, {_PRICE} as price from orders"


def _copy(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    source = orders.select("o_orderkey", "o_custkey", "o_orderpriority", F.expr(_PRICE).alias("price"))
    target = scratch_path(spark, "target")
    rules = {"orders": [rule_not_null("price"), rule_castable("price"), rule_max_length("o_orderpriority", 10)]}
    copied = copy_tables(spark, rules, lambda name: source, lambda df, name: overwrite_zone(df, target, name))
    return copied["orders"], read_zone(spark, target, "orders")


@query(
    "copy_tables",
    f"""
    select * from ({_ORDERS}) where price is not null and try_cast(price as float) is not null
    and length(o_orderpriority) <= 10
    """,
)
def copied_rows(spark, sf_dir):
    return _copy(spark, sf_dir)[1]


@query(
    "copy_tables_rejects",
    f"""
    select o_orderkey, price, o_orderpriority from ({_ORDERS})
    where price is null or try_cast(price as float) is null or length(o_orderpriority) > 10
    """,
)
def rejected_rows(spark, sf_dir):
    return _copy(spark, sf_dir)[0].rejects.select("o_orderkey", "price", "o_orderpriority")


@query(
    "copy_tables_by_contract",
    f"""
    select o_orderkey, price, o_orderpriority, concat_ws(',',
        case when o_orderpriority is null then 'o_orderpriority_missing' end,
        case when price is not null and try_cast(price as float) is null then 'price_not_float' end,
        case when length(o_orderpriority) > 10 then 'o_orderpriority_too_long' end) as reasons
    from ({_ORDERS})
    """,
)
def rows_by_contract(spark, sf_dir):
    """All rows, those copied and those refused, with the rules of the contract that each one breaks."""
    orders = table(spark, sf_dir, "orders")
    source = orders.select("o_orderkey", "o_custkey", "o_orderpriority", F.expr(_PRICE).alias("price"))
    contract = Contract("orders", source.schema).ruled(["o_orderpriority"], {"price": "float"}, {"o_orderpriority": 10})
    target = scratch_path(spark, "target")
    rules = {"orders": contract_rules(contract)}
    copied = copy_tables(spark, rules, lambda name: source, lambda df, name: overwrite_zone(df, target, name))["orders"]
    columns = ["o_orderkey", "price", "o_orderpriority"]
    valid = read_zone(spark, target, "orders").select(*columns, F.lit("").alias("reasons"))
    return valid.union(copied.rejects.select(*columns, F.array_join("reject_reasons", ",")))


# A record in twelve has a cell too many, one too few (the last), or an athlete that is no number.
_FAULT = "c_custkey % 12"


@query(
    "medallion_gold_with_rejects",
    f"""
    with bio as (
        select cast(c_custkey as int) as id, lower(c_mktsegment) as sex, 'n' || cast(c_nationkey as string) as country,
            cast(c_nationkey as string) as height, case when {_FAULT} = 1 then null else cast(c_nationkey + 1 as string) end as weight
        from customer where {_FAULT} <> 2)
    select event_type as sport, lower(sex) as sex, country, {exact_avg('height')} as avg_height, {exact_avg('weight')} as avg_weight
    from events join bio on user_id = id group by event_type, sex, country
    """,
)
def medallion_gold_with_rejects(spark, sf_dir):
    """Records that do not fit the contract reach gold with what could be read of them."""
    bio_contract, fact_contract = (
        Contract("people", spark.createDataFrame([], "id int, sex string, country string, height string, weight string").schema, ("id",)),
        Contract("facts", spark.createDataFrame([], "id int, sport string").schema, ("id",)),
    )
    cells = F.concat_ws(",", "c_mktsegment", F.concat(F.lit("N"), "c_nationkey"), "c_nationkey")
    fault, number = F.expr(_FAULT), (F.col("c_nationkey") + 1).cast("string")
    record = F.concat_ws(",", F.when(fault == 2, F.concat(F.lit("no"), "c_custkey")).otherwise(F.col("c_custkey").cast("string")), cells)
    record = F.when(fault == 1, record).otherwise(F.concat_ws(",", record, number))
    record = F.when(fault == 3, F.concat_ws(",", record, F.lit("more"))).otherwise(record)
    header = spark.range(1).select(F.lit(",".join(bio_contract.schema.names)))
    people = header.unionAll(table(spark, sf_dir, "customer").coalesce(1).select(record)).coalesce(1)
    path = scratch_path(spark, "people")
    people.write.text(path)
    facts = table(spark, sf_dir, "events").select(F.col("user_id").alias("id"), F.col("event_type").alias("sport"))
    landed = {"people": path, "facts": land(facts, scratch_path(spark, "facts"))}
    spec = BATCH_STATS.with_(
        on=("id",),
        group_by=("sport", "sex", "country"),
        measures={"avg_height": "height", "avg_weight": "weight"},
        measure_policy=NAN_IS_NULL,
        scale=CENTS,
        fill={},
    )
    gold = run_medallion(
        spark, landed, scratch_path(spark, "lake"), [bio_contract, fact_contract], spec=spec, facts="facts", dimension="people"
    )
    return spark.read.parquet(gold).drop("timestamp")
