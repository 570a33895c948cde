"""The jobs from the command line.

    spark-submit --py-files tributary.zip run.py lake --landing s --lake t

Connection settings are read from JSON files the caller names; a file holds the
options of Spark's JDBC source (``url``, ``user``, ``password``, ``driver``). So are
the rules of a copy, ``{"athlete_bio": {"castable": {"height": "float"}, "longest": {"name": 200}}}``.
"""

from __future__ import annotations

import argparse
import json
import logging
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tributary.contracts import ContractError
from tributary.operators import contract_rules
from tributary.plans import (
    bronze_to_silver,
    copy_tables,
    land_new_files,
    landing_to_bronze,
    replay_table,
    run_event_enrichment,
    run_medallion,
    silver_to_gold,
)
from tributary.plans.medallion import TABLES
from tributary.plans.presets import STREAM_STATS
from tributary.settings import BASE_SETTINGS, input_bytes, session_settings
from tributary.sinks import append_table, overwrite_zone, parquet_batches, table_batches, topic_batches
from tributary.sources import FileTopic, KafkaTopic, key_bounds, read_table, read_zone
from tributary.sources.topics import Topic
from tributary.streaming import deliver_dead_letters, wait
from tributary.streaming.enrichment import TRIGGER_SECONDS


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tributary")
    parser.add_argument("--shuffle-bytes", type=int, help="size the session for a shuffle of so many bytes instead of the input's")
    parser.add_argument("--cores", type=int, default=1, help="cores of the cluster")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *required: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for option in required:
            sub.add_argument(option, required=True)
        return sub

    bronze = job("bronze", "--landing", "--bronze")
    silver = job("silver", "--bronze", "--silver")
    gold = job("gold", "--silver", "--gold")
    lake = job("lake", "--landing", "--lake")
    for sub in (silver, lake):
        sub.add_argument("--without-rejected", action="store_true", help="leave out rows that did not fit")
    for sub in (bronze, silver, gold):
        sub.add_argument("--preview", type=int, default=0, help="rows to show of each table")

    lake.add_argument("--resume", action="store_true", help="leave out steps that are done and whose input is as it was")
    bronze.add_argument("--checkpoints", help="add only what has landed since the last run with this folder")

    copy = job("copy", "--source", "--target")
    copy.add_argument("--mode", default="append", choices=["append", "overwrite"])
    copy.add_argument("--rejects-path", help="Parquet folder of the rows that a table's contract refuses; without it and --rules they fail the job")
    copy.add_argument("--rules", help="JSON file of rules by table: required (columns), castable (column to type), longest (column to characters)")
    replay = job("replay", "--topic")
    stream = job("stream", "--topic", "--checkpoint")
    for sub in (replay, stream):
        sub.add_argument("--servers", help="the broker; without it a topic is a folder of text files")
        sub.add_argument("--source", help="settings of the database that holds the table")
        sub.add_argument("--table", help="a database table or, without --source, a Parquet folder", required=True)
    for sub in (copy, stream):
        sub.add_argument("--connections", type=int, default=8, help="tasks that write to a database at a time")
    for sub in (copy, replay, stream):
        sub.add_argument("--key", help="an evenly spread column to read a database table by in parallel")
        sub.add_argument("--partitions", type=int, default=16, help="parallel reads when --key is given")

    deliver = job("deliver", "--dead-letters")
    deliver.add_argument("--servers", help="the broker; without it a topic is a folder of text files")
    deliver.add_argument("--connections", type=int, default=8, help="tasks that write to a database at a time")
    for sub in (stream, deliver):
        sub.add_argument("--out-path", help="Parquet folder of the averages")
        sub.add_argument("--out-topic")
        sub.add_argument("--out-connection", help="settings of the database for the averages")
        sub.add_argument("--out-table")
        sub.add_argument("--batch-column", help="column of --out-table that takes the batch id")
    stream.add_argument("--dead-letters", help="with --on-error skip, a folder that keeps what sinks have missed, for the job deliver")
    stream.add_argument("--frozen-path", help="folder for the copy of the table while the stream runs")
    stream.add_argument("--rejects-path", help="Parquet folder of the messages that are of no use")
    stream.add_argument("--every", type=int, default=TRIGGER_SECONDS, help="seconds between batches")
    stream.add_argument("--batch-limit", help="the most offsets, or files, of one batch")
    stream.add_argument("--policy", default="keep_nan", choices=["keep_nan", "nan_is_null"])
    stream.add_argument("--on-error", default="raise", choices=["raise", "skip"])
    stream.add_argument("--available-now", action="store_true", help="handle what is there and end")
    return parser


def main(arguments: Sequence[str] | None = None, spark: SparkSession | None = None) -> None:
    parser = _parser()
    args = parser.parse_args(arguments)
    if args.job == "stream":
        if not (args.out_path or args.out_topic or args.out_connection):
            parser.error("stream: give --out-path, --out-topic or --out-connection")
        if args.out_connection and not args.out_table:
            parser.error("stream: --out-connection needs --out-table")
    logging.basicConfig(level=logging.INFO)
    own = spark is None
    if own:
        spark = SparkSession.builder.appName(f"tributary-{args.job}").config(map=BASE_SETTINGS).getOrCreate()
        size = args.shuffle_bytes or input_bytes(spark, _inputs(args))
        for name, value in (session_settings(size, args.cores) if size else {}).items():
            spark.conf.set(name, value)
    try:
        _JOBS[args.job](spark, args)
    finally:
        if own:
            spark.stop()


def _bronze(spark, args):
    landed = _landed(args.landing)
    if args.checkpoints:
        land_new_files(spark, landed, args.bronze, checkpoints=args.checkpoints)
    else:
        landing_to_bronze(spark, landed, args.bronze, preview_rows=args.preview)


def _silver(spark, args):
    bronze_to_silver(
        spark, args.bronze, args.silver, with_rejected=not args.without_rejected, preview_rows=args.preview
    )


def _gold(spark, args):
    silver_to_gold(spark, args.silver, args.gold, preview_rows=args.preview)


def _lake(spark, args):
    landed = _landed(args.landing)
    run_medallion(spark, landed, args.lake, with_rejected=not args.without_rejected, resume=args.resume)


def _copy(spark, args):
    source, target = _settings(args.source), _settings(args.target)
    contracts = {contract.name: contract for contract in TABLES}
    rules = _settings(args.rules) if args.rules else {}
    for name, of_table in rules.items():
        if name not in contracts:
            raise ContractError(f"rules for unknown table {name}")
        contracts[name] = contracts[name].ruled(**of_table)
    rejects = args.rejects_path
    copy_tables(
        spark,
        {name: contract_rules(contract) if rejects or rules else () for name, contract in contracts.items()},
        read=lambda name: read_table(
            spark, source, name, contract=contracts[name], keys=_keys(spark, source, name, args)
        ),
        write=lambda df, name: append_table(df, target, name, mode=args.mode, connections=args.connections),
        write_rejects=(lambda df, name: overwrite_zone(df, rejects, name)) if rejects else None,
    )


def _replay(spark, args):
    replay_table(_table(spark, args), _topic(args.servers, args.topic))


def _sinks(args):
    sinks = []
    if args.out_path:
        sinks.append(parquet_batches(args.out_path))
    if args.out_connection:
        sinks.append(
            table_batches(
                _settings(args.out_connection),
                args.out_table,
                batch_column=args.batch_column,
                connections=args.connections,
            )
        )
    if args.out_topic:
        sinks.append(topic_batches(_topic(args.servers, args.out_topic)))
    return sinks


def _stream(spark, args):
    limit = {"maxOffsetsPerTrigger" if args.servers else "maxFilesPerTrigger": args.batch_limit}
    query = run_event_enrichment(
        spark,
        _topic(args.servers, args.topic, limit if args.batch_limit else {}),
        _table(spark, args),
        _sinks(args),
        checkpoint=args.checkpoint,
        spec=STREAM_STATS.with_(measure_policy=args.policy),
        rejects=parquet_batches(args.rejects_path) if args.rejects_path else None,
        every_seconds=args.every,
        available_now=args.available_now,
        on_error=args.on_error,
        frozen_path=args.frozen_path,
        dead_letters=args.dead_letters,
    )
    wait(query)


def _deliver(spark, args):
    deliver_dead_letters(spark, args.dead_letters, _sinks(args))


_JOBS = {
    "bronze": _bronze,
    "silver": _silver,
    "gold": _gold,
    "lake": _lake,
    "copy": _copy,
    "replay": _replay,
    "stream": _stream,
    "deliver": _deliver,
}


def _landed(landing: str) -> dict[str, str]:
    """Each table's files are in a folder of its name below the landing zone, or in files of its name with an ending."""
    return {contract.name: f"{landing.rstrip('/')}/{contract.name}{{,.*}}" for contract in TABLES}


def _inputs(args) -> list[str]:
    """The folders a job reads, as far as they are folders."""
    if args.job in ("bronze", "lake"):
        return list(_landed(args.landing).values())
    if args.job in ("silver", "gold"):
        zone = (args.bronze if args.job == "silver" else args.silver).rstrip("/")
        return [f"{zone}/{contract.name}" for contract in TABLES]
    return [args.table] if args.job in ("replay", "stream") and not args.source else []


def _settings(path: str) -> dict[str, str]:
    with open(path, encoding="utf-8") as file:
        return json.load(file)


def _table(spark, args):
    if not args.source:
        zone, _, name = args.table.rstrip("/").rpartition("/")
        return read_zone(spark, zone, name)
    source = _settings(args.source)
    return read_table(spark, source, args.table, keys=_keys(spark, source, args.table, args))


def _keys(spark, connection, table, args):
    return key_bounds(spark, connection, table, args.key, args.partitions) if args.key else None


def _topic(servers: str | None, name: str, options: dict[str, str] | None = None) -> Topic:
    if servers:
        return KafkaTopic(servers, name, options=options or {})
    return FileTopic(name, options=options or {})
