"""Landed files to bronze, bronze to silver, silver to gold."""

from __future__ import annotations

import json
import logging
from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tributary.contracts import ATHLETE_BIO, ATHLETE_EVENT_RESULTS, Contract
from tributary.functions.payload import CORRUPT
from tributary.operators.clean import distinct_rows, normalize_text
from tributary.operators.stats import StatsSpec, grouped_stats
from tributary.plans.presets import BATCH_STATS
from tributary.scratch import discard, exists, read_small, write_small
from tributary.sinks.tables import Buckets, overwrite_zone
from tributary.sources.lake import MANIFEST, counted_files, read_zone, snapshot_path, zone_path
from tributary.sources.landing import landed_state, read_landed, stream_landed

log = logging.getLogger(__name__)

# The tables of the lake and the name of the gold one.
TABLES = (ATHLETE_BIO, ATHLETE_EVENT_RESULTS)
GOLD_TABLE = "avg_stats"

REJECTED = "rejected"
BATCH = "batch_id"
RUN = "_run"


def landing_to_bronze(
    spark: SparkSession,
    landed: Mapping[str, str],
    bronze: str,
    contracts: Sequence[Contract] = TABLES,
    *,
    preview_rows: int = 0,
) -> dict[str, dict[str, int]]:
    """Write each table's landed files, found by table name, to bronze.

    The files are parsed once. Rows that do not fit the contract go to the same
    table under ``rejected=true`` together with their text. Returns the rows and
    the rejected rows of each table, as the written files have them.
    """
    counts = {}
    for contract in contracts:
        rows = read_landed(spark, landed[contract.name], contract)
        tagged = rows.withColumn(REJECTED, F.col(CORRUPT).isNotNull())
        path = overwrite_zone(tagged, bronze, contract.name, partition_by=(REJECTED,))
        found = counted_files(spark, tagged.schema, path, REJECTED)
        if not found:
            # No row, no folder: without a flag folder the schema at least is there to read.
            path = overwrite_zone(tagged, bronze, contract.name)
        counts[contract.name] = {"rows": sum(found.values()), "rejected": found.get(True, 0)}
        log.info("%s: %s", path, counts[contract.name])
        _preview(spark.read.parquet(path), preview_rows)
    return counts


def land_new_files(
    spark: SparkSession,
    landed: Mapping[str, str],
    bronze: str,
    contracts: Sequence[Contract] = TABLES,
    *,
    checkpoints: str,
) -> dict[str, dict[str, int]]:
    """Add to bronze what has landed since the last such run; each file is parsed once.

    Each table has a checkpoint below ``checkpoints`` that knows the files done, and a folder for each batch, which is replaced if the
    batch is run again. Returns the rows and the rejected rows that were added. A bronze table is either made so, or
    whole by ``landing_to_bronze``.
    """
    counts = {}
    for contract in contracts:
        path, seen = zone_path(bronze, contract.name), {"rows": 0, "rejected": 0}
        if exists(spark, f"{path}/{MANIFEST}"):
            raise ValueError(f"{path} was written as a whole")
        rows = stream_landed(spark, landed[contract.name], contract).withColumn(REJECTED, F.col(CORRUPT).isNotNull())

        def add(batch: DataFrame, batch_id: int, path: str = path, seen: dict[str, int] = seen) -> None:
            folder = f"{path}/{BATCH}={batch_id}"
            batch.write.mode("overwrite").partitionBy(REJECTED).parquet(folder)
            found = counted_files(spark, batch.schema, folder, REJECTED)
            seen["rows"] += sum(found.values())
            seen["rejected"] += found.get(True, 0)

        writer = rows.writeStream.option("checkpointLocation", f"{checkpoints.rstrip('/')}/{contract.name}")
        writer.trigger(availableNow=True).foreachBatch(add).start().awaitTermination()
        counts[contract.name] = seen
        log.info("%s: %s added", path, seen)
    return counts


def read_bronze(spark: SparkSession, bronze: str, table: str, *, with_rejected: bool = True) -> DataFrame:
    """A bronze table's columns; without the rows that did not fit only on request."""
    rows = read_zone(spark, bronze, table)
    if REJECTED not in rows.columns:
        return rows
    # The flag is a folder name, so the other rows' files are not opened.
    kept = rows if with_rejected else rows.filter(~F.col(REJECTED).cast("boolean"))
    return kept.drop(REJECTED, CORRUPT, BATCH)


def rejected_rows(spark: SparkSession, bronze: str, table: str) -> int:
    """How many rows of a bronze table did not fit the contract; only their files are looked at."""
    rows = read_zone(spark, bronze, table)
    return rows.filter(F.col(REJECTED).cast("boolean")).count() if REJECTED in rows.columns else 0


def bronze_to_silver(
    spark: SparkSession,
    bronze: str,
    silver: str,
    tables: Sequence[str] = tuple(contract.name for contract in TABLES),
    *,
    with_rejected: bool = True,
    preview_rows: int = 0,
    buckets: Buckets | None = None,
) -> dict[str, int]:
    """Normalise the text of each table and drop rows that are then equal. With ``buckets`` tables are laid out by a key.

    Rows that did not fit come along, with nulls for the cells that could not be
    read, unless ``with_rejected`` is off. Returns how many rows of each table were left out for it.
    """
    left_out = {}
    for table in tables:
        left_out[table] = 0 if with_rejected else rejected_rows(spark, bronze, table)
        rows = read_bronze(spark, bronze, table, with_rejected=with_rejected)
        path = overwrite_zone(distinct_rows(normalize_text(rows)), silver, table, buckets=buckets)
        log.info("%s written, %s rejected rows left out", path, left_out[table])
        _preview(spark.read.parquet(path), preview_rows)
    return left_out


def silver_to_gold(
    spark: SparkSession,
    silver: str,
    gold: str,
    *,
    facts: str = ATHLETE_EVENT_RESULTS.name,
    dimension: str = ATHLETE_BIO.name,
    table: str = GOLD_TABLE,
    spec: StatsSpec = BATCH_STATS,
    run_ts: Column | None = None,
    preview_rows: int = 0,
    buckets: Buckets | None = None,
) -> str:
    """Join the silver tables, average per group, write the gold table.

    Tables that ``bronze_to_silver`` has laid out by the key the spec joins on are joined without a shuffle; each
    is in the catalog then.
    """
    given = (spark.table(buckets.name(t)) if buckets else read_zone(spark, silver, t) for t in (facts, dimension))
    stats = grouped_stats(*given, spec, run_ts)
    path = overwrite_zone(stats, gold, table)
    log.info("%s written", path)
    _preview(spark.read.parquet(path), preview_rows)
    return path


def run_medallion(
    spark: SparkSession,
    landed: Mapping[str, str],
    lake: str,
    contracts: Sequence[Contract] = TABLES,
    *,
    with_rejected: bool = True,
    resume: bool = False,
    **gold_options,
) -> str:
    """All three steps in order; a step that fails ends the run before the next.

    What each step has read and written is noted below the lake. With ``resume``, a step is left out if its input is
    what it was, the rules are the same, and its tables are as it left them: a run that has failed goes on where it
    ended. Landed files are the same by their names, sizes and times, tables by their snapshots.
    """
    lake = lake.rstrip("/")
    bronze, silver, gold = (f"{lake}/{zone}" for zone in ("bronze", "silver", "gold"))
    names = [contract.name for contract in contracts]
    stats = gold_options.get("table", GOLD_TABLE)

    def snapshots(zone: str, tables: Sequence[str]) -> dict[str, str]:
        return {table: snapshot_path(spark, zone, table) for table in tables}

    def step(name: str, given: object, made: Callable[[], dict[str, str]], run: Callable[[], object]) -> None:
        note, given = f"{lake}/{RUN}/{name}.json", json.loads(json.dumps(given, default=str, sort_keys=True))
        if resume and exists(spark, note) and json.loads(read_small(spark, note)) == {"given": given, "made": made()}:
            log.info("%s is done", name)
            return
        discard(spark, note)
        run()
        write_small(spark, note, json.dumps({"given": given, "made": made()}))

    def files() -> dict[str, str]:
        return {name: landed_state(spark, landed[name]) for name in names}

    step(
        "bronze",
        {"files": files(), "contracts": [[c.name, c.ddl, c.required, c.one_line] for c in contracts]},
        lambda: snapshots(bronze, names),
        lambda: landing_to_bronze(spark, landed, bronze, contracts),
    )
    step(
        "silver",
        {"tables": snapshots(bronze, names), "with_rejected": with_rejected},
        lambda: snapshots(silver, names),
        lambda: bronze_to_silver(spark, bronze, silver, names, with_rejected=with_rejected),
    )
    step(
        "gold",
        {"tables": snapshots(silver, names), "options": {name: str(value) for name, value in gold_options.items()}},
        lambda: snapshots(gold, [stats]),
        lambda: silver_to_gold(spark, silver, gold, **gold_options),
    )
    return snapshot_path(spark, gold, stats)


def _preview(df: DataFrame, rows: int) -> None:
    if rows:
        df.show(rows, truncate=False)
